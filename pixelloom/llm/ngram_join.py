"""N-gram Jaccard self-join by a prefix tree, and its components (operator 4).

A document's set holds the hashes of its distinct word n-grams.  Two documents link when the Jaccard
similarity of their sets reaches a rational threshold; the join is exact up to collisions of
64-bit shingle hashes within one pair.  The steps:

1. *Fingerprint*: one narrow pass gives every document its set size and a 128-bit digest of the set.
   Documents of equal sets become one node.
2. *Families*: sets that reach the threshold differ in at most H shingles, where H follows from their lengths.
   The hash range is cut into P > H slices, so two such sets agree entirely in at least ``P - H`` slices.  Every set
   emits a signature of each slice.  Pairs that share as many signatures as a true link must, less the slices that may be
   empty in both, are linked; where over ``BUCKET`` sets share one signature, all are linked to the smallest instead,
   so a frequent signature never makes pairs, and such signatures are combined before the shuffle too.  Components
   of these links are the families that may hold true links.  Lengths are cut into levels, slices differ by level, and a
   family is of one level, so families don't chain through sets of all lengths.  Passages that
   documents share fill few slices, so they make no families, and no statistics of the corpus are needed.
3. *Trie*: the sets of families are brought together.  Within a family, sets are ordered by frequency, stored in
   a trie whose levels are blocks of bits, and every set walks the trie at once: the overlap of a shared
   prefix is computed once for all sets below it, and a subtree is left as soon as the shingles that remain
   can't lift the overlap to what the lengths require.  A family beyond ``GROUP_SHINGLES`` first
   loses the sets that share too few shingles with all its others to link with any; if it is still beyond, it is split into
   blocks by hash and every pair of blocks is a group of its own, so no family has to fit in one task.  Pairs of blocks are
   dealt out in turns, each of about all sets once, so disk doesn't grow with the square of a family.
   A group returns a spanning forest of its links, never all pairs.
4. *Components* of the links, smallest document id first.

Nothing that grows with the corpus without bound reaches the driver: it sees a Bloom filter of family members, 16 bits for each up to
``BLOOM_MOST`` bits in all (beyond that, a fuller filter only lets more rows through to an exact join).

Defined cases: null or empty texts and texts without words have an empty set, link with nothing, and are
their own component; a text of fewer words than n has one shingle, all its words; rows of equal id are one
node of the graph; a null id keeps its set size, takes no part in links and has a null component; an empty table
gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.llm.arrow import bound_batches, map_batches, sliced, utf8
from pixelloom.operators.components import connected_components
from pixelloom.sources.storage import materialise

#: Least and most bits of the Bloom filter of family members (128 kB to 32 MB), and how many of them are set for a member.
BLOOM_LEAST, BLOOM_MOST, BLOOM_HASHES = 1 << 20, 1 << 28, 4
#: Shingles in one trie group, at which a family is split, and sets in one.
GROUP_SHINGLES, GROUP_SETS = 500_000, 2_048
#: Signatures that a task combines at once.
COMBINED = 300_000
#: Sets that share a signature up to which their pairs are counted (at most 20 pairs a set).
BUCKET = 40
#: Slices for each shingle that two linked sets may differ in.
FINER = 1.3
#: Words whose hashes a worker remembers.
MEMO_WORDS = 150_000

_M = np.uint64(0x9E3779B97F4A7C15)
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S29)) * _M
    x = (x ^ (x >> _S32)) * _M
    return x ^ (x >> _S29)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()


def shingles(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word n-grams; ASCII letters lowered, words between ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    out = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        out = _mix(out) + h[i : len(h) - k + 1 + i]
    out = np.sort(_mix(out + np.uint64(k)))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def _digest(found: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class Slices:
    """How sets are cut for a threshold: by lengths into levels, and by hashes into each level's slices.

    A level holds lengths first..last; it serves pairs whose smaller set is in it, so the larger has up to
    last / t.  These differ in at most H shingles; of P slices, P - H agree or more.  Sets with more than ``slack`` empty slices
    emit signatures of these too, so two linked sets share at least P - H - slack signatures."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.first, self.plan, self.need = [1], [], []
        self.cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def levels(self, n: int) -> list[int]:
        """The levels that a set of n takes part in."""
        while self.first[-1] <= n:
            a = self.first[-1]
            last = max(a, a * self.den // self.num)
            most = last * self.den // self.num
            differ = (last + most) * (self.den - self.num) // (self.den + self.num)
            parts = differ + 1 if differ == 0 else max(differ + 1, math.ceil(FINER * differ) + 1)
            empty = parts * math.exp(-a / parts)
            slack = min(parts - differ - 1, math.ceil(empty + 3 * math.sqrt(empty)))
            self.plan.append((most, slack, parts))
            self.need.append(parts - differ - slack)
            self.first.append(last + 1)
        k = bisect.bisect_right(self.first, n) - 1
        out = []
        while k >= 0 and self.plan[k][0] >= n:
            out.append(k)
            k -= 1
        return out

    def mark(self, level: int) -> int:
        """Turns a digest into the node of its set at a level, by exclusive or."""
        return int(_mix(np.array([level + 1], np.uint64)).view(np.int64)[0])

    def signatures(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of the set's slices, and the mark of the level of each."""
        total = np.zeros(len(found) + 1, np.uint64)
        np.cumsum(_mix(found + _S29), out=total[1:])
        out, levels = [], []
        for k in self.levels(len(found)):
            _, slack, parts = self.plan[k]
            if k not in self.cuts:
                self.cuts[k] = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64), _mix(np.arange(parts, dtype=np.uint64) + np.uint64(k << 40))
            bounds, marks = self.cuts[k]
            edge = np.concatenate(([0], np.searchsorted(found, bounds), [len(found)]))
            sums = _mix(total[edge[1:]] - total[edge[:-1]] + marks)
            full = edge[1:] > edge[:-1]
            sums = sums & ~np.uint64(0xFF) | np.uint64(k & 0xFF)  # the level goes along in the last byte
            out.append(sums if len(full) - int(full.sum()) > slack else sums[full])
            levels.append(np.full(len(out[-1]), self.mark(k), np.int64))
        return np.concatenate(out).view(np.int64), np.concatenate(levels)


def _fingerprints(docs: DataFrame, n: int) -> DataFrame:
    """(id, n, k1, k2) of each document."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in utf8(b.column(1)):
            found = shingles(text, n)
            rows.append((len(found), *_digest(found)))
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))], names=["id", "n", "k1", "k2"])

    return map_batches(docs, run, "id long, n long, k1 long, k2 long")


def _starts(signs: np.ndarray) -> np.ndarray:
    """Where runs of equal signs begin, and the end."""
    return np.append(np.flatnonzero(np.concatenate(([True], signs[1:] != signs[:-1]))), len(signs))


_ROW = "sign long, node long, hub long"


def _row_batch(sign: np.ndarray, node: np.ndarray, hub: np.ndarray | None) -> pa.RecordBatch:
    """Rows of signatures (no hub), of signatures that stand for many sets (the node is its own hub), or of links to a hub."""
    return pa.RecordBatch.from_arrays([pa.array(sign), pa.array(node), pa.nulls(len(node), pa.int64()) if hub is None else pa.array(hub)], names=["sign", "node", "hub"])


def _combined(signs: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of a task's signatures; those of over BUCKET sets become links to the smallest and one row for them all."""
    sign, node = np.concatenate(signs), np.concatenate(nodes)
    order = np.lexsort((node, sign))
    sign, node = sign[order], node[order]
    at = _starts(sign)
    size = np.diff(at)
    many = np.repeat(size > BUCKET, size)
    yield _row_batch(sign[~many], node[~many], None)
    if many.any():
        hub = np.repeat(node[at[:-1]], size)[many]
        yield _row_batch(sign[at[:-1]][size > BUCKET], node[at[:-1]][size > BUCKET], node[at[:-1]][size > BUCKET])
        src, dst = np.unique(np.stack([node[many], hub])[:, node[many] != hub], axis=1)
        yield _row_batch(src, src, dst)


def _bucket_pairs(sign: np.ndarray, node: np.ndarray, many: np.ndarray, need: np.ndarray) -> list[np.ndarray]:
    """Of whole runs sorted by (sign, node): [src, dst, times, need]; a link to a hub counts as often as is needed."""
    at = _starts(sign)
    size = np.diff(at)
    star = (size > BUCKET) | np.logical_or.reduceat(many, at[:-1])
    out = [np.zeros((4, 0), np.int64)]
    inside = np.repeat(star, size)
    if inside.any():
        hub = np.repeat(node[at[:-1]], size)[inside]
        pair = np.stack([node[inside], hub])
        pair = np.unique(pair[:, pair[0] != pair[1]], axis=1)
        out.append(np.vstack((pair, np.ones((2, pair.shape[1]), np.int64) * (1 << 30))))
    for s in np.unique(size[~star & (size > 1)]).tolist():
        first = at[:-1][~star & (size == s)]
        own = node[first[:, None] + np.arange(s)]
        i, j = np.triu_indices(s, 1)
        level = np.repeat(need[sign[first] & 0xFF], len(i))
        out.append(np.stack([own[:, j].ravel(), own[:, i].ravel(), np.ones(len(level), np.int64), level]))
    found = np.concatenate(out, axis=1)
    found = found[:, found[0] != found[1]]
    if not found.shape[1]:
        return list(found)
    key, back, times = np.unique(found[[0, 1, 3]], axis=1, return_inverse=True, return_counts=True)
    total = np.zeros(key.shape[1], np.int64)
    np.maximum.at(total, back.ravel(), found[2])
    return [key[0], key[1], np.maximum(total, times), key[2]]


def _near(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(src, dst): pairs of nodes that may belong to one family; a node is the first half of a digest, marked by a level."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = Slices(num, den)
        for b in sliced(batches):
            signs, nodes, seen, held = [], [], set(), 0
            for text in utf8(b.column(1)):
                found = shingles(text, n)
                k1, _ = _digest(found)
                if len(found) and k1 not in seen:
                    seen.add(k1)
                    sign, marks = slices.signatures(found)
                    signs.append(sign)
                    nodes.append(marks ^ np.int64(k1))
                    held += len(sign)
                    if held > COMBINED:
                        yield from _combined(signs, nodes)
                        signs, nodes, held = [], [], 0
            if signs:
                yield from _combined(signs, nodes)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = Slices(num, den)
        slices.levels(1 << 40)
        need = np.full(256, 1 << 30, np.int64)
        for level, least in enumerate(slices.need):
            need[level & 0xFF] = min(need[level & 0xFF], least)
        sign, node, many = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)  # of a run that may go on

        def out(found: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["src", "dst", "times", "need"])

        for b in batches:
            own, hub = b.column(1).to_numpy(), b.column(2).fill_null(0).to_numpy()
            link = b.column(2).is_valid().to_numpy(zero_copy_only=False) & (own != hub)
            if link.any():
                yield out([own[link], hub[link], np.full(int(link.sum()), 1 << 30), np.ones(int(link.sum()), np.int64)])
            sign = np.concatenate((sign, b.column(0).to_numpy()[~link]))
            node = np.concatenate((node, own[~link]))
            many = np.concatenate((many, b.column(2).is_valid().to_numpy(zero_copy_only=False)[~link]))
            if not len(sign):
                continue
            same = np.concatenate(([True], (sign[1:] != sign[:-1]) | (node[1:] != node[:-1])))  # copies of a set in different tasks
            many = np.logical_or.reduceat(many, np.flatnonzero(same))
            sign, node = sign[same], node[same]
            last = int(_starts(sign)[-2])
            if last:
                yield out(_bucket_pairs(sign[:last], node[:last], many[:last], need))
                sign, node, many = sign[last:], node[last:], many[last:]
            if len(sign) > BUCKET:  # linked to the smallest at once; only that one is kept
                yield out(_bucket_pairs(sign, node, many, need))
                sign, node, many = sign[:1], node[:1], np.ones(1, bool)
        if len(sign):
            yield out(_bucket_pairs(sign, node, many, need))

    dealt = docs.mapInArrow(emit, _ROW).repartition("sign").sortWithinPartitions("sign", "node")
    pairs = dealt.mapInArrow(meet, "src long, dst long, times long, need long")
    return pairs.groupBy("src", "dst").agg(F.sum("times").alias("times"), F.min("need").alias("need")).where("times >= need").select("src", "dst")


def _bloom(ids: DataFrame, members: int) -> np.ndarray:
    """Bits of the ids' hashes, joined from one partial filter per task and a second level of 4."""
    size = BLOOM_LEAST
    while size < min(16 * members, BLOOM_MOST):
        size *= 2

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size // 8, np.uint8)
        for b in batches:
            for at in _bloom_bits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), size):
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], names=["bits"])

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size // 8, np.uint8)
        for b in batches:
            for blob in b.column(0):
                own |= np.frombuffer(blob.as_py(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], names=["bits"])

    out = np.zeros(size // 8, np.uint8)
    for r in ids.mapInArrow(bits, "bits binary").repartition(4).mapInArrow(either, "bits binary").toLocalIterator():
        out |= np.frombuffer(r.bits, np.uint8)
    return out


def _bloom_bits(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """The places of each id's bits in a filter of ``size`` bits, a power of two."""
    first, step = _mix(ids.view(np.uint64)), _mix(ids.view(np.uint64) + _M) | np.uint64(1)
    return [((first + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64) for k in range(BLOOM_HASHES)]


def trie_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (positions in ``sets``) among sets of distinct shingles."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) < 2 or not sizes.any():
        return []
    flat = np.concatenate(sets)
    values, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.full(len(values), -1, np.int64)  # global order of the group: most frequent first, those of one set nowhere
    order = np.argsort(-counts, kind="stable")[: int((counts > 1).sum())]
    rank[order] = np.arange(len(order))
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = rank[at]
    owner, column = owner[column >= 0], column[column >= 0]
    width = -(-max(1, len(order)) // 64)
    bits = np.zeros((len(sets), width), np.uint64)
    np.bitwise_or.at(bits, (owner, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    by_bits = np.lexsort(bits.T[: min(width, 64)][::-1])  # a prefix of the columns orders the trie's upper levels
    bits, sizes_by = bits[by_bits], sizes[by_bits]
    levels, edge, step = [], 0, 1
    while edge < width:  # levels of 64, 128, 256, ... shingles; the last holds the rest
        levels.append((edge, min(width, edge + step)))
        edge, step = edge + step, step * 2
    left = np.zeros((len(levels) + 1, len(sets)), np.int64)  # shingles that remain below each level
    for k in range(len(levels) - 1, -1, -1):
        left[k] = left[k + 1] + np.bitwise_count(bits[:, slice(*levels[k])]).sum(1, dtype=np.int64)
    parent = np.arange(len(sets))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # nodes of a level: runs of sets whose bits agree up to there
    new = np.zeros(len(sets), bool)
    new[0] = True
    nodes = []
    for lo, hi in levels:
        new[1:] |= (bits[1:, lo:hi] != bits[:-1, lo:hi]).any(1)
        first = np.flatnonzero(new)
        low = np.minimum.reduceat(sizes_by, first)
        nodes.append((first, np.append(first[1:], len(sets)), low, np.maximum.reduceat(sizes_by, first)))
    found: list[tuple[int, int]] = []
    for q0 in range(0, len(sets), 256):
        queries = np.arange(q0, min(q0 + 256, len(sets)))
        # the frontier: (query, node, overlap so far); it begins with the nodes of the first level that hold later sets
        q, child, overlap = queries, np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        begin, end = np.zeros(len(queries), np.int64), np.full(len(queries), len(sets))
        for k, (lo, hi) in enumerate(levels):
            first, last, low, high = nodes[k]
            a, b = np.searchsorted(first, begin), np.searchsorted(first, end)
            many = b - a
            q, overlap = np.repeat(q, many), np.repeat(overlap, many)
            child = np.repeat(a - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(int(many.sum()))
            keep = (last[child] > q + 1) & (high[child] * den >= sizes_by[q] * num) & (low[child] * num <= sizes_by[q] * den)
            q, child, overlap = q[keep], child[keep], overlap[keep]
            for c in range(lo, hi):
                overlap += np.bitwise_count(bits[q, c] & bits[first[child], c])
            rest = np.minimum(left[k + 1][q], np.maximum.reduceat(left[k + 1], first)[child])
            keep = (overlap + rest) * (num + den) >= num * (sizes_by[q] + low[child])
            q, child, overlap = q[keep], child[keep], overlap[keep]
            begin, end = first[child], last[child]
        for x, start, stop, both in zip(q.tolist(), begin.tolist(), end.tolist(), overlap.tolist(), strict=True):
            for y in range(max(start, x + 1), stop):
                if both * den >= num * (sizes_by[x] + sizes_by[y] - both):
                    a, b = root(x), root(y)
                    if a != b:
                        parent[b] = a
                        found.append((int(by_bits[x]), int(by_bits[y])))
    return found


def _members_linked(groups: DataFrame, num: int, den: int) -> DataFrame:
    """(src, dst): links within each run of equal (family, block_a, block_b); rows come sorted by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def links() -> pa.RecordBatch:
            pairs = trie_links(sets, num, den)
            return pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in pairs], pa.int64()), pa.array([ids[b] for _, b in pairs], pa.int64())], names=["src", "dst"])

        for b in batches:
            for own, name, blob in zip(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True), b.column(3).to_pylist(), b.column(4), strict=True):
                if own != key and sets:
                    yield links()
                    ids, sets = [], []
                key = own
                ids.append(name)
                sets.append(np.frombuffer(blob.as_py(), np.uint64))
        if sets:
            yield links()

    return groups.mapInArrow(run, "src long, dst long")


def _blocks(members: DataFrame) -> DataFrame:
    """(family, blocks) of families of two or more sets: one block, or so many that any two blocks make a group."""
    blocks = F.greatest(F.ceil(2 * F.col("shingles") / GROUP_SHINGLES), F.ceil(2 * F.col("sets") / GROUP_SETS))
    sizes = members.groupBy("family").agg(F.sum("n").alias("shingles"), F.count("*").alias("sets")).where("sets > 1")
    return sizes.select("family", F.when((F.col("shingles") <= GROUP_SHINGLES) & (F.col("sets") <= GROUP_SETS), 1).otherwise(blocks).cast("int").alias("blocks"))


def _with_sets(members: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """``members`` with the ``set`` of each."""
    sets = _sets(docs, _bloom(members.select("rep"), members.count()), n)
    own = members.withColumnsRenamed({"k1": "m1", "k2": "m2"}).join(sets, (F.col("m1") == F.col("k1")) & (F.col("m2") == F.col("k2")))
    return own.select(*members.columns, "set")


def _may_link(split: DataFrame, num: int, den: int) -> DataFrame:
    """Of the sets of large families those that may link: x links with y only if they share ``num / den`` of x's shingles, so a set
    with more shingles that no other set of its family has links with none.  Families are mostly chains of such sets, by passages that they share."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 64):
                part = b.slice(lo, 64)
                sets = [np.frombuffer(x.as_py(), np.uint64) for x in part.column(2)]
                size = [len(x) for x in sets]
                family, rep = (np.repeat(part.column(i).to_numpy(), size) for i in range(2))
                yield pa.RecordBatch.from_arrays([pa.array(family), pa.array(rep), pa.array(np.concatenate(sets).view(np.int64))], names=["family", "rep", "shingle"])

    each = split.select("family", "rep", "set").mapInArrow(explode, "family long, rep long, shingle long")
    lone = each.groupBy("family", "shingle").agg(F.count("*").alias("sets"), F.min("rep").alias("rep")).where("sets = 1")
    alone = lone.groupBy(F.col("family").alias("_f"), F.col("rep").alias("_r")).agg(F.count("*").alias("_alone"))
    out = split.join(alone, (F.col("family") == F.col("_f")) & (F.col("rep") == F.col("_r")), "left")
    return out.where((F.col("n") - F.coalesce("_alone", F.lit(0))) * den >= num * F.col("n")).select(split.columns)


def _dealt(members: DataFrame, turn: int = 0, turns: int = 1) -> DataFrame:
    """Groups of sets, sorted by group: a family of one block, else each two blocks; of these the ones whose distance around the circle of blocks falls in this turn."""
    own = F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int")
    gap = lambda x: F.least(F.pmod(x - F.col("own"), F.col("blocks")), F.pmod(F.col("own") - x, F.col("blocks")))
    other = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (x != F.col("own")) & ((gap(x) - 1) % turns == turn))
    alone = F.array(F.lit(0)) if turn == 0 else F.array().cast("array<int>")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.when(F.col("blocks") == 1, alone).otherwise(other)))
    groups = dealt.select("family", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "rep", "set")
    return groups.repartition("family", "block_a", "block_b").sortWithinPartitions("family", "block_a", "block_b")


def jaccard_components(docs: DataFrame, n: int = 3, threshold: tuple[int, int] = (90, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row; ids are long integers, the threshold a fraction."""
    bound_batches(docs)
    num, den = threshold
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    rows = materialise(_fingerprints(picked, n), "fingerprints")
    nodes = rows.where("n > 0 and id is not null").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.first("n").alias("n"))
    families = connected_components(_near(picked, n, num, den)).select(F.col("node").alias("k"), F.col("component").alias("family"))
    slices = Slices(num, den)
    slices.levels(rows.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])
    plan = [(first, most, slices.mark(k)) for k, (first, (most, *_)) in enumerate(zip(slices.first, slices.plan, strict=False))]
    own = F.filter(F.array(*[F.struct(*map(F.lit, x)) for x in plan]), lambda x: (x["col1"] <= F.col("n")) & (F.col("n") <= x["col2"])) if plan else F.array()
    marked = nodes.withColumn("level", F.explode(own)).withColumn("node", F.col("k1").bitwiseXOR(F.col("level.col3"))) if plan else nodes.withColumn("node", F.col("k1"))
    members = materialise(marked.join(families, F.col("node") == F.col("k")).select("k1", "k2", "rep", "n", "family"), "members")
    sizes = _blocks(members)
    total, large = members.join(sizes, "family").agg(F.sum("n"), F.max("blocks")).first()
    links = _members_linked(_dealt(_with_sets(members.join(sizes.where("blocks = 1"), "family"), picked, n)), num, den)
    if (large or 0) > 1:
        split = materialise(_with_sets(members.join(sizes.where("blocks > 1"), "family"), picked, n).drop("blocks"), "split")
        split = materialise(_may_link(split, num, den), "split")
        split = split.join(_blocks(split), "family")
        most, again = split.agg(F.max("blocks"), F.sum(F.col("n") * F.greatest(F.col("blocks") - 1, F.lit(1)))).first()
        turns = max(1, min((most or 0) // 2, math.ceil((again or 0) / total)))  # what a turn deals out is little more than all sets once
        for turn in range(turns):
            links = links.union(materialise(_members_linked(_dealt(split, turn, turns), num, den), "links"))
    components = connected_components(links).select(F.col("node").alias("rep_node"), "component")
    reps = nodes.select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), "rep").join(components, F.col("rep") == F.col("rep_node"), "left")
    reps = reps.select("r1", "r2", F.coalesce("component", "rep").alias("root"))
    out = rows.join(reps, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")) & (F.col("n") > 0) & F.col("id").isNotNull(), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))


def _sets(docs: DataFrame, bloom: np.ndarray, n: int) -> DataFrame:
    """(k1, k2, set), once per digest, of documents that the filter passes."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = shared.value
        for b in sliced(batches):
            b = b.filter(b.column(0).is_valid())
            places = _bloom_bits(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), 8 * len(filter_))
            b = b.filter(pa.array(np.logical_and.reduce([(filter_[at >> 3] >> (at & 7) & 1).astype(bool) for at in places])))
            sets = [shingles(text, n) for text in utf8(b.column(1))]
            keys = [_digest(s) for s in sets]
            columns = [*(pa.array([k[i] for k in keys], pa.int64()) for i in range(2)), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "set"])

    return docs.mapInArrow(run, "k1 long, k2 long, set binary").dropDuplicates(["k1", "k2"])


def keep_one(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id; of rows that share this id, all whose id it is."""
    found = jaccard_components(docs, n, threshold, id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("_gone"), "left_anti")
