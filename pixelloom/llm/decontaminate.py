"""Benchmark decontamination with a generalised suffix automaton (operator 2).

The words of all test items are read into one suffix automaton.  A document's words
are streamed through it; at every word the automaton knows the longest run
of words, ending there, that occurs in some item.  A run of ``window`` words (or a whole
item that has fewer) makes its words *hit*.  ``match`` reports hits, ``decontaminate``
cuts the hit spans out of the texts and drops documents of which too much was hit.

Words that occur in no item reset the automaton, so only stretches of item words are
streamed; the test for that is one dictionary lookup per word.

The items are broadcast only up to ``block_words`` words; a larger benchmark is
dealt into several automata.  Documents are then written once with a row number, every automaton reads them and writes
what it finds, and the finds, small beside the texts, meet by row; results don't depend on the number of automata.
With one automaton all is a narrow map without a shuffle.

Defined cases: a null or empty text has no words, hence no hits; an item with null id, null
text or no words is never found; equal items are each reported; several rows of one
item id are one item; documents may repeat and each row is judged alone; an empty
document table or benchmark gives zero rows or zero hits.  ``match`` reads the id and
text columns only; ``decontaminate`` returns all columns as they came, whatever their
names, since it works by position.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pixelloom.llm.arrow import kind_of, map_batches, utf8
from pixelloom.sources.storage import materialise

#: Consecutive item words that make a hit.
WINDOW = 10
#: Most item words in one broadcast automaton (about 400 bytes each).
BLOCK_WORDS = 500_000

#: A-Z to a-z; every other ASCII character that is no letter or digit to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_PAIR = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, ASCII letters lowered."""
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of many word sequences, with the items that each window occurs in."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        read = []
        for name, text in items:
            if seq := [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]:
                read.append((number[name], seq))
                last = 0
                for w in seq:
                    last = self._extend(last, w)
        self.least = min([window, *(len(s) for _, s in read)])
        #: by state: items in which the window that ends there occurs; whole short items (length, item).
        self.items: list[set[int]] = [set() for _ in self.len]
        self.short: list[list[tuple[int, int]]] = [[] for _ in self.len]
        for item, seq in read:
            state, size = 0, len(seq)
            for at, w in enumerate(seq, 1):
                state = self.next[state][w]
                if at >= window:
                    self.items[self._at_window(state)].add(item)
            if size < window:
                self.short[state].append((size, item))
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.found: list[list[tuple[int, int]]] = [[] for _ in self.len]
        for v in order[1:]:
            self.found[v] = self.found[self.link[v]] + self.short[v]
        self.home = [self._at_window(v) for v in range(len(self.len))]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, size = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            if size[q] == size[last] + 1:
                return q
            return self._split(last, w, q)
        new = len(size)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of state q for its strings up to p's length plus one."""
        copy = len(self.len)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = copy
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _at_window(self, v: int) -> int:
        """The state of the last ``window`` words of v's strings, or v itself if shorter."""
        while v > 0 and self.len[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int], int]:
        """(number of words, hit spans as word positions, item numbers, longest matched length)."""
        seq = words(text)
        if len(seq) < self.least or not self.names:
            return len(seq), [], set(), 0
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in seq), np.int64, len(seq))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).view(np.int8)))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        longest = 0
        starts, ends = edge[::2], edge[1::2]
        for k in np.flatnonzero(ends - starts >= self.least).tolist():
            longest = max(longest, self._stream(ids[starts[k] : ends[k]].tolist(), int(starts[k]), spans, items))
        return len(seq), spans, items, longest

    def _stream(self, ids: list[int], base: int, spans: list[tuple[int, int]], items: set[int]) -> int:
        nxt, link, size, window, longest = self.next, self.link, self.len, self.window, 0
        v = length = 0
        for i, w in enumerate(ids, base):
            while v and w not in nxt[v]:
                v = link[v]
                length = size[v]
            if w in nxt[v]:
                v = nxt[v][w]
                length += 1
            longest = max(longest, length)
            reach = 0
            if length >= window:
                reach = window
                items |= self.items[self.home[v]]
            for k, item in self.found[v]:
                if k <= length:
                    items.add(item)
                    reach = max(reach, k)
            if reach:
                start = i - reach + 1
                while spans and start <= spans[-1][1]:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return longest


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them; a line break takes their place."""
    at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, done = [], 0
    for start, end in spans:
        out.append(text[done : at[start][0]])
        done = at[end - 1][1]
    return b"\n".join([*out, text[done:]])


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> tuple[int, Iterator[Automaton]]:
    """How many blocks of about ``block_words`` words at most the different items make, and their automata, made one at a time."""
    picked = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("body")).where("item is not null and body is not null").distinct()
    total = picked.agg(F.sum(F.size(F.split("body", "[^A-Za-z0-9\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    n = max(1, -(-total // block_words))

    def automata() -> Iterator[Automaton]:
        for k in range(n):
            own = picked if n == 1 else picked.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k)
            yield Automaton([(r.item, r.body.encode()) for r in own.collect()], window)  # a block of bounded size

    return n, automata()


_LOADED: dict[int, Automaton] = {}


def _loaded(shared) -> Automaton:
    """The broadcast automaton, unpickled once per worker."""
    if shared._jbroadcast_id not in _LOADED:
        _LOADED.clear()
        _LOADED[shared._jbroadcast_id] = pickle.loads(shared.handle.value)
    return _LOADED[shared._jbroadcast_id]


class _Shared:
    def __init__(self, spark, automaton: Automaton):
        self.handle = spark.sparkContext.broadcast(pickle.dumps(automaton))
        self._jbroadcast_id = self.handle._jbroadcast.id() if self.handle._jbroadcast else id(self)


def match(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(id, n_words, longest, spans, items): hit spans as half-open word ranges, merged and ascending; items sorted as strings."""
    found = "n_words long, longest long, spans array<struct<start:long,end:long>>, items array<string>"
    state = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_body"), F.monotonically_increasing_id().alias("_row"))
    kind = kind_of(state, "_id")
    names = ["_row", "_id", "n_words", "longest", "spans", "items"]
    n, automata = _blocks(items, item_id_col, item_text_col, window, block_words)
    if n > 1:
        state = materialise(state, "decontaminate")  # the blocks' finds meet by row
    parts = []
    for k, automaton in enumerate(automata):
        shared = _Shared(docs.sparkSession, automaton)

        def run(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            own = _loaded(shared)
            rows = [own.scan(text) for text in utf8(b.column(1))]
            n_words, spans, items, longest = ([r[i] for r in rows] for i in range(4))
            spans = [[{"start": x, "end": y} for x, y in s] for s in spans]
            items = [sorted(own.names[x] for x in i) for i in items]
            columns = [b.column(2), b.column(0), pa.array(n_words, pa.int64()), pa.array(longest, pa.int64()), pa.array(spans, pa.list_(_PAIR)), pa.array(items, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        part = map_batches(state, run, f"_row long, _id {kind}, {found}")
        parts.append(part if n == 1 else materialise(part if k == 0 else part.where("longest > 0"), "decontaminate"))
    if n == 1:
        return parts[0].select(F.col("_id").alias(id_col), *names[2:])
    both = lambda c: F.flatten(F.collect_list(c)).alias(c)  # noqa: E731 what one document hits
    met = functools.reduce(DataFrame.unionAll, parts).groupBy("_row").agg(F.first("_id").alias("_id"), F.max("n_words").alias("n_words"), F.max("longest").alias("longest"), both("spans"), both("items"))

    def merge(b: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"start": x, "end": y} for x, y in _merged([(x["start"], x["end"]) for x in s])] for s in b.column(4).to_pylist()]
        items = [sorted(set(i)) for i in b.column(5).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(spans, pa.list_(_PAIR)), pa.array(items, pa.list_(pa.string()))], names=names)

    return map_batches(met, merge, f"_row long, _id {kind}, {found}").select(F.col("_id").alias(id_col), *names[2:])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with hit spans cut out of the text; documents of which more than ``max_coverage`` of the words were hit are dropped.

    Coverage and cuts are those of the spans merged over all blocks.  Cutting is repeated over all blocks until no window is left,
    as the two sides of a cut could make one."""
    at = docs.columns.index(text_col)
    automata = [_Shared(docs.sparkSession, automaton) for automaton in _blocks(items, item_id_col, item_text_col, window, block_words)[1]]
    if len(automata) > 1:
        return _decontaminate_blocks(docs, at, automata, max_coverage)
    shared = automata[0]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        own, texts, keep = _loaded(shared), [], []
        for given, text in zip(b.column(at).is_valid().to_pylist(), utf8(b.column(at)), strict=True):
            n, spans, _, _ = own.scan(text)
            keep.append(sum(e - s for s, e in spans) <= max_coverage * n)
            while spans:
                text = cut(text, spans)
                _, spans, _, _ = own.scan(text)
            texts.append(text if given else None)
        columns = list(b.columns)
        columns[at] = pa.array(texts, pa.binary()).cast(b.column(at).type)
        return pa.RecordBatch.from_arrays(columns, names=b.schema.names).filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run, docs.schema)


def _decontaminate_blocks(docs: DataFrame, at: int, automata: list[_Shared], max_coverage: float) -> DataFrame:
    """Rounds over all blocks: every block finds spans in the texts as they are, the spans of a row are merged and cut at once;
    rows without any are done, the others have another round.  Texts are written once a round, not once a block."""
    plain = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])  # names may clash in a file
    names = plain.columns
    kinds = StructType([*plain.schema, *StructType.fromDDL("_row long, _hit boolean")])

    def found(state: DataFrame, shared: _Shared) -> DataFrame:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            own = _loaded(shared)
            spans = [[{"start": x, "end": y} for x, y in own.scan(text)[1]] for text in utf8(b.column(1))]
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(_PAIR))], names=["_row", "_spans"])

        hits = map_batches(state.select("_row", names[at]), run, "_row long, _spans array<struct<start:long,end:long>>")
        return materialise(hits.where(F.size("_spans") > 0), "decontaminate")

    def cut_all(state: DataFrame, judged: bool) -> DataFrame:
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            texts, keep, hit = [], [], b.column(b.num_columns - 1).is_valid()
            for given, text, own in zip(b.column(at).is_valid().to_pylist(), utf8(b.column(at)), b.column(b.num_columns - 1).to_pylist(), strict=True):
                spans = _merged([(x["start"], x["end"]) for x in own or ()])
                keep.append(not spans or not judged or sum(e - s for s, e in spans) <= max_coverage * len(words(text)))
                texts.append((cut(text, spans) if spans else text) if given else None)
            columns = [*b.columns[:-1], hit]
            columns[at] = pa.array(texts, pa.binary()).cast(b.column(at).type)
            return pa.RecordBatch.from_arrays(columns, names=kinds.names).filter(pa.array(keep, pa.bool_()))

        hits = functools.reduce(DataFrame.unionAll, [found(state, shared) for shared in automata])
        hits = hits.groupBy("_row").agg(F.flatten(F.collect_list("_spans")).alias("_spans"))  # what one document hits
        return materialise(map_batches(state.join(hits, "_row", "left").select(*names, "_row", "_spans"), run, kinds), "decontaminate")

    done, judged = [], True
    state = materialise(plain.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
    while not state.isEmpty():
        state, judged = cut_all(state, judged), False
        done.append(state.where(~F.col("_hit")).select(names))
        state = state.where("_hit").drop("_hit")
    return functools.reduce(DataFrame.unionAll, done, docs.sparkSession.createDataFrame([], docs.schema))
