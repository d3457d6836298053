"""Approximate nearest neighbours on shifted space-filling curves (operator 9).

Every vector is projected several times onto a few random orthonormal directions, shifted, quantised and put
in the order of the Hilbert curve.  Each curve's order is cut into blocks of about ``BLOCK_ROWS`` rows by approximate
quantiles, and as many of these as the reach says are merged into one window; a query is compared with its own window and the
neighbouring ones, on every curve, and the curves' best are merged.  Inner products are computed in double precision on the original vectors.

For the largest inner product, vectors are scaled by the largest norm and get one more coordinate that completes them
to unit length, while queries are scaled to unit length; near on the sphere then means a large inner product.

*Reach.*  How far along a curve neighbours lie depends on the vectors: a few blocks where they have structure, a share of all blocks
where they are spread evenly over the sphere.  So it is measured: the exact neighbours of ``SAMPLE`` queries (those of smallest id hash) are
found among all rows, and the reach is the smallest number of blocks at which ``TARGET`` of them are within it on some curve, one at least.
What a query gives and takes is in proportion to three windows a curve whatever the reach.
Every row is indexed, whatever the sample.

*Scale.*  A row is shuffled once a curve.  Blocks have a fixed size up to ``MOST_BLOCKS`` of them, which bounds what the driver sees: block
bounds, block sizes and the sample's neighbours.  Blocks that are too large for one task, such as that of a vector with very
many copies, are split by hash into chunks of at most about ``CHUNK_ROWS`` rows, and each chunk serves the block's queries
in batches.  Equal bounds are one, so no block is empty for a key that holds several quantiles.  A chunk returns a query's ``k`` best, never all pairs.

*Recall.*  ``tests/llm/test_ann.py`` measures it against brute force, on vectors with and without structure and on those of the test table.
Below two blocks of rows the order isn't cut, so small tables are searched in full.

Defined cases: vectors that are null, zero, or hold a null, NaN or infinity take no part, nor do those whose
dimension isn't the most frequent one or whose id is null; rows of a query's
own id are not its neighbours; ties go to the smaller id; of repeated ids the best pair counts; fewer candidates than
``k`` are all returned; no queries or an empty table give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelloom.llm.arrow import bound_batches
from pixelloom.sources.storage import materialise

#: Curves; projected dimensions and bits each (at most 62 in all).
CURVES, DIMENSIONS, BITS = 10, 10, 6
#: Rows of a block, most blocks of a curve, most rows of a chunk, queries compared at once, rows handed on at once.
BLOCK_ROWS, MOST_BLOCKS, CHUNK_ROWS, QUERY_BATCH, DEALT_ROWS = 2_000, 4_096, 20_000, 512, 10_000
#: Queries whose exact neighbours set the reach, and the share of these that has to be met.
SAMPLE, TARGET = 128, 0.96
SEED = 20


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (n, d) with so many bits a coordinate.

    Works from the top bit down: each level's corner of the cube is read as a Gray code, and the
    remaining bits are reflected and exchanged as the curve turns within that corner."""
    x = [c.astype(np.int64) for c in points.T]
    d = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(d):
            high = (x[i] >> level & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[-1] >> level & 1, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ turn) >> level & 1)
    return key


def _directions(dim: int, curves: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (curves, dim + 1, d) and shifts (curves, d), the same for every worker."""
    r = np.random.default_rng(SEED)
    d = min(dimensions, dim + 1)
    return np.stack([np.linalg.qr(r.normal(size=(dim + 1, d)))[0] for _ in range(curves)]), r.random((curves, d)) / 2


def keys(unit: np.ndarray, directions: np.ndarray, shifts: np.ndarray, bits: int) -> np.ndarray:
    """(n, curves): positions of unit vectors on each curve."""
    out = []
    for own, shift in zip(directions, shifts, strict=True):
        y = np.clip((unit @ own) * np.sqrt(unit.shape[1]) / 8 + 0.5, 0, 1) / 2 + shift
        out.append(hilbert(np.minimum((y * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits))
    return np.stack(out, axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _usable(df: DataFrame, is_query: Column, id_col: str, vector_col: str) -> tuple[DataFrame, int, float]:
    """(id, vec, asked) of the vectors that take part, packed as doubles, and whether they are queries; their dimension and the largest norm."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    asked = F.coalesce(is_query.cast("boolean"), F.lit(False)).alias("asked")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), asked).where(F.col("id").isNotNull() & v.isNotNull() & fine)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("norm")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        return rows, 0, 1.0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.ascontiguousarray(b.column(1).flatten().to_numpy(zero_copy_only=False), "<f8").reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in flat], pa.binary()), b.column(2)], names=["id", "vec", "asked"])

    return rows.where(F.size("v") == dims.dim).mapInArrow(pack, "id long, vec binary, asked boolean"), dims.dim, dims.norm


def _best(query_ids: np.ndarray, queries: np.ndarray, own: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of the query, position in ``x``, score) of each query's ``k`` best rows of different ids, ties to the smaller id; its own id is none."""
    score = queries @ x.T
    score[query_ids[:, None] == own[None, :]] = -np.inf
    by_id = score
    if len(own) > k and len(first := np.flatnonzero(np.concatenate(([True], np.diff(np.sort(own)) > 0)))) < len(own):  # an id counts once
        by_id = np.maximum.reduceat(score[:, np.argsort(own, kind="stable")], first, axis=1)
    least = np.partition(by_id, -k, axis=1)[:, -k] if by_id.shape[1] > k else np.full(len(query_ids), -np.inf)
    out = []
    for i, q in enumerate(query_ids.tolist()):
        at = np.flatnonzero((score[i] >= least[i] - 1e-9 * max(1.0, abs(least[i]))) & (own != q))
        exact = (queries[i] * x[at]).sum(1)  # the same sum for equal vectors wherever they lie
        order = np.lexsort((own[at], -exact))
        order = order[np.sort(np.unique(own[at][order], return_index=True)[1])[:k]]
        out.append((np.full(len(order), i), at[order], exact[order]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _bounds(table: DataFrame, curves: int, parts: int) -> list[np.ndarray]:
    """Keys at which each curve's blocks begin; equal quantiles are one bound."""
    if parts < 2:
        return [np.zeros(0, np.int64)] * curves
    shares = [i / parts for i in range(1, parts)]
    found = table.select(F.posexplode("keys").alias("curve", "key")).groupBy("curve").agg(F.percentile_approx("key", shares, max(10_000, 10 * parts)).alias("b"))
    bounds = {r.curve: np.unique(np.array(r.b, np.int64)) for r in found.collect()}
    return [bounds.get(c, np.zeros(0, np.int64)) for c in range(curves)]


def _block_of(bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, keys, "right")


def _keys_of(column: pa.Array, curves: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, curves)


def _reach(table: DataFrame, bounds: list[np.ndarray], k: int, dim: int) -> int:
    """The least number of blocks on either side that holds TARGET of the exact neighbours of a sample of queries."""
    curves = len(bounds)
    sample = table.where("asked").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "vec", "query_keys").collect()
    if not sample or not any(len(b) for b in bounds):
        return 0
    ids, vectors = np.array([r.id for r in sample]), np.stack([np.frombuffer(r.vec, "<f8") for r in sample])
    shared = table.sparkSession.sparkContext.broadcast((ids, vectors))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = shared.value
        for b in batches:
            if b.num_rows:
                q, at, score = _best(ids, vectors, b.column(0).to_numpy(), _matrix(b.column(1), dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(q), b.column(0).take(pa.array(at)), pa.array(score), b.column(2).take(pa.array(at))], names=["q", "id", "score", "keys"])

    near = table.select("id", "vec", "keys").mapInArrow(exact, "q long, id long, score double, keys array<long>")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("q", "keys").collect()  # SAMPLE * k rows
    if not found:
        return 0
    asked = np.stack([np.array(r.query_keys, np.int64) for r in sample])[[r.q for r in found]]
    keys = np.stack([np.array(r["keys"], np.int64) for r in found])
    apart = np.stack([np.abs(_block_of(b, keys[:, c]) - _block_of(b, asked[:, c])) for c, b in enumerate(bounds)], axis=1).min(1)
    return int(np.sort(apart)[min(len(apart) - 1, math.ceil(TARGET * len(apart)))])


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", curves: int = CURVES, reach: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best found for every query row, by inner product; ids are long integers.

    ``is_query`` is a condition on the id column of ``df``; candidates are all rows of another id than the query's.  Without ``reach`` it is measured."""
    bound_batches(df)
    spark = df.sparkSession
    usable, dim, norm = _usable(df, is_query, id_col, vector_col)
    if not dim:
        return usable.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    directions, shifts = _directions(dim, curves, DIMENSIONS)
    bits = min(BITS, 62 // directions.shape[2])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim)
            size = np.sqrt((x * x).sum(1))
            stored = np.column_stack((x / norm, np.sqrt(np.maximum(0, 1 - (size / norm) ** 2))))
            asked = np.column_stack((x / size[:, None], np.zeros(len(x))))
            own = [keys(u, directions, shifts, bits) for u in (stored, asked)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *(pa.array(list(o), pa.list_(pa.int64())) for o in own), b.column(2)], names=["id", "vec", "keys", "query_keys", "asked"])

    table = materialise(usable.mapInArrow(index, "id long, vec binary, keys array<long>, query_keys array<long>, asked boolean"), "curves")
    bounds = _bounds(table, curves, max(1, min(MOST_BLOCKS, table.count() // BLOCK_ROWS)))
    reach = max(1, _reach(table, bounds, k, dim) if reach is None else reach)
    bounds = [b[reach - 1 :: reach] for b in bounds]  # windows of ``reach`` blocks: what is within the reach is in a neighbouring one
    limits = spark.sparkContext.broadcast(bounds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(b) + 1, np.int64) for b in limits.value]
        for b in batches:
            own = _keys_of(b.column(0), curves)
            for c, n in enumerate(total):
                n += np.bincount(_block_of(limits.value[c], own[:, c]), minlength=len(n))
        for c, n in enumerate(total):
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), c)), pa.array(at), pa.array(n[at])], names=["curve", "block", "n"])

    chunks = [np.ones(len(b) + 1, np.int64) for b in bounds]
    for r in table.select("keys").mapInArrow(count, "curve long, block long, n long").groupBy("curve", "block").agg(F.sum("n").alias("n")).collect():  # a row a block
        chunks[r.curve][r.block] = -(-r.n // CHUNK_ROWS)
    shared = spark.sparkContext.broadcast(chunks)
    schema = "curve int, block int, chunk int, asks boolean, id long, vec binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = shared.value
        for b in batches:
            own, query = _keys_of(b.column(2), curves), _keys_of(b.column(3), curves)
            ids, asks = b.column(0).to_numpy(), np.flatnonzero(b.column(4).to_numpy(zero_copy_only=False))
            spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            for c, limit in enumerate(limits.value):
                at = _block_of(limit, own[:, c])
                yield from dealt_rows(c, at, spread % many[c][at], False, np.arange(b.num_rows), b)
                home = _block_of(limit, query[asks, c])
                for near in (-1, 0, 1):
                    there = np.flatnonzero((home + near >= 0) & (home + near < len(many[c])))
                    for lo in range(0, len(there), QUERY_BATCH):
                        some = there[lo : lo + QUERY_BATCH]
                        times = many[c][home[some] + near]
                        for k in range(int(times.max(initial=0))):  # a block of many chunks: one after the other
                            has = some[times > k]
                            yield from dealt_rows(c, home[has] + near, np.full(len(has), k), True, asks[has], b)

    def dealt_rows(c: int, at: np.ndarray, chunk: np.ndarray, asks: bool, rows: np.ndarray, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(rows), DEALT_ROWS):
            cut = slice(lo, lo + DEALT_ROWS)
            take = pa.array(rows[cut])
            columns = [pa.array(np.full(len(take), c, np.int32)), pa.array(at[cut].astype(np.int32)), pa.array(chunk[cut].astype(np.int32)), pa.array(np.full(len(take), asks)), b.column(0).take(take), b.column(1).take(take)]
            yield pa.RecordBatch.from_arrays(columns, names=["curve", "block", "chunk", "asks", "id", "vec"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, rows = None, [], []  # the chunk's candidates, which come before its queries
        x = own = None
        for b in batches:
            label = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
            asks = b.column(3).to_numpy(zero_copy_only=False)
            change = np.concatenate(([0], np.flatnonzero((label[1:] != label[:-1]).any(1) | (asks[1:] != asks[:-1])) + 1, [b.num_rows]))
            for lo, hi in zip(change[:-1].tolist(), change[1:].tolist(), strict=True):
                if lo == hi:
                    continue
                if (now := tuple(label[lo].tolist())) != group:
                    group, ids, rows, x = now, [], [], None
                part = b.slice(lo, hi - lo)
                if not asks[lo]:
                    ids.append(part.column(4).to_numpy())
                    rows.append(_matrix(part.column(5), dim))
                    x = None
                elif rows:
                    if x is None:
                        x, own = np.concatenate(rows), np.concatenate(ids)
                        rows, ids = [x], [own]
                    for lo_q in range(0, part.num_rows, QUERY_BATCH):
                        some = part.slice(lo_q, QUERY_BATCH)
                        q, at, score = _best(some.column(4).to_numpy(), _matrix(some.column(5), dim), own, x, k)
                        yield pa.RecordBatch.from_arrays([some.column(4).take(pa.array(q)), pa.array(own[at]), pa.array(score)], names=["query_id", "vec_id", "score"])

    dealt = table.mapInArrow(deal, schema).repartition("curve", "block", "chunk").sortWithinPartitions("curve", "block", "chunk", "asks")
    pairs = dealt.mapInArrow(search, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
