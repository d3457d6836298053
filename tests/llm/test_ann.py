import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelloom.llm import ann


def test_hilbert_visits_neighbours():
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        key = ann.hilbert(points, bits)
        assert sorted(key.tolist()) == list(range(len(points)))
        walk = points[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def brute(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    good = [(i, v) for i, v in good if len(v) == 8]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            out[q] = sorted(((-float((x * y).sum()), i) for i, y in good if i != q))[:k]
    return out


@pytest.mark.parametrize("block_rows", [2_000, 20])
def test_equals_brute_force_and_recall(spark, monkeypatch, block_rows):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(ann, "CHUNK_ROWS", 64)
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + 0.3 * r.normal(size=8)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(90)]  # a hot vector, with a tie beyond k
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [math.nan] * 8), (2080, [math.inf] * 8), (None, [1.0] * 8), (2100, [1.0] * 7)]
    df = spark.createDataFrame([(*x, 0.0) for x in rows], "vec_id long, embedding array<double>, score double").repartition(3)
    got = {}
    for x in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        assert [x[0] for x in got[q]] == list(range(1, 21))
        scores = [(-x[2], x[1]) for x in got[q]]
        assert scores == sorted(scores)
        hits += len({i for _, i in best} & {x[1] for x in got[q]})
        if block_rows == 2_000:  # one block: all candidates are met
            assert [x[1] for x in got[q]] == [i for _, i in best]
    assert hits / (20 * len(want)) >= 0.9


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(x) for x in ann.nearest(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 0.5)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_ids_count_once(spark, monkeypatch):
    """An id 25 times among 35 others: its best row counts, and the others still fill the ranks, in one chunk or in several."""
    r = np.random.default_rng(5)
    rows = [(0, [1.0] * 8)] + [(7, [2.0 - 0.01 * i] * 8) for i in range(25)] + [(10 + i, r.normal(size=8).tolist()) for i in range(35)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    best = {}
    for i, v in rows[1:]:
        best[i] = max(best.get(i, -1e9), float(np.sum(v)))
    want = sorted(((-s, i) for i, s in best.items()))[:20]
    for chunk in (20_000, 9):
        monkeypatch.setattr(ann, "CHUNK_ROWS", chunk)
        got = ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
        assert [x.rank for x in got] == list(range(1, 21)) and [x.vec_id for x in got] == [i for _, i in want]
        assert [x.score for x in got] == pytest.approx([-s for s, _ in want])


def _recall(spark, x, **how):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, **how).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score, kind="stable")[:20].tolist()))
    return hits / (20 * len(got))


def test_recall_on_the_tables_vectors(spark, monkeypatch):
    """The vectors of the test table, which are spread evenly, in blocks of fixed size: the reach grows until the recall is there."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    x = np.array([r.embedding for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()], float)
    assert _recall(spark, x) >= 0.9


def test_reach_is_small_where_vectors_have_structure(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 16))
    x = centres[np.arange(2_000) % 40] + 0.05 * r.normal(size=(2_000, 16))
    found = []
    measured = ann._reach
    monkeypatch.setattr(ann, "_reach", lambda *a: found.append(measured(*a)) or found[-1])
    assert _recall(spark, x) >= 0.9 and found[0] <= 2  # of 40 blocks
