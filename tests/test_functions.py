import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelloom.config import DedupConfig, base, memory_efficient, multithreaded, sized_for
from pixelloom.functions import images as I
from pixelloom.functions import paths as P
from pixelloom.functions import vectors as V


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_vector_similarities(spark):
    a, b = F.col("a"), F.col("b")
    rows = [([1.0, 2.0, 3.0], [1.1, 2.1, 3.1]), ([1.0, 0.0, 0.0], [0.0, 1.0, 0.0]), ([0.0] * 3, [1.0] * 3), (None, [1.0] * 3)]
    got = one(spark, rows, "a array<double>, b array<double>", V.cosine(a, b), V.color_cosine(a, b), V.raw_cosine(a, b))
    assert got[0][0] > 0.99 and got[1] == (0.0, 0.5, 0.0) and got[2] == (0.0, 0.0, 0.0) and got[3] == (0.0, 0.0, 0.0)
    assert one(spark, [([3.0, 4.0],)], "a array<double>", V.normalise(a)) == [([0.6, 0.8],)]


def test_hamming_plain_and_packed(spark):
    r = random.Random(1)
    rows = [([r.randrange(2) for _ in range(n)], [r.randrange(2) for _ in range(n)]) for n in (1, 8, 63, 64, 65, 200, 10_048)] + [([1], [1, 0]), ([], []), (None, [1])]
    a, b = F.col("a"), F.col("b")
    got = one(spark, rows, "a array<tinyint>, b array<tinyint>", V.hamming(a, b), V.hamming_words(V.pack_bits(a), V.pack_bits(b), F.size(a)))
    for (x, y), (plain, packed) in zip(rows[:7], got):
        assert plain == pytest.approx(sum(i == j for i, j in zip(x, y)) / len(x)) == pytest.approx(packed)
    assert [g[0] for g in got[7:]] == [0.0, 0.0, 0.0]


def local(a, b):
    if not len(a) or not len(b):
        return 0.0
    d = np.sqrt(((np.array(a)[:, None] - np.array(b)[None]) ** 2).sum(2))
    if len(a) < 2 or len(b) < 2:
        return float((1 / (1 + d.min(1))).mean())
    two = np.sort(d, 1)[:, :2]
    return float((two[:, 0] < 0.75 * two[:, 1]).mean() * min(1, len(a) / 10))


def test_local_similarity(spark):
    r = np.random.default_rng(2)
    rows = [(r.normal(size=(n, 3)).tolist(), r.normal(size=(m, 3)).tolist()) for n, m in ((2, 2), (1, 3), (3, 1), (12, 9), (20, 20))] + [([], [[1.0] * 3]), (None, [[1.0] * 3])]
    got = one(spark, rows, "a array<array<double>>, b array<array<double>>", V.local_similarity(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == pytest.approx([local(a or [], b) for a, b in rows])


def test_composite_scores(spark):
    rows = [(0.0, 0.0, 1.0, False), (25.0, 15.0, 0.5, False), (100.0, 90.0, 0.0, False), (1.0, 1.0, 1.0, True), (None, 0.0, 1.0, False)]
    got = one(spark, rows, "d double, p double, h double, t boolean", V.color_similarity(F.col("d"), F.col("p"), F.col("h"), F.col("t")))
    assert [g[0] for g in got] == pytest.approx([1.0, 0.5, 0.0, 0.5, 0.0])
    got = one(spark, [(0.69, None), (0.7, None), (0.55, 0.8), (0.7, -0.5), (None, 1.0)], "s double, c double", V.color_match(F.col("s"), F.col("c")))
    assert [g[0] for g in got] == [False, True, True, False, False]
    got = one(spark, [({1: 3, 2: 1}, {1: 3, 2: 1}), ({1: 1}, {2: 1}), (None, {1: 1}), ({1: 2}, {1: 5, 3: 1})], "a map<int,long>, b map<int,long>", V.histogram_correlation(F.col("a"), F.col("b"), 100))
    x, y = np.zeros(100), np.zeros(100)
    x[1], y[1], y[3] = 2, 5, 1
    assert [g[0] for g in got] == pytest.approx([1.0, 0.0, 0.5, np.corrcoef(x, y)[0, 1]])
    got = one(spark, [([[0.0, 0.0], [9.0, 9.0]], [[3.0, 4.0], [50.0, 50.0]]), (None, [[0.0, 0.0]])], "a array<array<double>>, b array<array<double>>", V.dominant_color_distance(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [5.0, 50.0]


def test_strings_and_paths(spark):
    got = one(spark, [("{'a', 'b'}",), ("a; b;;a",), ("nan",), (None,), ("set()",), ('["x, y"]',)], "x string", V.parse_set(F.col("x")))
    assert [g[0] for g in got[:5]] == [["a", "b"], ["a", "b"], [], [], []]
    cases = [("test_image_1.jpg", True), ("a/fake_2.png", True), ("Photos/dummy/x.jpg", True), ("/tmp/x.jpg", True), ("catalog/lamp.jpg", False), ("catalog/TestEquity.jpg", False), ("x/contest_1.jpg", True), (None, False)]
    assert [g[0] for g in one(spark, [(c,) for c, _ in cases], "p string", P.is_test_path(F.col("p")))] == [w for _, w in cases]
    strict = [("abc", True), ("a/b/c.jpg", True), ("testequity", False), ("testEqui1", True), ("folder/picture.jpg", False), ("folder/demo.jpg", True)]
    assert [g[0] for g in one(spark, [(c,) for c, _ in strict], "p string", P.is_test_path(F.col("p"), "strict"))] == [w for _, w in strict]
    got = one(spark, [("a/B.JPG",), ("x.txt",), ("jpg",), (None,), ("y.heic",)], "p string", P.is_image(F.col("p")))
    assert [g[0] for g in got] == [True, False, False, False, True]
    url = "https://store.example/box/dir/a.jpg?sv=1&sig=a%2Bb"
    assert one(spark, [(url,)], "u string", P.container_of(F.col("u")), P.query_items(F.col("u")), P.with_query(F.col("u"), F.lit("?z=1"))) == [("box", ["sv=1", "sig=a+b"], "https://store.example/box/dir/a.jpg?z=1")]
    got = one(spark, [("a/b",), ("a_b",)], "p string", V.path_key(F.col("p")), V.flat_name(F.col("p"), ""))
    assert got[0][0] != got[1][0] and got[0][1] == got[1][1]
    assert one(spark, [("d/e.jpg",)], "p string", P.destination(F.col("p"), "out/best/"), V.percentage(F.lit(1), F.lit(4)), V.percentage(F.lit(1), F.lit(0))) == [("out/best/e.jpg", 25.0, None)]


def test_configurations():
    assert memory_efficient() == DedupConfig() and base() == multithreaded() and base().local_cap == 50
    assert sized_for(8, 32)["spark.sql.shuffle.partitions"] == 24


def test_wavelet_lengths_and_perfect_lowpass():
    image = np.full((80, 100, 3), 77, np.uint8)
    c = I.wavelet_coefficients(image)
    assert len(c) == 10_048
    assert c[:361] == pytest.approx(77 * 16, rel=1e-6) and np.abs(c[361:]).max() < 1e-6
    noisy = np.random.default_rng(0).integers(0, 256, (70, 70, 3)).astype(np.uint8)
    assert I.wavelet_hash(noisy).mean() == pytest.approx(0.4, abs=0.01)


def test_kernels_on_known_images():
    flat = np.full((40, 50, 3), 128, np.uint8)
    halves = flat.copy()
    halves[:, 30:] = (0, 0, 255)
    assert I.sharpness(flat) == 0.0 and 0 < I.sharpness(np.indices((40, 50)).sum(0)[..., None].repeat(3, 2).astype(np.uint8) % 2 * 255) <= 100
    assert I.pixel_difference(flat, flat) == 0 and I.pixel_difference(flat, halves) > 5
    first, second = I.dominant_colors(halves)
    assert first == pytest.approx(I.lab(flat[:1, :1].astype(float))[0, 0], abs=1) and np.linalg.norm(first - second) > 50
    assert sum(I.color_bins(flat).values()) == 32 * 40 and len(I.color_bins(flat)) == 1
    white = I.lab(np.full((1, 1, 3), 255.0))[0, 0]
    assert white == pytest.approx((255, 128, 128), abs=0.5)
    assert I.resize(np.arange(16.0).reshape(4, 4), 4, 4) == pytest.approx(np.arange(16.0).reshape(4, 4))
    assert I.channel_histograms(flat).sum() == pytest.approx(3) and I.edge_histogram(flat).sum() == pytest.approx(1)
    assert I.preprocess(flat).shape == (224, 224, 3) and I.mean_hash(halves).size == 1024


def test_quality_chain(spark):
    rows = [(1.5, [3.0, 4.0], 7.0, "a/bc.jpg"), (None, [3.0, 4.0], 7.0, "a/bc.jpg"), (None, None, 7.0, "a/bc.jpg"), (None, None, None, "a/bc.jpg"), (None, None, None, None)]
    got = one(spark, rows, "s double, v array<double>, h double, p string", V.quality(F.col("s"), F.col("v"), F.col("h"), F.col("p")))
    assert [g[0] for g in got] == [1.5, 5.0, 7.0, 6.0, 0.0]
    assert math.isclose(got[1][0], 5.0)
