"""Stages, groups and reports against plain Python models, on literal and random inputs."""

import itertools
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelloom.config import DedupConfig
from pixelloom.operators import blocking, grouping, matching, statistics
from pixelloom.plans import stages


def parts(rows, key):
    out = {}
    for r in rows:
        out.setdefault(r[key], set()).add(r["ord"])
    return sorted(map(sorted, out.values()))


def union(nodes, edges):
    label = {n: n for n in nodes}
    for a, b in edges:
        x, y = sorted((label[a], label[b]))
        label = {n: x if v == y else v for n, v in label.items()}
    out = {}
    for n, v in label.items():
        out.setdefault(v, set()).add(n)
    return sorted(map(sorted, out.values()))


@pytest.fixture(scope="module")
def planted(spark):
    """26 of 40 images in groups of 8, 6, 5, 4 and 3; one without a hash, one without vectors."""
    r = np.random.default_rng(7)
    rows, at = [], 0
    for size in (8, 6, 5, 4, 3, *[1] * 14):
        bits, vec, desc = r.integers(0, 2, 64), r.normal(size=24), r.normal(size=(12, 6)) * 5
        for k in range(size):
            own = bits.copy()
            own[40 + k] ^= 1
            rows.append((f"img/{at}.jpg", at, own.tolist(), (vec + 0.01 * r.normal(size=24)).tolist(), (desc + 0.01 * r.normal(size=(12, 6))).tolist(), float(at % 5)))
            at += 1
    rows[39] = (*rows[39][:2], None, None, None, None)
    schema = "path string, ord long, wavelet array<tinyint>, `global` array<double>, descriptors array<array<double>>, quality double"
    return spark.createDataFrame(rows, schema), rows


GROUPS = [list(range(a, b)) for a, b in itertools.pairwise([0, 8, 14, 19, 23, 26])]


def test_planted_groups_survive_all_stages(planted):
    images, rows = planted
    out = stages.deduplicate(images, None, DedupConfig())
    for stage in ("wavelet", "color", "global", "local"):
        got = parts(out[stage].collect(), "gid")
        assert [g for g in got if len(g) > 1] == GROUPS
        assert sorted(itertools.chain(*got)) == list(range(40))
    report = statistics.report(grouping.number_groups(out["local"])).collect()
    assert [r["Group ID"] for r in report] == sorted(r["Group ID"] for r in report)
    for g in GROUPS:
        best = [r["Image Path"] for r in report if r["Status"] == "Best" and int(r["Image Path"][4:-4]) in g]
        assert best == [f"img/{max(g, key=lambda i: (rows[i][5], -i))}.jpg"]
    first = [r["Status"] for r in report if r["Group ID"] == 1]
    assert first[-1] == "Best" and set(first[:-1]) == {"Duplicate"}


def test_adaptive_run_and_compat_mode(planted):
    images, _ = planted
    told = []
    adaptive = stages.deduplicate(images, None, DedupConfig(), adaptive=True, progress=lambda stage, percent: told.append(stage))
    assert told == ["wavelet", "color", "global", "local"]
    assert [g for g in parts(adaptive["local"].collect(), "gid") if len(g) > 1] == GROUPS
    compat = stages.deduplicate(images, None, replace(DedupConfig(), mode="compat"))
    assert parts(compat["local"].collect(), "gid") == GROUPS + [[i] for i in range(26, 39)]
    without = stages.deduplicate(images, None, replace(DedupConfig(), mode="compat", keep_singletons=False))
    assert parts(without["local"].collect(), "gid") == GROUPS
    assert 39 not in set(itertools.chain(*parts(compat["global"].collect(), "gid")))


def test_refinement_and_caps(spark):
    r = np.random.default_rng(3)
    rows = [(f"p{i}", i, i // 40, r.normal(size=3).tolist()) for i in range(80)] + [("q", 80, 1, None)]
    df = spark.createDataFrame(rows, "path string, ord long, gid long, v array<double>")
    for mode, cap in (("preserve", 10), ("compat", 10), ("preserve", 100)):
        members, scores = stages.global_stage(df, replace(DedupConfig(), global_cap=cap, global_chunk=13, global_threshold=0.9, mode=mode), "v")
        got = parts(members.collect(), "gid")
        want = []
        for g in (0, 1):
            own = [x for x in rows if x[2] == g]
            runs = [own[i : i + 13] for i in range(0, len(own), 13)] if len(own) > cap else [own]
            for run in runs:
                if mode == "compat" and len(run) == 1 and len(own) > cap:
                    continue
                cos = lambda a, b: np.dot(a, b) / ((np.linalg.norm(a) + 1e-7) * (np.linalg.norm(b) + 1e-7))
                edges = [(a[1], b[1]) for a, b in itertools.combinations(run, 2) if a[3] and b[3] and cos(a[3], b[3]) >= 0.9]
                want += union([x[1] for x in run if x[3] or mode == "preserve"], edges)
        assert got == sorted(want)


def test_buckets_keep_band_collisions(spark):
    rows = [(0, [1, 0, 1, 0]), (1, [0, 1, 1, 0]), (2, [1, 0]), (3, None), (4, [1])]
    df = spark.createDataFrame(rows, "ord long, h array<tinyint>")
    shared = blocking.bucket_pairs(blocking.lsh_buckets(df, "h", bands=2, width=2)).collect()
    assert sorted(map(tuple, shared)) == [(0, 1), (0, 2), (1, 2)]
    own = blocking.bucket_pairs(blocking.lsh_buckets(df, "h", bands=2, width=2, band_in_key=True)).collect()
    assert sorted(map(tuple, own)) == [(0, 1), (0, 2)]


def test_pair_cap_counts_in_entry_order(spark):
    buckets = spark.createDataFrame([("b", i) for i in range(9)], "bucket string, ord long")
    want = list(itertools.combinations(range(9), 2))
    for cap in (0, 5, 17, 100):
        assert sorted(map(tuple, blocking.bucket_pairs(buckets, 1000, cap).collect())) == want[:cap]
    assert blocking.bucket_pairs(buckets, 8, 100).count() == 0


def greedy(nodes, ok):
    out, current = [], []
    for n in nodes:
        if current and all((m, n) in ok for m in current):
            current.append(n)
        else:
            current = [n]
            out.append(current)
    return out


def test_greedy_directed_and_veto(spark):
    r = random.Random(5)
    members = spark.createDataFrame([(f"p{i}", i, i // 8) for i in range(48)], "path string, ord long, gid long")
    pairs = [(i // 8, i, j) for i in range(48) for j in range(i + 1, 48) if i // 8 == j // 8 and r.random() < 0.6]
    matches = spark.createDataFrame(pairs, "gid long, src long, dst long")
    got = parts(grouping.greedy_cliques(members, matches).collect(), "clique")
    ok = {(a, b) for _, a, b in pairs}
    assert got == sorted(g for k in range(6) for g in greedy(range(8 * k, 8 * k + 8), ok))
    few = [(0, 1, 3), (0, 2, 3)]
    got = parts(grouping.directed_reach(members.where("ord between 1 and 3"), spark.createDataFrame(few, "gid long, src long, dst long"), ["gid"]).collect(), "reach")
    assert got == [[1, 3], [2]]
    members = members.withColumn("gid", 8 * F.col("gid"))  # a group's id is its first ord
    scored = spark.createDataFrame([(0, 0, 1, True), (0, 0, 2, False), (8, 8, 9, True), (16, 16, 17, None)], "gid long, src long, dst long, ok boolean")
    kept = parts(grouping.veto(members, scored, F.col("ok")).collect(), "gid")
    assert [0] in kept and list(range(8, 16)) in kept and [16] in kept


def test_merge_by_first(spark):
    def merged(*lists):
        rows = [(g, k, own) for g in (1, 2) for k, own in enumerate(lists)]
        out = {}
        for r in grouping.merge_by_first(spark.createDataFrame(rows, "gid long, k int, members array<string>").repartition(3)).orderBy("gid", "subgroup", "position").collect():
            out.setdefault(r.gid, {}).setdefault(r.subgroup, []).append(r.member)
        assert not out or out[1] == out[2]
        return list(out[1].values()) if out else []

    assert merged(["a", "b"], ["c"], ["d", "e"]) == [["a", "b"], ["c"], ["d", "e"]]
    assert merged(["a", "b"], ["b", "c"], ["x", "a"], ["a", "y"], [], None, [None, "z"]) == [["a", "b", "c"], ["x", "a", "y"], ["z"]]
    assert merged([]) == []


def test_color_methods(spark):
    members = spark.createDataFrame([(f"p{i}", i, 0) for i in range(7)], "path string, ord long, gid long")
    rows = [(i, j, 0.9 if (i, j) in {(0, 1), (0, 2), (1, 2), (5, 6)} else 0.1, 5.0, 5.0, 0.4 if (i, j) == (5, 6) else 0.9, 0.0) for i, j in itertools.combinations(range(7), 2)]
    metrics = spark.createDataFrame(rows, "src long, dst long, similarity double, distance double, difference double, histogram double, cosine double")
    run = lambda **k: parts(stages.color_stage(members, metrics, replace(DedupConfig(), **k)).collect(), "gid")
    assert run() == [[0, 1, 2], [3], [4], [5, 6]]
    assert run(color_method="batches") == [[0, 1, 2], [3], [4], [5, 6]]
    assert run(color_method="greedy") == [[0, 1, 2], [3], [4], [5], [6]]
    assert run(color_cap=6) == [list(range(7))]


def test_mutual_matches_and_geometry(spark):
    r = np.random.default_rng(6)
    points = r.uniform(0, 100, (20, 3)) + (0, 0, 200)
    x = points[:, :2] / points[:, 2:] * 500
    y = (points[:, :2] + (9, 1)) / points[:, 2:] * 500
    assert matching.epipolar_inliers(x, y) == 20
    y[:6] += r.uniform(30, 90, (6, 2)) * (0, 1)
    pairs = [[(float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(x, y)], [(0.0, 0.0, 1.0, 1.0)] * 7, None]
    df = spark.createDataFrame([(p,) for p in pairs], "m array<struct<a:double,b:double,c:double,d:double>>")
    got = [tuple(v[0]) for v in df.select(matching.geometric_verification(F.col("m"))).collect()]
    assert got[0][1] >= 14 and got[0][0] >= 0.7 and got[1:] == [(0.0, 0), (0.0, 0)]
    desc = r.normal(size=(10, 16))
    a = spark.createDataFrame([(p, i, d.tolist()) for p in (1, 2) for i, d in enumerate(desc[: 10 if p == 1 else 7])], "pair long, idx int, vec array<double>")
    b = spark.createDataFrame([(p, i, (3 * d + 0.01).tolist()) for p in (1, 2) for i, d in enumerate(desc[::-1])], "pair long, idx int, vec array<double>")
    assert sorted((m.pair, m.i, m.j) for m in matching.mutual_matches(a, b).collect()) == [(1, i, 9 - i) for i in range(10)]


def test_statistics_on_empty_input(spark):
    none = spark.createDataFrame([], "path string, ord long, gid long, quality double")
    s = statistics.group_statistics(none).first()
    assert (s.groups, s.images, s.grouping_ratio, s.mean_multi, s.max_size) == (0, 0, 0.0, 1.0, 0)
    assert statistics.report(grouping.number_groups(none)).count() == 0
    assert statistics.run_summary(none).first().images == 0


@pytest.mark.parametrize("ratio,size,want", [(0.9, 5, (0.935, 0.825)), (0.05, 5, (0.765, 0.675)), (0.5, 5, (0.85, 0.75)), (0.9, 500, (0.95, 0.86625)), (0.5, 101, (0.8925, 0.7875))])
def test_adaptive_thresholds(spark, ratio, size, want):
    df = spark.createDataFrame([(ratio, size)], "grouping_ratio double, max_size long")
    assert tuple(statistics.adaptive_thresholds(df).first()) == pytest.approx(want)
