import numpy as np
import pytest

from pixelloom import config, runtime
from pixelloom.functions import images as I
from pixelloom.operators import blocking, numbering
from pixelloom.plans import catalogue

SF = "/root/testdata/sf0.001"


def test_retries_and_times():
    calls, waits, told = [], [], []

    def shaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return x

    assert runtime.retrying(shaky, sleep=waits.append)(5) == 5 and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        runtime.retrying(lambda: (_ for _ in ()).throw(OSError()), attempts=4, sleep=waits.append)()
    assert waits[2:] == [1.0, 2.0, 4.0]
    with pytest.raises(KeyError):
        runtime.retrying(lambda: {}[1], sleep=waits.append)()
    assert len(waits) == 5
    assert runtime.timed(shaky, lambda *x: told.append(x))(1) == 1 and told[0][0] == "shaky" and told[0][1] >= 0


def test_kept_tables_and_memory(spark):
    kept = runtime.Kept()
    rows = kept.store("a", spark.range(10))
    assert kept.get("a") is rows and rows.storageLevel.useMemory and kept.get("b") is None
    kept.store("a", spark.range(3))
    assert not rows.storageLevel.useMemory and kept.get("a").count() == 3
    kept.clear()
    assert kept.get("a") is None
    with runtime.prefetched(spark.range(7)) as df:
        assert df.storageLevel.useMemory and df.count() == 7
    assert not df.storageLevel.useMemory and runtime.memory_of(df)["total_mb"] > 0


def test_a_stream_is_drained(spark, tmp_path):
    spark.range(5).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"file://{tmp_path}/in")
    q = stream.writeStream.format("memory").queryName("drained").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    assert runtime.drain(q) and not q.isActive and spark.sql("SELECT * FROM drained").count() == 5


def test_reported_efficiency_is_its_formula():
    assert runtime.parallel_efficiency([1.0, 3.0], 8) == pytest.approx({"workers": 8, "speedup": 5.6, "utilisation": 70.0})
    assert runtime.parallel_efficiency([], 8) == {"workers": 8}


@pytest.mark.parametrize(
    "machine,want",
    [
        ((2, 64), ("low_end", 2, 3, True)),
        ((1, 64), ("low_end", 2, 3, True)),
        ((4, 64), ("entry_level", 4, 5, True)),
        ((8, 12), ("mid_range", 8, 8, False)),
        ((8, 6), ("mid_range", 4, 5, True)),
        ((16, 64), ("high_end", 12, 12, False)),
        ((10, 64), ("high_end", 10, 12, False)),
        ((64, 12), ("server_class", 8, 10, False)),
        ((64, 64), ("server_class", 16, 15, False)),
        ((64, 64, "Darwin"), ("server_class", 8, 15, False)),
        ((4, 64, "Windows"), ("entry_level", 3, 5, True)),
    ],
)
def test_machine_lookup(machine, want):
    assert tuple(config.machine_settings(*machine).values()) == want


def test_numbers_and_samples(spark):
    rows = [(i % 3 if i % 7 else None, (i * 37) % 101, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, o int, id int").repartition(5)
    got = {r.id: r.n for r in numbering.numbered(df, ["o", "id"], ["k"]).collect()}
    for k in (0, 1, 2, None):
        own = sorted((o, i) for x, o, i in rows if x == k)
        assert [got[i] for _, i in own] == list(range(len(own)))
    assert sorted(r.n for r in numbering.numbered(df, ["o", "id"]).collect()) == list(range(500))
    assert numbering.numbered(df.limit(0), ["o"]).count() == 0
    one = numbering.sample(df, "id", 20, seed=3).collect()
    assert one == numbering.sample(df.repartition(2), "id", 20, seed=3).collect() and len({r.id for r in one}) == 20
    assert {r.id for r in one} != {r.id for r in numbering.sample(df, "id", 20, seed=4).collect()}


@pytest.mark.parametrize("run", [3, 10, 1000])
def test_moving_average_across_runs(spark, run):
    rows = [(i % 2, i, float((i * 31) % 17) if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, o int, v double").repartition(4)
    got = {r.o: r.moving_average for r in numbering.moving_average(df, "k", ["o"], "v", 7, run).collect()}
    assert len(got) == 300
    for k in (0, 1):
        own = [(o, v) for x, o, v in rows if x == k]
        for i, (o, _) in enumerate(own):
            last = [v for _, v in own[max(0, i - 6) : i + 1] if v is not None]
            assert got[o] == (pytest.approx(sum(last) / len(last)) if last else None)


def test_networks_around_kernels():
    r = np.random.default_rng(2)
    image = r.integers(0, 256, (30, 20, 3)).astype(np.uint8)
    seen = []
    v = I.global_vector(image, lambda x: seen.append(x) or np.stack([x.mean(0)] * 2 + [np.ones(x.shape[1:])]))
    assert seen[0].shape == (3, 600, 600) and np.linalg.norm(v) == pytest.approx(1, abs=1e-6) and v[0] == v[1]
    flat = np.full((10, 10, 3), 255, np.uint8)
    I.global_vector(flat, lambda x: seen.append(x) or x)
    assert seen[1][:, 0, 0] == pytest.approx((1 - np.array(I.CHANNEL_MEAN)) / I.CHANNEL_STD, abs=1e-5)
    out = I.local_features(image, lambda g: seen.append(g) or (np.zeros((1, 2)), np.arange(4.0)))
    assert seen[2].shape == (800, 800) and 0 <= seen[2].min() and seen[2].max() <= 1 and out["descriptors"].shape == (1, 4) and out["keypoints"].shape == (1, 2)


def test_exact_edges_link_what_all_pairs_do(spark):
    """Copies beyond any cap: the classes' edges and their copies have the components of all pairs in shared buckets."""
    r = np.random.default_rng(8)
    base = r.integers(0, 2, (12, 16))
    rows = [(i, (base[i % 12] ^ (r.random(16) < 0.06)).astype(int).tolist()) for i in range(150)] + [(200 + i, base[0].tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "ord long, h array<tinyint>")
    label = {i: i for i, _ in rows}

    def join(a, b):
        x, y = sorted((label[a], label[b]))
        label.update({n: x for n, v in label.items() if v == y})

    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1 :]:
            keys = lambda h: {tuple(h[:8]), tuple(h[8:])}
            if keys(x) & keys(y) and sum(p == q for p, q in zip(x, y)) >= 0.8 * 16:
                join(a, b)
    from pixelloom.operators.components import connected_components

    found = {c.node: c.component for c in connected_components(blocking.exact_edges(df, "h", 0.8, bands=2, width=8)).collect()}
    assert {i: found.get(i, i) for i, _ in rows} == label


def test_approximate_pairs_recall(spark):
    """J7 on whole tables: the random projections find nine tenths of the pairs over the threshold."""
    import itertools

    rows = catalogue.images(spark, SF).select("ord", "v").collect()
    x = np.array([r.v for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = {(min(rows[i].ord, rows[j].ord), max(rows[i].ord, rows[j].ord)) for i, j in itertools.combinations(range(len(rows)), 2) if x[i] @ x[j] >= 0.42}
    got = {(r.src, r.dst) for r in catalogue.QUERIES["ann_cosine_pairs"](spark, SF).collect()}
    assert near and got <= near and len(got & near) >= 0.9 * len(near)
