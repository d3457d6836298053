import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelloom.functions import images as I
from pixelloom.sources import catalog, sinks
from pixelloom.streaming import ingest


def png(pixels):
    """A PNG file of an RGB array."""
    h, w, _ = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    (root / "a").mkdir()
    r = np.random.default_rng(0)
    for i in range(4):
        (root / "a" / f"{i}.png").write_bytes(png(r.integers(0, 256, (40, 50, 3), dtype=np.uint8)))
    (root / "flat.PNG").write_bytes(png(np.full((40, 40, 3), (10, 20, 30), np.uint8)))
    (root / "bad.jpg").write_bytes(b"no image")
    (root / "notes.txt").write_text("x")
    return f"file://{root}"


def test_catalog_and_images(spark, folder):
    found = catalog.with_ord(catalog.list_images(spark, folder).select("path")).orderBy("ord").collect()
    names = [r.path.rsplit("/", 1)[1] for r in found]
    assert [r.ord for r in found] == list(range(6)) and names == ["0.png", "1.png", "2.png", "3.png", "bad.jpg", "flat.PNG"]
    assert catalog.list_images(spark, folder, "a").count() == 4
    images = catalog.read_images(spark, folder)
    assert images.where("image.height = -1").count() >= 1 and catalog.valid_images(images).count() == 5
    flat = images.where(F.col("path").endswith("flat.PNG")).first().image.asDict()
    assert I.pixels(flat)[0, 0].tolist() == [30, 20, 10]
    assert catalog.read_bytes(spark, folder).where(F.col("path").endswith("notes.txt")).first().content == b"x"


def test_extract_store_and_stream(spark, folder, tmp_path):
    images = catalog.read_images(spark, folder)
    model = lambda: lambda p: p.mean((0, 1))  # noqa: E731  stands for a network
    rows = {r.path.rsplit("/", 1)[1]: r for r in I.extract(images, {"global": model}).collect()}
    assert rows["bad.jpg"].wavelet is None and len(rows["0.png"].wavelet) == 10_048 and rows["flat.PNG"].quality == 0.0
    assert rows["flat.PNG"]["global"] == pytest.approx([30, 20, 10])
    plain = images.select("path", I.sharpness_of(F.col("image")).alias("q"), I.wavelet_hash_of(F.col("image")).alias("w"))
    for r in plain.collect():
        own = rows[r.path.rsplit("/", 1)[1]]
        assert r.w == own.wavelet and (r.q == own.quality or r.q == pytest.approx(own.quality))
    a = images.where(F.col("path").endswith("0.png")).select(F.col("image").alias("a"))
    b = images.where(F.col("path").endswith("flat.PNG")).select(F.col("image").alias("b"))
    assert a.join(b).select(I.pixel_difference_of(F.col("a"), F.col("b"))).first()[0] > 5
    pairs = spark.createDataFrame([(f"{folder}/a/0.png", f"{folder}/flat.PNG"), (f"{folder}/a/0.png", "none")], "src string, dst string")
    fixed = images.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///"))
    both = {r.dst: (r.a is None, r.b is None) for r in catalog.image_pairs(pairs, fixed).collect()}
    assert both == {f"{folder}/flat.PNG": (False, False), "none": (True, True)}
    store = f"file://{tmp_path}/store"
    features = spark.createDataFrame([("p", 1.0), ("q", 2.0)], "path string, quality double")
    sinks.put_features(features, store)
    sinks.put_features(spark.createDataFrame([("p", 9.0)], "path string, quality double"), store)
    assert sorted(tuple(r) for r in sinks.newest_features(spark.read.parquet(store)).collect()) == [("p", 9.0), ("q", 2.0)]
    assert catalog.read_store(spark, store).columns == ["path", "wavelet", "quality", "global", "local", "color"]
    schema = images.schema
    images.where(F.col("image.height") > 0).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        q = ingest.stream_features(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
        q.awaitTermination(120)
        assert spark.read.parquet(f"file://{tmp_path}/out").count() == 5
    assert ingest.stream_catalog(spark, folder).isStreaming


def test_reports_progress_and_copies(spark, tmp_path):
    base = f"file://{tmp_path}"
    rows = [("a/x.jpg", 1.25, 1, 2, "Best"), ('b/"x".jpg', 0.5, 1, 2, "Duplicate"), ("c/x.jpg", 3.0, 2, 1, "Best")]
    report = spark.createDataFrame(rows, catalog.REPORT)
    assert sinks.write_report(report.limit(0), f"{base}/none") is None
    sinks.write_report(report, f"{base}/report")
    back = catalog.read_report(spark, f"{base}/report")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    best, duplicate = catalog.report_lists(back)
    assert (best.count(), duplicate.count()) == (2, 1)
    report.drop("Status").write.csv(f"{base}/lacking", header=True)
    with pytest.raises(ValueError, match="Status"):
        catalog.read_report(spark, f"{base}/lacking")
    plan = sinks.copy_plan(report, "out/best/", "out/duplicates")
    assert sorted(map(tuple, plan.collect())) == [("a/x.jpg", "out/best/x.jpg", "best"), ('b/"x".jpg', 'out/duplicates/"x".jpg', "duplicate"), ("c/x.jpg", "out/best/x.jpg", "best")]
    assert [tuple(r) for r in sinks.name_collisions(plan).collect()] == [("out/best/x.jpg", 2)]
    (tmp_path / "one.jpg").write_bytes(b"1")
    copies = spark.createDataFrame([(f"{base}/one.jpg", f"{base}/to/best/one.jpg", "best"), (f"{base}/gone.jpg", f"{base}/to/best/gone.jpg", "best")], "src string, dest string, kind string")
    assert sorted((r.src.rsplit("/", 1)[1], r.ok) for r in sinks.run_copies(copies).collect()) == [("gone.jpg", False), ("one.jpg", True)]
    assert (tmp_path / "to/best/one.jpg").read_bytes() == b"1"
    whole = spark.createDataFrame([("a/x.jpg",), ("z.jpg",)], "path string")
    members = spark.createDataFrame([("a/x.jpg", "Duplicate")], "path string, status string")
    assert sorted(r.dest for r in sinks.organise_plan(whole, members, "b", "d").collect()) == ["b/z.jpg", "d/x.jpg"]
    nested = sinks.nested_report(spark.createDataFrame([("p", 1, "Best", 2.0), ("q", 1, "Duplicate", 1.0)], "path string, group_id long, status string, quality double")).first()
    assert [m["path"] for m in json.loads(nested.members)] == ["p", "q"] and (nested.size, nested.part) == (2, 0)
    (tmp_path / "list.json").write_text(json.dumps({"timestamp": "2024-01-02T03:04:05", "blobs": ["a", "b"]}, indent=1))
    assert sorted(r.path for r in catalog.read_listing(spark, f"{base}/list.json").collect()) == ["a", "b"]
    (tmp_path / "progress.json").write_text(json.dumps({"total_images": 5, "downloaded": 3, "processed": 2, "saved": 2, "processed_files": ["a", "b"], "timestamp": "2024-01-02T03:04:05"}))
    progress = catalog.read_progress(spark, f"{base}/progress.json")
    done = progress.select(F.explode("processed_files").alias("path"))
    assert [r.path for r in catalog.remaining(spark.createDataFrame([("a",), ("c",)], "path string"), done).collect()] == ["c"]
    sinks.write_progress(progress, f"{base}/progress")
    assert spark.read.schema(catalog.PROGRESS).json(f"{base}/progress").first().saved == 2
    sinks.append_image_info(spark.createDataFrame([("p", [1.5, 2.0])], "path string, v array<double>"), f"{base}/info")
    sinks.append_image_info(spark.createDataFrame([("q", [])], "path string, v array<double>"), f"{base}/info")
    assert sorted(map(tuple, catalog.read_image_info(spark, f"{base}/info", {"v": "array<double>"}).collect())) == [("p", [1.5, 2.0]), ("q", [])]


def test_rates(spark, tmp_path):
    assert ingest.token_bucket(10, 0.5, 2, 6) == 6 and ingest.token_bucket(10, 0.1, 2, 6) == 3 and ingest.token_bucket(1, -5, 2, 6) == 2
    rows = [(k, i, 2.0 if i < 20 else 0.1, 0 if k == "a" else 50) for k in "ab" for i in range(150)]
    spark.createDataFrame(rows, "key string, seq long, seconds double, queued int").repartition(1).write.parquet(f"file://{tmp_path}/ev")
    stream = spark.readStream.schema("key string, seq long, seconds double, queued int").parquet(f"file://{tmp_path}/ev")
    q = ingest.adaptive_rate(stream, "key").writeStream.format("memory").queryName("rates").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.key, r.seq): (r.rate, r.mean_seconds) for r in spark.sql("SELECT * FROM rates").collect()}
    for k in "ab":
        rate, last = 100.0, []
        for i in range(150):
            last = [*last, rows[i][2]][-100:]
            mean = sum(last) / len(last)
            rate = ingest.adjust_rate(rate, mean, 0 if k == "a" else 50, 1.0, 1.0, 1000.0)
            assert got[k, i] == pytest.approx((rate, mean))
