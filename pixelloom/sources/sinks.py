"""Sinks: feature store, reports, copy plans and copies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.functions.paths import destination
from pixelloom.functions.vectors import path_key
from pixelloom.operators.numbering import numbered
from pixelloom.runtime import retrying
from pixelloom.sources.storage import materialise


def put_features(features: DataFrame, path: str, buckets: int = 256) -> None:
    """K1: append to the store, partitioned by a hash prefix of the path; readers take the newest row of a path."""
    prefix = F.conv(F.substring(path_key(F.col("path")), 1, 8), 16, 10).cast("long") % buckets
    rows = features.withColumn("bucket", prefix.cast("int")).withColumn("written", F.current_timestamp())
    rows.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def newest_features(store: DataFrame) -> DataFrame:
    """The newest row of each path, by one combinable aggregate."""
    rest = [c for c in store.columns if c not in ("path", "written", "bucket")]
    return store.groupBy("path").agg(F.max_by(F.struct(*rest), "written").alias("r")).select("path", "r.*")


def append_image_info(rows: DataFrame, path: str) -> None:
    """K2: append to a CSV; arrays, maps and structs become JSON cells."""
    cells = [F.to_json(c).alias(c) if k.startswith(("array", "map", "struct")) else F.col(c) for c, k in rows.dtypes]
    rows.select(*cells).write.mode("append").csv(path, header=True, escape='"')


def write_report(report: DataFrame, path: str) -> str | None:
    """Write the report as CSV in its order; null for an empty report, of which nothing is written."""
    if report.isEmpty():
        return None
    report.write.mode("overwrite").csv(path, header=True, escape='"')
    return path


def nested_report(members: DataFrame, most: int = 1_000) -> DataFrame:
    """JSON documents of a group's members, best first, of at most ``most`` members each; ``part`` counts a group's documents from 0."""
    placed = numbered(members, ["status", "path"], ["group_id"], "_at").withColumn("part", F.floor(F.col("_at") / most))
    member = F.struct("_at", F.struct(F.col("status"), F.col("path"), F.round("quality", 2).alias("quality")).alias("m"))
    found = placed.groupBy("group_id", "part").agg(F.array_sort(F.collect_list(member)).alias("m"))
    return found.select("group_id", "part", F.to_json(F.transform("m", lambda x: x["m"])).alias("members"), F.size("m").cast("long").alias("size"))


def write_listing(paths: DataFrame, path: str, timestamp: str, most: int = 10_000) -> None:
    """C4: a listing cache of JSON documents {timestamp, blobs}, a line each, of at most ``most`` paths, so that no document holds a whole store."""
    dealt = paths.select("path").withColumn("_doc", F.concat(F.spark_partition_id(), F.lit("-"), F.floor(F.monotonically_increasing_id() % F.lit(1 << 33) / most)))
    dealt.groupBy("_doc").agg(F.collect_list("path").alias("blobs")).select(F.lit(timestamp).alias("timestamp"), "blobs").write.mode("overwrite").json(path)


def copy_plan(report: DataFrame, best_dir: str, duplicate_dir: str) -> DataFrame:
    """K6, K7: (src, dest, kind) for each reported image."""
    path, best = F.col("`Image Path`"), F.col("Status") == "Best"
    dest = F.when(best, destination(path, best_dir)).otherwise(destination(path, duplicate_dir))
    return report.select(path.alias("src"), dest.alias("dest"), F.when(best, "best").otherwise("duplicate").alias("kind"))


def name_collisions(plan: DataFrame) -> DataFrame:
    """Destinations that more than one source would overwrite, which a copy by file name alone hides."""
    return plan.groupBy("dest").agg(F.countDistinct("src").alias("sources")).where("sources > 1")


def organise_plan(catalog: DataFrame, members: DataFrame, best_dir: str, duplicate_dir: str) -> DataFrame:
    """K9: like the copy plan over a whole catalog; images in no group go to the best."""
    status = members.select(F.col("path").alias("_p"), "status")
    joined = catalog.join(status, F.col("path") == F.col("_p"), "left")
    return copy_plan(joined.select(F.col("path").alias("Image Path"), F.coalesce("status", F.lit("Best")).alias("Status")), best_dir, duplicate_dir)


def _copied(src: str | None, dest: str | None, attempts: int) -> bool:
    """Whether the bytes of one address now lie at the other; a missing source or a refused target is no error."""
    from pyarrow import fs

    def copy() -> None:
        (a, from_path), (b, to_path) = fs.FileSystem.from_uri(src), fs.FileSystem.from_uri(dest)
        b.create_dir(to_path.rpartition("/")[0], recursive=True)
        with a.open_input_stream(from_path) as own, b.open_output_stream(to_path) as out:
            while block := own.read(1 << 20):
                out.write(block)

    try:
        if src is None or dest is None:
            return False
        retrying(copy, (OSError,), attempts)()
    except (OSError, ValueError):  # pyarrow's errors of stores and addresses are among these
        return False
    return True


def run_copies(plan: DataFrame, attempts: int = 3) -> DataFrame:
    """K5: (src, dest, kind, ok) after copying each source to its destination, in the executors, as bytes streamed from store to store.

    Addresses are URIs of stores that pyarrow opens, with the executors' own credentials.  A copy is tried ``attempts`` times, a file that isn't there
    once more costs only its waits.  Copying again gives the same files, so a lost task is simply run again; results are written once and not copied twice
    when they are read twice."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(ok=[_copied(s, d, attempts) for s, d in zip(b["src"], b["dest"], strict=True)])

    dealt = plan.select("src", "dest", "kind").repartition("src")
    return materialise(dealt.mapInPandas(run, "src string, dest string, kind string, ok boolean"), "copies")


def download_all(files: DataFrame, folder: str) -> DataFrame:
    """Copy the files of a listing (path) into one folder under their names; (src, dest, kind, ok)."""
    return run_copies(files.select(F.col("path").alias("src"), destination(F.col("path"), folder).alias("dest"), F.lit("file").alias("kind")))


def publish_report(path: str, target: str, spark: SparkSession) -> int:
    """A report's part files joined, in order and under one header, in the single file ``target``; the number of parts.  Bytes stream through the store's own client."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, out = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(target)
    store = folder.getFileSystem(conf)
    parts = sorted(str(f.getPath()) for f in store.listStatus(folder) if f.getPath().getName().startswith("part-"))
    stream = out.getFileSystem(conf).create(out, True)
    try:
        for k, part in enumerate(parts):
            own = store.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                while k and own.read() not in (-1, 10):  # the header of all parts but the first; names of columns hold no line break
                    pass
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(own, stream, conf, False)
            finally:
                own.close()
    finally:
        stream.close()
    return len(parts)


def write_progress(counts: DataFrame, path: str) -> None:
    """K8: one JSON document."""
    counts.coalesce(1).write.mode("overwrite").json(path)
