"""Catalogs, image scans, feature stores, reports and progress as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelloom.functions.paths import is_image
from pixelloom.functions.vectors import path_key
from pixelloom.operators.numbering import numbered

FEATURES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("wavelet", T.ArrayType(T.ByteType())),
        T.StructField("quality", T.DoubleType()),
        T.StructField("global", T.ArrayType(T.FloatType())),
        T.StructField("local", T.StructType([T.StructField("keypoints", T.ArrayType(T.ArrayType(T.FloatType()))), T.StructField("descriptors", T.ArrayType(T.ArrayType(T.FloatType())))])),
        T.StructField("color", T.ArrayType(T.FloatType())),
    ]
)
REPORT = "`Image Path` string, `Quality Score` double, `Group ID` long, `Group Size` long, `Status` string"
PROGRESS = "total_images long, downloaded long, processed long, saved long, processed_files array<string>, timestamp timestamp"


def list_images(spark: SparkSession, root: str, prefix: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of the images below ``root``; contents are not read.

    A prefix is part of the path that is listed, so the store does the filtering."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root if prefix is None else f"{root.rstrip('/')}/{prefix}")
    return files.select("path", "length", "modificationTime").where(is_image(F.col("path")))


def with_ord(catalog: DataFrame, order: str = "path") -> DataFrame:
    """(.., ord): an explicit order, numbered range by range so that no task sorts the whole catalog."""
    return numbered(catalog, [order], name="ord")


def read_images(spark: SparkSession, root: str, drop_invalid: bool = False) -> DataFrame:
    """(path, image); an undecodable file has height -1 unless dropped."""
    files = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("image.origin").alias("path"), "image")


def read_bytes(spark: SparkSession, root: str) -> DataFrame:
    """(path, content); failed reads are retried as tasks."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")


def valid_images(images: DataFrame, least: int = 32) -> DataFrame:
    """decoded, three channels, at least ``least`` pixels on a side."""
    return images.where((F.col("image.nChannels") == 3) & (F.col("image.height") >= least) & (F.col("image.width") >= least))


def image_pairs(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """(src, dst, a, b): both images of a pair of paths, or null for both."""
    a = images.select(F.col("path").alias("_a"), F.col("image").alias("a"))
    b = images.select(F.col("path").alias("_b"), F.col("image").alias("b"))
    both = pairs.join(a, F.col("src") == F.col("_a"), "left").join(b, F.col("dst") == F.col("_b"), "left").drop("_a", "_b")
    fine = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.withColumn("a", F.when(fine, F.col("a"))).withColumn("b", F.when(fine, F.col("b")))


def read_listing(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """C4: (path, timestamp) of a JSON listing cache: one document, or one in each line."""
    found = spark.read.schema("timestamp string, blobs array<string>").json(path, multiLine=not lines)
    return found.select(F.explode("blobs").alias("path"), F.to_timestamp("timestamp").alias("timestamp"))


def read_store(spark: SparkSession, path: str, skip_corrupt: bool = True) -> DataFrame:
    """The feature table; columns that a stage doesn't select are not read, corrupt files are skipped."""
    return spark.read.schema(FEATURES).option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(path).select(*[f"`{c}`" for c in FEATURES.names])


def read_image_info(spark: SparkSession, path: str, arrays: dict[str, str]) -> DataFrame:
    """A CSV whose cells of ``arrays`` (column -> type) are JSON."""
    rows = spark.read.csv(path, header=True, quote='"', escape='"')
    for name, kind in arrays.items():
        rows = rows.withColumn(name, F.from_json(name, kind))
    return rows


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report; ValueError if a required column is missing."""
    rows = spark.read.csv(path, header=True, escape='"')
    if missing := {"Image Path", "Status"} - set(rows.columns):
        raise ValueError(f"the report lacks {sorted(missing)}")
    kinds = {"Quality Score": "double", "Group ID": "long", "Group Size": "long"}
    return rows.select(*[F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in rows.columns])


def report_lists(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct best and duplicate paths."""
    of = lambda s: report.where(F.col("Status") == s).select(F.col("`Image Path`").alias("path")).distinct()
    return of("Best"), of("Duplicate")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """C21."""
    return spark.read.schema(PROGRESS).json(path, multiLine=True)


def remaining(catalog: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """What has not been processed."""
    return catalog.join(done.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")


def having_features(catalog: DataFrame, store: DataFrame, feature: str | None = None) -> DataFrame:
    """Catalog rows that have the feature."""
    own = store if feature is None else store.where(F.col(feature).isNotNull())
    return catalog.join(own.select(F.col("path").alias("_k")).distinct(), F.col("path") == F.col("_k"), "left_semi")


def with_feature(images: DataFrame, *columns: str) -> DataFrame:
    """rows that have every one of the features."""
    for c in columns:
        images = images.where(F.col(c).isNotNull())
    return images


def missing_from(report: DataFrame, catalog: DataFrame, shown: int | None = None) -> DataFrame:
    """Catalog paths that a report lacks."""
    out = remaining(catalog.select("path"), report.select(F.col("`Image Path`").alias("path")))
    return out if shown is None else out.orderBy("path").limit(shown)


def merge_features(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row a path; a feature of ``new`` wins where it is present."""
    columns = [c for c in old.columns if c != "path"]
    renamed = new.select(F.col("path").alias("_p"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = old.join(renamed, F.col("path") == F.col("_p"), "full")
    return joined.select(F.coalesce("path", "_p").alias("path"), *[F.coalesce(f"_new_{c}", c).alias(c) for c in columns])


def keyed(store: DataFrame) -> DataFrame:
    """The store with a key of its path that can't collide, to partition by."""
    return store.withColumn("key", path_key(F.col("path")))
