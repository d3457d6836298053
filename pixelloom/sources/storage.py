"""Shared working storage for jobs that must outlive a lost executor.

Intermediate tables are Parquet under the folder that the session names in
``spark.checkpoint.dir``; where that setting is absent, a temporary folder of this machine is used if
the whole of Spark runs on it (tests, a laptop), and any other session is refused.  Nothing here is ever a
``localCheckpoint``: a lost executor costs a re-read, not the job.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else a temporary one of a local session; ValueError without either."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"executors of {master} share no folder of this machine: set spark.checkpoint.dir to one that they do")
    if "dir" not in _OWN:
        _OWN["dir"] = "file://" + tempfile.mkdtemp(prefix="pixelloom-")
    return _OWN["dir"]


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/pixelloom/{name}-{uuid.uuid4().hex}"

    def tidy() -> None:
        try:
            _remove(spark, path)
        except Exception:  # the session has already gone; nothing left to tidy with
            pass

    atexit.register(tidy)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _WRITERS = threading.Lock(), [0, "false"]


@contextlib.contextmanager
def _cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with their query; the first of several writers at a time sets this, and the last one sets it back."""
    with _LOCK:
        if not _WRITERS[0]:
            _WRITERS[1] = spark.conf.get(_CLEANUP)
            spark.conf.set(_CLEANUP, "true")
        _WRITERS[0] += 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITERS[0] -= 1
            if not _WRITERS[0]:
                spark.conf.set(_CLEANUP, _WRITERS[1])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and return a reader of what was written.

    Its shuffle files go when the write has ended, rather than when the driver next collects its garbage."""
    path = new_path(df.sparkSession, name)
    with _cleaned_up(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
