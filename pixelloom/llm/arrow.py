"""Small helpers for narrow maps over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Most bytes that Spark hands a Python worker at once, where the session doesn't say: it bounds a worker's memory whatever the texts' lengths.
BATCH_BYTES = 8 << 20
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(df: DataFrame) -> None:
    """Set the session's limit of bytes a batch to BATCH_BYTES unless a smaller one holds."""
    conf = df.sparkSession.conf
    held = conf.get(_SETTING).rstrip("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        conf.set(_SETTING, str(BATCH_BYTES))


def utf8(column: pa.Array) -> list[bytes]:
    """A string column's values as UTF-8 bytes; null becomes the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


#: Bytes that ``map_batches`` works on at once: what a worker holds beside a batch is in proportion to these.
SLICE_BYTES = 1 << 20


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All batches, slice by slice; afterwards the worker, which lives on, gives back what Arrow keeps for later."""
    for b in batches:
        yield from slices(b)
    pa.default_memory_pool().release_unused()


def slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES, of a row at least."""
    step = max(1, b.num_rows * SLICE_BYTES // max(1, b.nbytes))
    for lo in range(0, b.num_rows, step):
        yield b.slice(lo, step)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every batch of ``df``, slice by slice; ``fn`` returns a batch in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(fn, sliced(batches))

    bound_batches(df)
    return df.mapInArrow(run, schema)


def kind_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
