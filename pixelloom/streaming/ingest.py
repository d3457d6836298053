"""Incremental ingest and rate control on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pixelloom.functions.images import extract
from pixelloom.functions.paths import is_image


def stream_catalog(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """New image files as they appear; the checkpoint remembers which were seen, and the rate is the source's option."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).load(root)
    return files.where(is_image(F.col("path")))


def stream_features(images: DataFrame, store: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Scan, extract and save as one narrow stream into a Parquet store; ``images`` is (path, image)."""
    writer = extract(images).writeStream.format("parquet").option("path", store).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def token_bucket(rate: float, elapsed: float, tokens: float, capacity: float) -> float:
    """Tokens after a refill."""
    return min(capacity, tokens + max(0.0, elapsed) * rate)


def adjust_rate(rate: float, mean_seconds: float, queued: int, target: float, least: float, most: float) -> float:
    """R2: a tenth less when responses take over 1.5 of the target, a tenth more when under half of it and the queue is short."""
    if mean_seconds > 1.5 * target:
        return max(least, rate * 0.9)
    if mean_seconds < 0.5 * target and queued < 10:
        return min(most, rate * 1.1)
    return rate


def adaptive_rate(events: DataFrame, key: str, start: float = 100.0, target: float = 1.0, least: float = 1.0, most: float = 1000.0, window: int = 100) -> DataFrame:
    """R2 as a stateful operator over (key, seq, seconds, queued), streaming or batch-fed: (key, seq, rate, mean_seconds).

    The state of a key is its rate and its last ``window`` durations."""

    def fold(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rate, last = state.get if state.exists else (start, [])
        last, out = list(last), []
        rows = pd.concat(list(batches)).sort_values("seq")
        for seq, seconds, queued in zip(rows["seq"], rows["seconds"], rows["queued"], strict=True):
            last = [*last, float(seconds)][-window:]
            mean = sum(last) / len(last)
            rate = adjust_rate(rate, mean, int(queued), target, least, most)
            out.append((name[0], int(seq), rate, mean))
        state.update((rate, last))
        yield pd.DataFrame(out, columns=["key", "seq", "rate", "mean_seconds"])

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(fold, f"key {kind}, seq long, rate double, mean_seconds double", "rate double, last array<double>", "append", GroupStateTimeout.NoTimeout)
