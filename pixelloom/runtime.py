"""What surrounds a run: retries and timing of driver-side calls, kept tables, measured stages, an orderly end.

Inside a query, retries are Spark's (``spark.task.maxFailures``) and metrics those of its listeners; these are for the calls around it."""

from __future__ import annotations

import contextlib
import functools
import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


def retrying(call: Callable, errors: tuple[type[Exception], ...] = (OSError,), attempts: int = 3, first: float = 1.0, most: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``call`` with up to ``attempts`` tries on ``errors``; waits double from ``first`` to ``most`` seconds, the last error is raised."""

    @functools.wraps(call)
    def run(*args: object, **more: object) -> object:
        for k in range(attempts):
            try:
                return call(*args, **more)
            except errors:
                if k == attempts - 1:
                    raise
                sleep(min(most, first * 2**k))

    return run


def timed(call: Callable, told: Callable[[str, float], None] | None = None) -> Callable:
    """``call``, with its name and seconds told (or logged) whether it returns or fails."""

    @functools.wraps(call)
    def run(*args: object, **more: object) -> object:
        began = time.monotonic()
        try:
            return call(*args, **more)
        finally:
            took = time.monotonic() - began
            told(call.__name__, took) if told else log.info("%s: %.2f s", call.__name__, took)

    return run


@dataclass
class Kept:
    """Tables kept by name across the executors' memory and disks; a lost executor's share is worked out again."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        """Keep ``rows``, in place of what had the name; they are read when first used."""
        self.drop(name)
        self.tables[name] = rows.persist(StorageLevel.MEMORY_AND_DISK)
        return self.tables[name]

    def get(self, name: str) -> DataFrame | None:
        return self.tables.get(name)

    def drop(self, name: str) -> None:
        if name in self.tables:
            self.tables.pop(name).unpersist()

    def clear(self) -> None:
        for name in list(self.tables):
            self.drop(name)


@contextlib.contextmanager
def prefetched(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows`` read once before they are used several times, and let go at the end."""
    kept = Kept()
    try:
        out = kept.store("rows", rows)
        out.count()
        yield out
    finally:
        kept.clear()


def memory_of(rows: DataFrame) -> dict[str, float]:
    """Megabytes in use and available for storage, over all executors of the session."""
    status = rows.sparkSession.sparkContext._jsc.sc().getExecutorMemoryStatus()
    total = free = 0
    found = status.iterator()
    while found.hasNext():
        pair = found.next()._2()
        total, free = total + pair._1(), free + pair._2()
    return {"used_mb": (total - free) / 1e6, "total_mb": total / 1e6}


def drain(query: StreamingQuery, seconds: int = 60) -> bool:
    """Let a stream finish what has arrived, then stop it; true if it had ended within ``seconds`` more."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    return bool(query.awaitTermination(seconds))


def parallel_efficiency(stage_seconds: list[float], workers: int, share: float = 0.7) -> dict[str, float]:
    """The reported speed-up and utilisation.  By their formula they are ``share * workers`` and ``100 * share`` (at most 100) for any
    run that took time, and are kept only so that reports have them; nothing for a run that took none."""
    took = sum(stage_seconds)
    if took <= 0:
        return {"workers": workers}
    speedup = took * workers * share / took
    return {"workers": workers, "speedup": speedup, "utilisation": min(100.0, 100 * speedup / workers)}
