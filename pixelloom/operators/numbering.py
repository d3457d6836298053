"""Consecutive numbers in a stated order, range by range: no task holds a key's rows, or all rows, at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelloom.sources.storage import materialise


def _columns(order: list[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def numbered(rows: DataFrame, order: list[str | Column], by: list[str] | None = None, name: str = "n") -> DataFrame:
    """``rows`` with ``name``, counted from 0 in ``order`` within each value of ``by``.

    Rows are dealt into ranges of (by, order) and written once, so that ranges can't change between counting and numbering;
    each range is numbered on its own and moved by the sizes of those before it, a row a range and key."""
    by = by or []
    keys = [F.col(k) for k in by]
    ranged = rows.repartitionByRange(*keys, *_columns(order)).withColumn("_part", F.spark_partition_id())
    dealt = materialise(ranged, "ranges")
    local = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_part", *by).orderBy(*_columns(order))) - 1)
    sizes = dealt.groupBy("_part", *by).agg(F.count("*").alias("_m"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_by_{k}") for k in by], F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_before"))
    on = F.col("_part") == F.col("_p")
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_by_{k}"))
    out = local.join(before, on).withColumn(name, (F.col("_n") + F.col("_before")).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], name)


def moving_average(rows: DataFrame, partition: str, order: list[str], value: str, n: int = 100, run: int = 10_000) -> DataFrame:
    """``moving_average`` of the last ``n`` values, the row's own with those before it.

    A key's rows are cut into runs, each with a copy of the ``n`` - 1 rows before it, so that a key of any size is many small windows."""
    run = max(run, n)
    placed = numbered(rows, order, [partition], "_at")
    home = F.floor(F.col("_at") / run)
    last = (F.col("_at") % run) > run - n  # also seen by the next run
    copies = placed.withColumn("_run", F.explode(F.when(last, F.array(home, home + 1)).otherwise(F.array(home))))
    w = Window.partitionBy(partition, "_run").orderBy("_at").rowsBetween(-(n - 1), 0)
    mean = copies.withColumn("moving_average", F.avg(value).over(w))
    return mean.where(F.col("_run") == home).drop("_at", "_run")


def round_robin(rows: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """``worker`` 0 .. n - 1 in turn, in ``order``."""
    placed = numbered(rows, order, name="_at")
    return placed.withColumn("worker", F.pmod("_at", F.lit(n))).drop("_at")


def head(rows: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``; each task keeps ``n`` rows at most."""
    return rows.orderBy(*_columns(order)).limit(n)


def sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows at random, those of smallest seeded hash of their key: the same on every run and partitioning."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)
