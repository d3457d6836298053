"""Joins of rows with a table of one row a key (G1, F6, W1, A4), where one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys whose rows are completed by a broadcast: those of most rows, so any other holds at most a thousandth of all rows.
HOT = 1_000


def attach(rows: DataFrame, found: DataFrame, on: str, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``found`` (but ``key``) whose ``key`` equals their ``on``; rows without one are left out.

    ``found`` has one row a key, a null key too, and in ``size`` how many rows have it.  It is mostly an aggregate by that
    key, and then adaptive execution can't split the join: a key's rows would meet in one task.  So the rows of the ``HOT`` largest keys,
    a table of bounded size, take their values from a broadcast and aren't shuffled; the others are joined by key."""
    own = [c for c in found.columns if c != key]
    values = found.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_own_{c}") for c in own])
    hot = values.orderBy(F.desc(f"_own_{size}"), "_key").limit(HOT).withColumn("_hot", F.lit(True))  # a whole order, so the same keys however often it is read
    same = F.col(on).eqNullSafe(F.col("_key"))
    marked = rows.join(F.broadcast(hot), same, "left")
    many = marked.where("_hot").drop("_key", "_hot")
    few = marked.where("_hot is null").drop("_hot", *values.columns).join(values, same).drop("_key")
    return many.unionAll(few).toDF(*rows.columns, *own)
