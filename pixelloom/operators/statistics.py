"""Group statistics, thresholds, best members and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelloom.operators.keyed import attach


def group_sizes(members: DataFrame, gid: str = "gid") -> DataFrame:
    return members.groupBy(gid).agg(F.count("*").alias("size"))


def group_statistics(members: DataFrame, gid: str = "gid") -> DataFrame:
    """One row of counts, grouping ratio, sizes and comparisons."""
    n, multi = F.col("size"), F.col("size") > 1
    return group_sizes(members, gid).agg(
        F.count("*").alias("groups"),
        F.coalesce(F.sum((~multi).cast("long")), F.lit(0)).alias("singletons"),
        F.coalesce(F.sum(multi.cast("long")), F.lit(0)).alias("multi"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("images"),
        F.coalesce(F.try_divide(F.sum(F.when(multi, n).otherwise(0)), F.sum("size")), F.lit(0.0)).alias("grouping_ratio"),
        F.coalesce(F.avg(F.when(multi, n)), F.lit(1.0)).alias("mean_multi"),
        F.coalesce(F.max("size"), F.lit(0)).alias("max_size"),
        F.coalesce(F.min("size"), F.lit(0)).alias("min_size"),
        F.coalesce(F.avg("size"), F.lit(0.0)).alias("mean_size"),
        F.coalesce(F.sum((n * (n - 1) / 2).cast("long")), F.lit(0)).alias("comparisons"),
    )


def adaptive_thresholds(statistics: DataFrame, global_: float = 0.85, local: float = 0.75) -> DataFrame:
    """A3: thresholds from grouping ratio and largest group; a pure function of the two it is given."""
    ratio, big = F.col("grouping_ratio"), F.col("max_size") > 100
    g = F.when(ratio > 0.8, F.least(F.lit(0.95), F.lit(global_ * 1.1))).when(ratio < 0.1, F.greatest(F.lit(0.7), F.lit(global_ * 0.9))).otherwise(F.lit(global_))
    loc = F.when(ratio > 0.8, F.least(F.lit(0.9), F.lit(local * 1.1))).when(ratio < 0.1, F.greatest(F.lit(0.6), F.lit(local * 0.9))).otherwise(F.lit(local))
    return statistics.select(F.when(big, F.least(F.lit(0.95), g * 1.05)).otherwise(g).alias("global_threshold"), F.when(big, F.least(F.lit(0.9), loc * 1.05)).otherwise(loc).alias("local_threshold"))


def thresholds_by_mean_size(sizes: DataFrame, global_: float = 0.85, local: float = 0.75, size: str = "size") -> DataFrame:
    """The older rule, from the mean group size: over 10 raises the global threshold by a tenth, under 3 lowers it by a tenth.

    Its local threshold is a number of matches that never falls below 10 or 6; with a share such as 0.75 it is therefore 10, 6 or unchanged."""
    mean = F.col("mean_size")
    return sizes.agg(F.avg(size).alias("mean_size")).select(
        F.when(mean > 10, global_ * 1.1).when(mean < 3, global_ * 0.9).otherwise(F.lit(global_)).alias("global_threshold"),
        F.when(mean > 10, F.greatest(F.lit(local), F.lit(10.0))).when(mean < 3, F.greatest(F.lit(local - 2), F.lit(6.0))).otherwise(F.lit(local)).alias("local_threshold"),
    )


def summary(members: DataFrame, scores: DataFrame, gid: str = "gid", count: str | None = None) -> DataFrame:
    """One row: groups, duplicates, sizes and the mean of all known similarities (null without any).

    With ``count``, a row of ``scores`` is the sum of so many."""
    mean = F.avg("score") if count is None else F.try_divide(F.sum("score"), F.sum(count))
    sizes = group_sizes(members, gid).agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("size") - 1), F.lit(0)).alias("duplicates"), F.avg("size").alias("mean_size"), F.max("size").alias("max_size"), F.min("size").alias("min_size"))
    return sizes.join(scores.agg(mean.alias("mean_similarity")))  # one row each


def with_status(members: DataFrame, gid: str = "gid", quality: str = "quality") -> DataFrame:
    """A4: ``status`` Best for the first of the highest quality in a group (by ord), else Duplicate; ``size`` of the group.

    The best is found by a combinable aggregate, so a group of any size is one row before it meets its members."""
    q = F.coalesce(F.col(quality).cast("double"), F.lit(0.0))
    best = members.groupBy(F.col(gid).alias("_g")).agg(F.max(F.struct(q.alias("q"), (-F.col("ord")).alias("o"))).alias("_best"), F.count("*").alias("size"))
    joined = attach(members, best, gid, "_g", "size")
    return joined.withColumn("status", F.when(F.col("ord") == -F.col("_best.o"), "Best").otherwise("Duplicate")).drop("_best")


def report(members: DataFrame, group_id: str = "group_id", quality: str = "quality") -> DataFrame:
    """The report's columns; Best comes after Duplicate within a group, as the sort by falling status has it."""
    rows = with_status(members, group_id, quality)
    out = rows.select(F.col("path").alias("Image Path"), F.round(F.coalesce(F.col(quality).cast("double"), F.lit(0.0)), 2).alias("Quality Score"), F.col(group_id).cast("long").alias("Group ID"), F.col("size").alias("Group Size"), F.col("status").alias("Status"))
    return out.orderBy("Group ID", F.desc("Status"), "Image Path")


def group_information(members: DataFrame, scores: DataFrame | None = None, gid: str = "gid", quality: str = "quality", average: DataFrame | None = None) -> DataFrame:
    """Per group of two or more: size, best, average of the known pair scores (0 if none) and quality improvement.

    The averages come from ``scores`` of pairs (src, dst, score), or as they are from ``average`` (gid, average)."""
    rows = with_status(members, gid, quality).where("size > 1")
    average = _averages(rows, scores, gid) if average is None else average.select(F.col(gid).alias("_g"), "average")
    q = F.coalesce(F.col(quality).cast("double"), F.lit(0.0))
    info = rows.groupBy(gid).agg(F.first("size").alias("size"), F.max(F.when(F.col("status") == "Best", F.col("path"))).alias("best_path"), F.max(q).alias("best_quality"), (F.max(q) - F.min(q)).alias("improvement"))
    return info.join(average, F.col(gid) == F.col("_g"), "left").drop("_g").withColumn("average", F.coalesce("average", F.lit(0.0)))


def _averages(rows: DataFrame, scores: DataFrame, gid: str) -> DataFrame:
    own = rows.select(F.col("ord").alias("_a"), F.col(gid).alias("_ga"))
    other = rows.select(F.col("ord").alias("_b"), F.col(gid).alias("_gb"))
    known = scores.select(F.least("src", "dst").alias("s"), F.greatest("src", "dst").alias("d"), "score").groupBy("s", "d").agg(F.max("score").alias("score"))
    inside = known.join(own, F.col("s") == F.col("_a")).join(other, F.col("d") == F.col("_b")).where("_ga = _gb")
    return inside.groupBy(F.col("_ga").alias("_g")).agg(F.avg("score").alias("average"))


def run_summary(members: DataFrame, gid: str = "gid", quality: str = "quality") -> DataFrame:
    """One row: images, groups, duplicates, share of duplicates, average qualities and their difference."""
    rows = with_status(members, gid, quality)
    q, best = F.coalesce(F.col(quality).cast("double"), F.lit(0.0)), F.col("status") == "Best"
    total = rows.agg(F.count("*").alias("images"), F.sum(best.cast("long")).alias("groups"), F.sum((~best).cast("long")).alias("duplicates"), F.avg(F.when(best, q)).alias("best_quality"), F.avg(F.when(~best, q)).alias("duplicate_quality"))
    return total.select("images", F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"), F.coalesce(F.try_divide(100.0 * F.col("duplicates"), F.col("images")), F.lit(0.0)).alias("duplicate_percent"), "best_quality", "duplicate_quality", (F.col("best_quality") - F.col("duplicate_quality")).alias("difference"))


def processing_report(catalog: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """Every path with its group and group size at each stage (0 where it has none) and Best, Duplicate or Unique from the last."""
    out = catalog.select("path", "ord")
    last = None
    for name, members in stages.items():
        sized = members.join(members.groupBy(F.col("group_id").alias("_g")).agg(F.count("*").alias("_m")), F.col("group_id") == F.col("_g"))
        own = sized.select(F.col("ord").alias("_o"), F.col("group_id").cast("long").alias(f"{name}_group"), F.col("_m").alias(f"{name}_size"), *([F.col("quality").alias("_q")] if "quality" in members.columns else []))
        out = out.join(own, F.col("ord") == F.col("_o"), "left").drop("_o", *(["_q"] if "quality" in members.columns else []))
        out = out.withColumn(f"{name}_group", F.coalesce(f"{name}_group", F.lit(0))).withColumn(f"{name}_size", F.coalesce(f"{name}_size", F.lit(0)))
        last = members
    status = with_status(last, "group_id").select(F.col("ord").alias("_o"), "status", "size")
    kind = F.when(F.coalesce("size", F.lit(0)) > 1, F.col("status")).otherwise("Unique")
    return out.join(status, F.col("ord") == F.col("_o"), "left").withColumn("status", kind).drop("_o", "size")


def largest_groups(members: DataFrame, gid: str = "gid", n: int = 3, shown: int = 3) -> DataFrame:
    """The ``n`` largest groups, then smallest id, with their first members by ord."""
    top = group_sizes(members, gid).orderBy(F.desc("size"), gid).limit(n).select(F.col(gid).alias("_g"), "size")
    rows = members.join(F.broadcast(top), F.col(gid) == F.col("_g"))  # n rows
    first = F.array_sort(F.collect_list(F.struct("ord", "path")))
    parts = rows.withColumn("_salt", F.pmod(F.xxhash64("ord"), F.lit(64)))  # a group may hold a third of all rows: its parts are cut first
    ranked = parts.withColumn("_k", F.row_number().over(Window.partitionBy(gid, "_salt").orderBy("ord"))).where(F.col("_k") <= shown)
    kept = ranked.groupBy(gid, "size").agg(F.slice(first, 1, shown).alias("_f"))
    return kept.select(gid, "size", F.posexplode("_f").alias("_at", "_m")).select(gid, "size", (F.col("_at") + 1).alias("position"), "_m.path")


def status_counts(rows: DataFrame, status: str = "Status") -> DataFrame:
    """A14."""
    return rows.groupBy(status).agg(F.count("*").alias("images"))


def hit_rate(rows: DataFrame, column: str) -> DataFrame:
    """Share of rows that have the value."""
    return rows.agg(F.count(column).alias("hits"), F.count("*").alias("total"), F.coalesce(F.try_divide(F.count(column), F.count("*")), F.lit(0.0)).alias("rate"))


def loader_statistics(attempts: DataFrame, seconds: str, ok: Column) -> DataFrame:
    """Attempts, successes, average time and success rate (0 without attempts)."""
    good = F.sum(F.coalesce(ok, F.lit(False)).cast("long"))
    return attempts.agg(F.count("*").alias("attempts"), F.coalesce(good, F.lit(0)).alias("successes"), F.coalesce(F.avg(seconds), F.lit(0.0)).alias("mean_seconds"), F.coalesce(F.try_divide(good, F.count("*")), F.lit(0.0)).alias("success_rate"))


def copy_summary(results: DataFrame) -> DataFrame:
    """Copied and total by kind."""
    return results.groupBy("kind").agg(F.sum(F.coalesce("ok", F.lit(False)).cast("long")).alias("copied"), F.count("*").alias("total"))


def color_statistics(pairs: DataFrame, similarity: Column, gid: str = "gid") -> DataFrame:
    """Mean pair colour similarity of each group."""
    return pairs.groupBy(gid).agg(F.avg(similarity).alias("mean_similarity"), F.count("*").alias("pairs"))


def newest(rows: DataFrame, key: str, seq: str, most: int) -> DataFrame:
    """What a first-in-first-out store of ``most`` keys holds: each key's last write, the newest keys.

    The cut is found on the keys alone, so only a bounded number of sequence numbers is sorted."""
    last = rows.groupBy(key).agg(F.max(seq).alias(seq))
    return last.orderBy(F.desc(seq), key).limit(most)
