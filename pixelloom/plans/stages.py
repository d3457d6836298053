"""The five stages as DataFrame plans, and the whole run.

A stage takes members (gid, path, ord, features...) and returns them with a refined ``gid``.  In ``preserve`` mode a stage
partitions its input; in ``compat`` mode members that lack the feature, tails of one and groups that fall apart are dropped, as described by the
configuration's variant.  Groups over a stage's cap pass unchanged, so within a stage no group is larger than its cap, and
pairs are quadratic in the cap only; the global stage cuts them into runs instead, or, without a cap, takes every group whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.config import DedupConfig
from pixelloom.functions import vectors as V
from pixelloom.functions.kernels import COSINE, Kernel, local_kernel
from pixelloom.operators import blocking, grouping, pairs, statistics
from pixelloom.sources.storage import materialise


def wavelet_stage(images: DataFrame, config: DedupConfig, hash_col: str = "wavelet") -> DataFrame:
    """LSH bands, capped pairs, Hamming similarity, components; images without a hash are groups of their own."""
    buckets = blocking.lsh_buckets(images, hash_col, "ord", config.bands, config.band_width, config.band_in_key)
    candidates = blocking.bucket_pairs(buckets, config.bucket_cap, config.pair_cap)
    words = images.select(F.col("ord").alias("_o"), V.pack_bits(F.col(hash_col)).alias("_w"), F.size(hash_col).alias("_n"))
    a = words.select(F.col("_o").alias("_oa"), F.col("_w").alias("_wa"), F.col("_n").alias("_na"))
    b = words.select(F.col("_o").alias("_ob"), F.col("_w").alias("_wb"), F.col("_n").alias("_nb"))
    scored = candidates.join(a, F.col("src") == F.col("_oa")).join(b, F.col("dst") == F.col("_ob")).where("_na = _nb")
    edges = scored.where(V.hamming_words(F.col("_wa"), F.col("_wb"), F.col("_na")) >= config.wavelet_threshold).select("src", "dst")
    return grouping.components_of(images.withColumn("gid", F.col("ord")), edges)


def _route(members: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """Members of groups to refine (2 to cap) and of those that pass."""
    sized = grouping.with_size(members)
    work = (F.col("size") > 1) & (F.col("size") <= cap)
    return sized.where(work).drop("size"), sized.where(~work).drop("size")


def refine(members: DataFrame, kernel: Kernel, threshold: float, value: str, cap: int | None, config: DedupConfig, chunk: int | None = None, drop_single: bool = False) -> tuple[DataFrame, DataFrame]:
    """(members, scores): groups split into the components of pairs with score >= threshold.

    ``kernel`` scores pairs by their ``value``.  Members are written once: they are read several times, and the optimiser can fail with
    "key not found" on constraints of computed columns under the unions of group sizes.  With ``chunk``, groups over the cap are cut
    into runs of ``chunk`` members, and pairs are taken inside these; else they pass.  Without a cap (None) whole groups are linked, by ``group_links``."""
    members = materialise(members, "members")
    if config.mode == "compat":
        members = grouping.with_size(members).where("size > 1").drop("size")
    present = F.col(value).isNotNull()
    if cap is None:
        work, passed = members.withColumn("chunk", F.lit(0).cast("long")), members.limit(0)
    elif chunk is None:
        work, passed = _route(members, cap)
        work = work.withColumn("chunk", F.lit(0).cast("long"))
    else:
        sized = grouping.with_size(members)
        small = sized.where(F.col("size") <= cap).drop("size").withColumn("chunk", F.lit(0).cast("long"))
        large = grouping.chunks(sized.where(F.col("size") > cap).drop("size"), chunk, drop_single=config.mode == "compat")
        work, passed = small.unionByName(large), members.limit(0)
    paired = work.where(present), ["gid", "chunk"], value, kernel
    scores = pairs.score_pairs(*paired, "score double").select("src", "dst", "score")
    links = pairs.link_pairs if cap is not None else grouping.group_links
    refined = grouping.components_of(work, links(*paired, threshold)).drop("chunk")
    if config.mode == "compat":
        refined = refined.where(present)
        if drop_single:
            refined = grouping.with_size(refined).where("size > 1").drop("size")
    return refined.unionByName(passed), scores


def color_stage(members: DataFrame, metrics: DataFrame, config: DedupConfig) -> DataFrame:
    """Colour verification from pair metrics (src, dst, similarity, distance, difference, histogram, cosine), src < dst by ord.

    components: undirected over the group; batches: directed over runs of ``color_batch``; greedy: sequential cliques, then the veto."""
    work, passed = _route(members, config.color_cap)
    own = work.select(F.col("ord").alias("_a"), F.col("gid").alias("_ga"))
    other = work.select(F.col("ord").alias("_b"), F.col("gid").alias("_gb"))
    inside = metrics.join(own, F.col("src") == F.col("_a")).join(other, F.col("dst") == F.col("_b")).where("_ga = _gb").withColumn("gid", F.col("_ga")).drop("_a", "_b", "_ga", "_gb")
    if config.color_method == "components":
        edges = inside.where(F.col("similarity") >= config.color_threshold)
        return grouping.components_of(work, edges.select("src", "dst")).unionByName(passed)
    if config.color_method == "batches":
        batched = grouping.chunks(work, config.color_batch)
        at = batched.select(F.col("ord").alias("_o"), F.col("chunk").alias("_k"))
        edges = inside.where(F.col("similarity") >= config.color_threshold).join(at, F.col("src") == F.col("_o")).withColumnRenamed("_k", "chunk").drop("_o")
        edges = edges.join(at, F.col("dst") == F.col("_o")).where("chunk = _k").select("gid", "chunk", "src", "dst")
        reached = grouping.directed_reach(batched, edges, ["gid", "chunk"])
        return reached.withColumn("gid", F.col("reach")).drop("chunk", "reach").unionByName(passed)
    match = V.color_match(F.col("similarity"), F.col("cosine"), config.color_match, config.color_relief)
    cliques = grouping.greedy_cliques(work, inside.where(match).select("gid", "src", "dst"))
    regrouped = cliques.withColumn("gid", F.col("clique")).drop("clique")
    same = regrouped.select(F.col("ord").alias("_a"), F.col("gid").alias("_ga"))
    with_gid = inside.drop("gid").join(same, F.col("src") == F.col("_a")).join(same.toDF("_b", "_gb"), F.col("dst") == F.col("_b")).where("_ga = _gb").withColumn("gid", F.col("_ga"))
    ok = (F.col("distance") <= config.color_distance * config.veto_factor) & (F.col("difference") <= config.pixel_difference * config.veto_factor) & (F.col("histogram") >= config.veto_histogram)
    return grouping.veto(regrouped, with_gid, ok).unionByName(passed)


def global_stage(members: DataFrame, config: DedupConfig, vector: str = "global") -> tuple[DataFrame, DataFrame]:
    return refine(members, COSINE, config.global_threshold, vector, config.global_cap, config, config.global_chunk)


def local_stage(members: DataFrame, config: DedupConfig, descriptors: str = "descriptors") -> tuple[DataFrame, DataFrame]:
    return refine(members, local_kernel(config.ratio), config.local_threshold, descriptors, config.local_cap, config, drop_single=True)


def deduplicate(images: DataFrame, metrics: DataFrame | None, config: DedupConfig, adaptive: bool = False, progress: Callable[[str, float], None] | None = None) -> dict[str, DataFrame]:
    """All stages over images (path, ord, wavelet, global, descriptors, quality): members after each, and pair scores.

    In compat mode images without a hash are left out, and images alone after the first stage pass the others by, or go, as the
    configuration says.  ``progress`` is told the stage and the percentage of stages that are planned."""
    tell = progress or (lambda stage, percent: None)
    first = materialise(wavelet_stage(images, config), "wavelet")  # each stage reads its input several times, and a lost executor costs no earlier stage
    tell("wavelet", 20.0)
    aside = first.limit(0)
    if config.mode == "compat":
        sized = grouping.with_size(first.where(F.col("wavelet").isNotNull()))
        first, single = sized.drop("size"), sized.where("size = 1").drop("size")
        work, aside = sized.where("size > 1").drop("size"), single if config.keep_singletons else aside
    else:
        work = first
    if adaptive:
        t = statistics.adaptive_thresholds(statistics.group_statistics(first), config.global_threshold, config.local_threshold).first()
        config = replace(config, global_threshold=t.global_threshold, local_threshold=t.local_threshold)
    color = materialise(color_stage(work, metrics, config), "color") if metrics is not None else work
    tell("color", 40.0)
    global_, global_scores = global_stage(color, config)
    global_ = materialise(global_, "global")
    tell("global", 60.0)
    local, local_scores = local_stage(global_, config)
    local = materialise(local, "local")
    tell("local", 80.0)
    out = {"wavelet": first} | {name: members.unionByName(aside) for name, members in (("color", color), ("global", global_), ("local", local))}
    return out | {"scores": global_scores.unionByName(local_scores)}
