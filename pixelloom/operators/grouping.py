"""Groups in long form (gid, path, ord), gid being an ord of the group: refinement by edges, routing by size, chunks, cliques and vetoes."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelloom.functions.kernels import Kernel
from pixelloom.operators.components import connected_components
from pixelloom.operators.keyed import attach
from pixelloom.operators.numbering import numbered
from pixelloom.operators.pairs import BLOCK, link_pairs
from pixelloom.sources.storage import materialise

#: Rows of a group that are paired at once, without a look at what is linked already.
AT_ONCE = 16 * BLOCK


def components_of(members: DataFrame, edges: DataFrame, gid: str = "gid") -> DataFrame:
    """``members`` with ``gid`` replaced by the smallest ord of the component that ``edges`` (src, dst on ord) make.

    Members without an edge are groups of their own."""
    found = connected_components(edges).select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    joined = members.drop(gid).join(found, F.col("ord") == F.col("_n"), "left")
    return joined.withColumn(gid, F.coalesce("_c", "ord")).drop("_n", "_c")


def group_links(rows: DataFrame, keys: list[str], value: str, kernel: Kernel, least: float, at_once: int = AT_ONCE, block: int = BLOCK) -> DataFrame:
    """(src, dst) with the components of all pairs inside groups of ``keys`` that score ``least`` or more, exact for groups of any size.

    In a group of over ``at_once`` rows about a block of them is linked with all of it first.  What is then outside its largest component
    is paired with the whole group; rows inside that component are linked already, so their pairs can add nothing.  Where most of
    a group is one component the work grows with its rows; at worst, where nothing links, it is that of all pairs."""
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > at_once)  # at most a row for each ``at_once`` rows
    if large.isEmpty():
        return link_pairs(rows, keys, value, kernel, least, block=block)
    picked = F.pmod(F.xxhash64("ord", F.lit(1)), F.ceil(F.col("_n") / block)) == 0
    marked = rows.join(F.broadcast(large), keys, "left").withColumn("_first", F.coalesce(picked, F.lit(True)))
    links = materialise(link_pairs(marked, keys, value, kernel, least, block=block, first="_first"), "links")
    known = connected_components(links).select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    labelled = rows.join(F.broadcast(large.drop("_n")), keys).join(known, F.col("ord") == F.col("_n"), "left").withColumn("_c", F.coalesce("_c", "ord")).drop("_n")
    largest = labelled.groupBy(*keys, "_c").agg(F.count("*").alias("_m")).groupBy(*keys).agg(F.max(F.struct("_m", "_c"))["_c"].alias("_l"))
    rest = labelled.join(F.broadcast(largest), keys).withColumn("_first", F.col("_c") != F.col("_l"))
    return links.unionByName(link_pairs(rest, keys, value, kernel, least, block=block, first="_first"))


def with_size(members: DataFrame, gid: str = "gid") -> DataFrame:
    """the size of a member's group, by a combinable count and a join rather than a window over the group."""
    sizes = members.groupBy(F.col(gid).alias("_g")).agg(F.count("*").alias("size"))
    return attach(members, sizes, gid, "_g", "size")


def number_groups(members: DataFrame, gid: str = "gid", has_hash: Column | None = None) -> DataFrame:
    """``group_id`` counts from 1 by the first ord of a group, groups with a hash first."""
    flag = F.max(has_hash.cast("int")) if has_hash is not None else F.lit(1)
    groups = members.groupBy(F.col(gid).alias("_g")).agg(F.min("ord").alias("_first"), flag.alias("_hash"), F.count("*").alias("_size"))
    placed = numbered(groups, [F.desc("_hash"), F.asc("_first")]).select("_g", (F.col("n") + 1).alias("group_id"), "_size")
    return attach(members, placed, gid, "_g", "_size").drop("_size")


def chunks(members: DataFrame, n: int, gid: str = "gid", drop_single: bool = False) -> DataFrame:
    """``chunk`` of ``n`` consecutive members by ord; a tail of one may be dropped.

    Members are numbered by ranges, not by a window over the group, as a group may hold a third of all members."""
    out = numbered(members, ["ord"], [gid], "_at").withColumn("chunk", F.floor(F.col("_at") / n).cast("long")).drop("_at")
    if not drop_single:
        return out
    sizes = out.groupBy(F.col(gid).alias("_g"), F.col("chunk").alias("_k")).agg(F.count("*").alias("_m"))
    return out.join(sizes, (F.col(gid) == F.col("_g")) & (F.col("chunk") == F.col("_k"))).where("_m > 1").drop("_g", "_k", "_m")


def greedy_cliques(members: DataFrame, matches: DataFrame, gid: str = "gid") -> DataFrame:
    """Along ord, a member joins the current clique if it matches all in it; else it opens the next, and the closed one is never revisited.

    ``matches`` is (gid, src, dst), src < dst.  Groups are at most the stage's cap, so one fits in a task."""
    kind = members.schema[gid].dataType.simpleString()

    def walk(key: tuple, rows: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        linked = set(zip(links["src"], links["dst"], strict=True))
        current, clique = [], None
        out = []
        for o in sorted(rows["ord"]):
            if clique is None or any((m, o) not in linked for m in current):
                current, clique = [], o
            current.append(o)
            out.append((key[0], o, clique))
        return pd.DataFrame(out, columns=[gid, "ord", "clique"])

    found = members.groupBy(gid).cogroup(matches.groupBy(gid)).applyInPandas(walk, f"`{gid}` {kind}, ord long, clique long")
    return members.join(found.select(F.col(gid).alias("_g"), F.col("ord").alias("_o"), "clique"), (F.col(gid) == F.col("_g")) & (F.col("ord") == F.col("_o"))).drop("_g", "_o")


def veto(members: DataFrame, pairs: DataFrame, pair_ok: Column, gid: str = "gid") -> DataFrame:
    """A group of which any pair fails falls apart into single members; a pair with a null verdict fails."""
    verdict = pairs.groupBy(F.col(gid).alias("_g")).agg(F.min(F.coalesce(pair_ok, F.lit(False)).cast("int")).alias("_ok"))
    return members.join(verdict, F.col(gid) == F.col("_g"), "left").withColumn(gid, F.when(F.col("_ok") == 0, F.col("ord")).otherwise(F.col(gid))).drop("_g", "_ok")


def directed_reach(members: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Components over edges from the earlier to the later member only: from the lowest ord on, a member goes to the first group that reaches it.

    Runs inside groups of ``keys`` (the batches of five)."""
    schema = ", ".join(f"`{k}` {members.schema[k].dataType.simpleString()}" for k in keys) + ", ord long, reach long"

    def walk(key: tuple, rows: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        later: dict[int, list[int]] = {}
        for a, b in zip(links["src"], links["dst"], strict=True):
            later.setdefault(a, []).append(b)
        group: dict[int, int] = {}
        for o in sorted(rows["ord"]):
            stack = [] if o in group else [o]
            while stack:
                x = stack.pop()
                if x not in group:
                    group[x] = o
                    stack += later.get(x, [])
        return pd.DataFrame([(*key, o, g) for o, g in group.items()], columns=[*keys, "ord", "reach"])

    found = members.groupBy(*keys).cogroup(edges.groupBy(*keys)).applyInPandas(walk, schema)
    return members.join(found.select(F.col("ord").alias("_o"), "reach"), F.col("ord") == F.col("_o")).drop("_o")


def _merged_by_first(lists: Iterable[list[str]]) -> list[list[str]]:
    """G6 for the lists of one parent group: one whose first member is already placed is absorbed there; any other is added, and its members then belong to it."""
    out: list[list[str]] = []
    home: dict[str, int] = {}
    for own in lists:
        if not own:
            continue
        at = home.get(own[0])
        if at is None:
            at = len(out)
            out.append(list(own))
            home.update(dict.fromkeys(own, at))
        else:
            out[at] += [p for p in own if p not in out[at]]
            home.update({p: home.get(p, at) for p in own})
    return out


def merge_by_first(lists: DataFrame, parent: str = "gid", order: str = "k", members: str = "members") -> DataFrame:
    """(parent, subgroup, position, member) of the lists (parent, order, members) after merging by first member; the identity on disjoint lists.

    The lists of one parent are those of a group within a stage's cap, so one parent is a bounded task; parents run in parallel.
    Empty lists and null members are left out."""
    kind, item = lists.schema[parent].dataType.simpleString(), lists.schema[members].dataType.elementType.simpleString()

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = _merged_by_first([[m for m in own if m is not None] for own in rows.sort_values("_k")["_m"] if own is not None])
        return pd.DataFrame([(key[0], g, i, m) for g, own in enumerate(found) for i, m in enumerate(own)], columns=[parent, "subgroup", "position", "member"])

    picked = lists.select(F.col(parent), F.col(order).alias("_k"), F.col(members).alias("_m"))
    return picked.groupBy(parent).applyInPandas(merge, f"`{parent}` {kind}, subgroup long, position long, member {item}")
