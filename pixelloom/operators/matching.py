"""Descriptor matching between images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelloom.functions.vectors import l2, normalise


def ratio_matches(a: DataFrame, b: DataFrame, ratio: float = 0.8) -> DataFrame:
    """One-way matches (pair, i, j, distance) of descriptor rows (pair, idx, vec): nearest below ``ratio`` of the second nearest."""
    left = a.select("pair", F.col("idx").alias("i"), F.col("vec").alias("_a"))
    right = b.select(F.col("pair").alias("_p"), F.col("idx").alias("j"), F.col("vec").alias("_b"))
    near = left.join(right, F.col("pair") == F.col("_p")).select("pair", "i", "j", l2(F.col("_a"), F.col("_b")).alias("distance"))
    w = Window.partitionBy("pair", "i").orderBy("distance", "j")
    ranked = near.withColumn("rank", F.row_number().over(w)).withColumn("second", F.lead("distance").over(w))
    return ranked.where((F.col("rank") == 1) & (F.col("distance") < ratio * F.col("second"))).select("pair", "i", "j", "distance")


def mutual_matches(a: DataFrame, b: DataFrame, ratio: float = 0.8, least: int = 8) -> DataFrame:
    """Matches of unit descriptors that hold both ways; pairs with fewer than ``least`` descriptors on a side have none."""
    counted = lambda d: d.groupBy("pair").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("pair")
    unit = lambda d: d.withColumn("vec", normalise(F.col("vec")))
    enough = counted(a).join(counted(b), "pair")
    a, b = (unit(d.join(enough, "pair", "left_semi")) for d in (a, b))
    back = ratio_matches(b, a, ratio).select(F.col("pair").alias("_p"), F.col("i").alias("_j"), F.col("j").alias("_i"))
    forth = ratio_matches(a, b, ratio)
    return forth.join(back, (F.col("pair") == F.col("_p")) & (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")), "left_semi")


def _fundamental(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Eight-point estimate from points of equal index, normalised, of rank two."""

    def scaled(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centre = p.mean(0)
        s = np.sqrt(2) / max(np.sqrt(((p - centre) ** 2).sum(1)).mean(), 1e-12)
        t = np.array([[s, 0, -s * centre[0]], [0, s, -s * centre[1]], [0, 0, 1]])
        return np.column_stack((p, np.ones(len(p)))) @ t.T, t

    (a, ta), (b, tb) = scaled(x), scaled(y)
    f = np.linalg.svd((b[:, :, None] * a[:, None, :]).reshape(len(a), 9))[2][-1].reshape(3, 3)
    u, s, v = np.linalg.svd(f)
    return tb.T @ (u @ np.diag([s[0], s[1], 0]) @ v) @ ta


def epipolar_inliers(x: np.ndarray, y: np.ndarray, reach: float = 3.0, rounds: int = 200, seed: int = 0) -> int:
    """Most points within ``reach`` of their epipolar lines for a fundamental matrix of eight random points."""
    r, most = np.random.default_rng(seed), 0
    xh, yh = np.column_stack((x, np.ones(len(x)))), np.column_stack((y, np.ones(len(y))))
    for _ in range(rounds):
        pick = r.choice(len(x), 8, replace=False)
        f = _fundamental(x[pick], y[pick])
        fx, fy = xh @ f.T, yh @ f
        off = np.abs((yh * fx).sum(1))
        far = np.maximum(off / np.maximum(np.hypot(fx[:, 0], fx[:, 1]), 1e-12), off / np.maximum(np.hypot(fy[:, 0], fy[:, 1]), 1e-12))
        most = max(most, int((far <= reach).sum()))
    return most


def geometric_verification(matches: Column, least: int = 8) -> Column:
    """(inlier ratio, inliers) of an array of matched points (x1, y1, x2, y2); (0, 0) below ``least`` matches."""

    def run(points: pd.Series) -> pd.DataFrame:
        out = []
        for p in points:
            m = np.array([list(x.values()) if isinstance(x, dict) else list(x) for x in p], float) if p is not None and len(p) else np.zeros((0, 4))
            n = epipolar_inliers(m[:, :2], m[:, 2:]) if len(m) >= least else 0
            out.append((n / len(m) if n else 0.0, n))
        return pd.DataFrame(out, columns=["ratio", "inliers"])

    return F.pandas_udf(run, "ratio double, inliers long")(matches)
