"""Similarity functions as Spark columns; only ``local_similarity`` runs Python, over Arrow batches.  Tags name the rows of the operator inventory."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-7


def _zero() -> Column:
    return F.lit(0.0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: inside a lambda, an outer expression would be worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), _zero(), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, _zero(), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalise(a: Column) -> Column:
    """Unit vector; a zero vector stays."""
    return let(norm(a), lambda size: F.transform(a, lambda x: F.when(size == 0, x.cast("double")).otherwise(x / size)))


def cosine(a: Column, b: Column) -> Column:
    """EPSILON is added to each norm; 0 where a vector is missing."""
    return F.coalesce(dot(a, b) / ((norm(a) + EPSILON) * (norm(b) + EPSILON)), _zero())


def raw_cosine(a: Column, b: Column) -> Column:
    """Plain cosine, 0 for a zero or missing vector."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), _zero())


def color_cosine(a: Column, b: Column) -> Column:
    """X11: cosine moved to 0..1; 0 for a zero or missing vector."""
    size = norm(a) * norm(b)
    return F.when(size > 0, (dot(a, b) / size + 1) / 2).otherwise(_zero())


def binarise(v: Column, share: float = 0.6) -> Column:
    """X1, last step: a bit for each value above the linear percentile of its own vector."""
    at = (F.size(v) - 1) * share
    low = F.floor(at).cast("int")

    def cut(ordered: Column) -> Column:
        a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, F.size(v) - 1))
        return a + (b - a) * (at - low)

    # sort_array compares natively; array_sort would call an interpreted comparator for every pair
    return let(let(F.sort_array(v.cast("array<double>")), cut), lambda c: F.transform(v, lambda x: (x.cast("double") > c).cast("tinyint")))


def pack_bits(bits: Column) -> Column:
    """Bits as 64-bit words, first bit lowest, for ``hamming_words``."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(bits) - 1, F.lit(0)), F.lit(64))
    word = lambda s: F.aggregate(F.transform(F.slice(bits, s + 1, F.lit(64)), lambda x, i: F.call_function("shiftleft", x.cast("long"), i)), F.lit(0).cast("long"), lambda w, x: w.bitwiseOR(x))
    return F.when(F.size(bits) > 0, F.transform(starts, word)).when(bits.isNotNull(), F.array().cast("array<long>"))


def hamming(a: Column, b: Column) -> Column:
    """Share of equal positions; 0 for missing, empty or unequally long hashes."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.coalesce(F.when(F.size(a) == F.size(b), F.try_divide(same, F.size(a))), _zero())


def hamming_words(a: Column, b: Column, bits: Column) -> Column:
    """X9 on packed hashes of ``bits`` positions: one XOR and bit count for 64 of them."""
    differ = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.coalesce(1 - F.try_divide(differ, bits), _zero())


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), _zero(), lambda s, x: s + x))


def dominant_color_distance(a: Column, b: Column, missing: float = 50.0) -> Column:
    """Least distance between the centres of two images; ``missing`` if either has none."""
    return F.coalesce(F.array_min(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: l2(x, y))))), F.lit(missing))


def histogram_correlation(a: Column, b: Column, bins: int, missing: float = 0.5) -> Column:
    """Pearson correlation of sparse histograms (map from bin to count) over ``bins`` bins, not below 0."""
    total = lambda m: F.aggregate(F.map_values(m), _zero(), lambda s, x: s + x)
    square = lambda m: F.aggregate(F.map_values(m), _zero(), lambda s, x: s + x.cast("double") * x)
    both = F.aggregate(F.map_keys(a), _zero(), lambda s, k: s + F.element_at(a, k).cast("double") * F.coalesce(F.try_element_at(b, k), F.lit(0)))
    n = F.lit(float(bins))
    var = lambda m: n * square(m) - total(m) * total(m)
    r = F.try_divide(n * both - total(a) * total(b), F.sqrt(var(a) * var(b)))
    return F.when(a.isNull() | b.isNull(), F.lit(missing)).otherwise(F.greatest(F.coalesce(r, _zero()), _zero()))


def color_similarity(distance: Column, difference: Column, histogram: Column, test_path: Column | None = None, max_distance: float = 50.0, max_difference: float = 30.0) -> Column:
    """Weighted colour score; 0.5 for test paths, 0 if a metric is missing."""
    near = lambda x, most: 1 - F.least(x / most, F.lit(1.0))
    own = 0.5 * near(distance, max_distance) + 0.3 * near(difference, max_difference) + 0.2 * histogram
    own = F.when(distance.isNotNull() & difference.isNotNull() & histogram.isNotNull(), own).otherwise(_zero())  # least() skips nulls
    return own if test_path is None else F.when(test_path, F.lit(0.5)).otherwise(own)


def color_match(similarity: Column, global_cosine: Column, least: float = 0.7, relief: float = 0.2) -> Column:
    """The colour threshold falls as the global vectors agree; without them it is ``least``."""
    return F.coalesce(similarity >= least - relief * F.coalesce(global_cosine, _zero()), F.lit(False))


def _ratio_share(a: np.ndarray, b: np.ndarray, ratio: float, sure: int) -> float:
    """X20 of two descriptor matrices, in blocks of a's rows, so that memory is bounded by b."""
    n = len(a)
    if not n or not len(b):
        return 0.0
    good = few = 0.0
    for lo in range(0, n, step := max(1, (1 << 20) // max(1, b.size))):
        d = np.sqrt(((a[lo : lo + step, None] - b[None]) ** 2).sum(2))
        if n < 2 or len(b) < 2:
            few += (1 / (1 + d.min(1))).sum()
        else:
            two = np.partition(d, 1, axis=1)
            good += (two[:, 0] < ratio * two[:, 1]).sum()
    return float(few / n if n < 2 or len(b) < 2 else good / n * min(1.0, n / sure))


def local_similarity(a: Column, b: Column, ratio: float = 0.75, sure: int = 10) -> Column:
    """Share of a's descriptors whose nearest in b is below ``ratio`` of the second nearest, times min(1, n / ``sure``).

    With fewer than two descriptors on a side: the mean of 1 / (1 + nearest distance).  0 if a side has none or is missing, or if
    descriptors differ in length.  An Arrow function: pairs of one shape are scored together, in steps of bounded memory."""

    def matrix(x: object) -> np.ndarray | None:
        try:
            out = np.array([np.asarray(r, float) for r in x]) if x is not None and len(x) else np.zeros((0, 0))
        except (ValueError, TypeError):
            return None
        return out if out.ndim == 2 else None

    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        out, shapes = np.zeros(len(left)), {}
        for i, (x, y) in enumerate(zip(map(matrix, left), map(matrix, right), strict=True)):
            if x is not None and y is not None and x.size and y.size and x.shape[1] == y.shape[1]:
                shapes.setdefault((x.shape, y.shape), []).append((i, x, y))
        for (shape, other), rows in shapes.items():
            cells = shape[0] * other[0] * shape[1]
            if cells > 1 << 18 or min(shape[0], other[0]) < 2:
                for i, x, y in rows:
                    out[i] = _ratio_share(x, y, ratio, sure)
                continue
            for lo in range(0, len(rows), step := max(1, (1 << 20) // cells)):
                some = rows[lo : lo + step]
                x, y = np.stack([r[1] for r in some]), np.stack([r[2] for r in some])
                two = np.partition(np.sqrt(((x[:, :, None] - y[:, None]) ** 2).sum(3)), 1, axis=2)
                out[[r[0] for r in some]] = (two[..., 0] < ratio * two[..., 1]).sum(1) / shape[0] * min(1.0, shape[0] / sure)
        return pd.Series(out)

    return F.pandas_udf(run, "double")(a, b)


def quality(stored: Column, vector: Column, sharpness: Column, path: Column) -> Column:
    """Stored score, else the global vector's norm, else sharpness, else the length of the file name; 0 if there is nothing."""
    return F.coalesce(stored.cast("double"), norm(vector), sharpness.cast("double"), F.length(basename(path)).cast("double"), _zero())


def basename(path: Column) -> Column:
    """X30."""
    return F.element_at(F.split(path, "/"), -1)


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole; null for a zero whole."""
    return 100 * F.try_divide(part.cast("double"), whole.cast("double"))


def path_key(path: Column) -> Column:
    """A file key of a path that cannot collide, in place of replacing slashes."""
    return F.sha2(path.cast("binary"), 256)


def flat_name(path: Column, suffix: str = ".npy.gz") -> Column:
    """X26, the older scheme: slashes become underscores (not invertible; for reading old stores only)."""
    return F.concat(F.regexp_replace(path, "/", "_"), F.lit(suffix))


def parse_set(raw: Column) -> Column:
    """The distinct members of a set cell: {'a', 'b'}, [..], (..) or a;b; empty for blank, null and nan."""
    text = F.trim(raw)
    inner = F.regexp_extract(text, r"(?s)^[\[({](.*)[\])}]$", 1)
    literal = text.rlike(r"(?s)^[\[({].*[\])}]$")
    parts = F.when(literal, F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r"^(['\"])(.*)\1$", "$2"))).otherwise(F.transform(F.split(text, ";"), lambda x: F.trim(x)))
    blank = text.isNull() | (text == "") | (F.lower(text) == "nan") | (text == "set()")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(parts, lambda x: x != "")))
