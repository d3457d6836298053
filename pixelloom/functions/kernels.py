"""Pair scores in numpy for blocks of rows: each equals its column function in ``vectors`` or ``images``, for all pairs of two slices at once.

A kernel is (prepare, score): ``prepare`` turns an Arrow column into what ``score`` reads; ``score(x, i, y, j)`` gives a matrix, or a
tuple of them, for rows ``i`` of x against rows ``j`` of y (slices).  Masked entries are null."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pixelloom.functions.images import lab, pixels, resize
from pixelloom.functions.vectors import EPSILON, _ratio_share


class Kernel(NamedTuple):
    prepare: Callable[[pa.Array], object]
    score: Callable[[object, slice, object, slice], object]


class Vectors(NamedTuple):
    m: np.ndarray  # rows, filled up with zeros
    size: np.ndarray  # values in a row, -1 where it or one of its values is missing
    norm: np.ndarray


def vectors(column: pa.Array) -> Vectors:
    size = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    if not flat.null_count and len(size) and size[0] >= 0 and (size == size[0]).all():
        m = flat.to_numpy().astype(np.float64).reshape(len(size), size[0])
    else:
        rows = column.to_pylist()
        size = np.array([-1 if r is None or None in r else len(r) for r in rows], np.int64)
        m = np.zeros((len(rows), max(size.max(initial=0), 0)))
        for i, r in enumerate(rows):
            if size[i] > 0:
                m[i, : size[i]] = r
    return Vectors(m, size, np.sqrt((m * m).sum(1)))


def _dots(x: Vectors, i: slice, y: Vectors, j: slice) -> tuple[np.ndarray, np.ndarray | None]:
    """Inner products, and where there is none: a missing vector or unequal lengths."""
    n = max(x.m.shape[1], y.m.shape[1])
    full = lambda m: m if m.shape[1] == n else np.pad(m, ((0, 0), (0, n - m.shape[1])))
    off = (x.size[i, None] != y.size[None, j]) | (x.size[i, None] < 0)
    return full(x.m[i]) @ full(y.m[j]).T, off if off.any() else None


def _cosine(x: Vectors, i: slice, y: Vectors, j: slice) -> np.ndarray:
    dot, off = _dots(x, i, y, j)
    dot /= (x.norm[i, None] + EPSILON) * (y.norm[None, j] + EPSILON)
    if off is not None:
        dot[off] = 0
    return dot


def _variants(x: Vectors, i: slice, y: Vectors, j: slice) -> tuple[np.ndarray, np.ndarray]:
    dot, off = _dots(x, i, y, j)
    size = x.norm[i, None] * y.norm[None, j]
    none = (x.size[i, None] < 0) | (y.size[None, j] < 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        raw = np.where(size == 0, 0.0, dot / size)
    moved = np.where((size <= 0) | none, 0.0, (raw + 1) / 2)
    if off is not None:
        raw[off] = 0
        moved = np.ma.masked_array(moved, off & ~none & ~(size <= 0))
    return raw, moved


def _raw(x: Vectors, i: slice, y: Vectors, j: slice) -> np.ndarray:
    unit = lambda v, k: v._replace(m=v.m[k] / np.where(v.norm[k] == 0, 1, v.norm[k])[:, None], size=v.size[k])
    dot, off = _dots(unit(x, i), slice(None), unit(y, j), slice(None))
    if off is not None:
        dot[off] = 0
    return dot


#: X10, X12, and the pair X12, X11.
COSINE, RAW_COSINE, COSINE_VARIANTS = Kernel(vectors, _cosine), Kernel(vectors, _raw), Kernel(vectors, _variants)


def color_kernel(max_distance: float = 50.0, max_difference: float = 30.0, least: float = 0.7, relief: float = 0.2) -> Kernel:
    """(similarity, match) of vectors whose first three values are the colour measures, as ``color_similarity`` and ``color_match``."""

    def score(x: Vectors, i: slice, y: Vectors, j: slice) -> tuple[np.ndarray, np.ndarray]:
        near = lambda d, most: 1 - np.fmin(d / most, 1.0)
        known = (x.size[i, None] > 2) & (y.size[None, j] > 2)
        if x.m.shape[1] < 3 or y.m.shape[1] < 3:
            similarity = np.zeros(known.shape)
        else:
            far = lambda k: np.abs(x.m[i, None, k] - y.m[None, j, k])
            own = 0.5 * near(100 * far(0), max_distance) + 0.3 * near(60 * far(1), max_difference) + 0.2 * (1 - far(2))
            similarity = own if known.all() else np.where(known, own, 0.0)
        return similarity, similarity >= least - relief * _cosine(x, i, y, j)

    return Kernel(vectors, score)


def _by_shape(x: list, y: list, kernel: Callable[[list[int], list[int]], np.ndarray], missing: float) -> np.ndarray:
    """The matrix of pairs of items (arrays or None), by ``kernel`` for all items of a shape against all of another."""
    out = np.full((len(x), len(y)), missing)
    shapes: tuple[dict, dict] = {}, {}
    for found, items in zip(shapes, (x, y), strict=True):
        for k, a in enumerate(items):
            if a is not None:
                found.setdefault(a.shape, []).append(k)
    for i in shapes[0].values():
        for j in shapes[1].values():
            out[np.ix_(i, j)] = kernel(i, j)
    return out


def _matrices(column: pa.Array) -> list:
    out = []
    for x in column.to_pylist():
        try:
            m = np.array([np.asarray(r, float) for r in x]) if x else None
        except (ValueError, TypeError):
            m = None
        out.append(m if m is not None and m.ndim == 2 and m.size else None)
    return out


#: Distances that are held at once, and the error of a squared distance by a product, as a share of the squared lengths.
STEP, NEAR = 1 << 16, 1e-13


def _two_least(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and second least along the middle axis of two or more, by halves."""
    low, high = d, None
    while (k := low.shape[1]) > 1:
        h = k // 2
        a, b = low[:, :h], low[:, h : 2 * h]
        second = np.maximum(a, b)
        if high is not None:
            np.minimum(second, high[:, :h], out=second)
            np.minimum(second, high[:, h : 2 * h], out=second)
        first = np.minimum(a, b)
        if k % 2:
            first = np.concatenate((first, low[:, -1:]), 1)
            second = np.concatenate((second, np.full_like(low[:, -1:], np.inf) if high is None else high[:, -1:]), 1)
        low, high = first, second
    return low[:, 0], high[:, 0]


def local_kernel(ratio: float = 0.75, sure: int = 10) -> Kernel:
    """X20, as ``local_similarity``: matrices of one shape are compared with all of another at once."""

    def score(x: list, i: slice, y: list, j: slice) -> np.ndarray:
        x, y = x[i], y[j]

        def one(a: list[int], b: list[int]) -> np.ndarray:
            (n, width), (m, other) = x[a[0]].shape, y[b[0]].shape
            if width != other:
                return np.zeros((len(a), len(b)))
            if n < 2 or m < 2 or n * m > 4_096:
                return np.array([[_ratio_share(x[p], y[q], ratio, sure) for q in b] for p in a])
            # squared distances as one product: x2 + y2 - 2xy
            out, theirs = np.empty((len(a), len(b))), np.stack([y[q] for q in b]).transpose(2, 1, 0)  # (value, descriptor, row)
            theirs = np.concatenate((-2 * theirs, np.ones((1, m, len(b))), (theirs * theirs).sum(0, keepdims=True)))
            step = max(1, STEP // (n * m))
            for lo in range(0, len(b), step):
                part = np.ascontiguousarray(theirs[:, :, lo : lo + step])
                flat, longest = part.reshape(width + 2, -1), part[-1].max()
                for row, p in enumerate(a):
                    own = (x[p] * x[p]).sum(1)
                    first, second = _two_least((np.column_stack((x[p], own, np.ones(n))) @ flat).reshape(n, m, -1))
                    lead = ratio * ratio * second - first
                    score = (lead > 0).sum(0) / n * min(1.0, n / sure)
                    for k in np.flatnonzero(~(np.abs(lead) > NEAR * (own.max() + longest)).all(0)).tolist():  # too close for the product's rounding
                        score[k] = _ratio_share(x[p], y[b[lo + k]], ratio, sure)
                    out[row, lo : lo + step] = score
            return out

        return _by_shape(x, y, one, 0.0)

    return Kernel(_matrices, score)


def _pictures(column: pa.Array) -> list:
    out = []
    for x in column.to_pylist():
        p = pixels(x)
        out.append(None if p is None else p.astype(float))
    return out


class _Labs(NamedTuple):
    images: list
    made: dict  # (row, height, width) -> flat L*a*b*


def _difference(x: _Labs, i: slice, y: _Labs, j: slice) -> np.ndarray:
    at = range(len(x.images))[i], range(len(y.images))[j]

    def one(a: list[int], b: list[int]) -> np.ndarray:
        p, q = x.images[at[0][a[0]]], y.images[at[1][b[0]]]
        h, w = min(p.shape[0], q.shape[0]), min(p.shape[1], q.shape[1])

        def flat(of: _Labs, k: int) -> np.ndarray:
            if (k, h, w) not in of.made:
                of.made[k, h, w] = lab(resize(of.images[k], h, w)).ravel()
            return of.made[k, h, w]

        theirs, out = np.stack([flat(y, at[1][k]) for k in b]), np.empty((len(a), len(b)))
        step = max(1, (1 << 16) // max(1, theirs.shape[1]))
        for row, k in enumerate(a):
            mine = flat(x, at[0][k])
            for lo in range(0, len(b), step):
                t = theirs[lo : lo + step] - mine
                out[row, lo : lo + step] = np.abs(t, out=t).mean(1)
        return out

    return _by_shape(x.images[i], y.images[j], one, 25.0)


#: X16, as ``pixel_difference_of``: each picture is brought to L*a*b* once a block rather than once a pair.
PIXEL_DIFFERENCE = Kernel(lambda column: _Labs(_pictures(column), {}), _difference)
