"""Image kernels in numpy and their Arrow functions.

Images are the structs of Spark's ``image`` source (BGR, row-wise) or plain arrays of height x width x 3.
Functions that fail on an image give null for it, as a missing feature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The low-pass decomposition filter of the biorthogonal 6.8 wavelet, and its high-pass partner's source.
BIOR68_LOW = (
    0.0, 0.0019088317364812906, -0.0019142861290887667, -0.016990639867602342, 0.01193456527972926, 0.04973290349094079,
    -0.07726317316720414, -0.09405920349573646, 0.4207962846098268, 0.8259229974584023, 0.4207962846098268, -0.09405920349573646,
    -0.07726317316720414, 0.04973290349094079, 0.01193456527972926, -0.016990639867602342, -0.0019142861290887667, 0.0019088317364812906,
)
BIOR68_HIGH = (
    0.0, 0.0, 0.0, 0.014426282505624435, -0.014467504896790148, -0.07872200106262882, 0.04036797903033992, 0.41784910915027457, -0.7589077294536541,
    0.41784910915027457, 0.04036797903033992, -0.07872200106262882, -0.014467504896790148, 0.014426282505624435, 0.0, 0.0, 0.0, 0.0,
)


def pixels(image: dict) -> np.ndarray | None:
    """An image struct as an array (height, width, 3) BGR; null for one that could not be decoded."""
    if image is None or image["height"] <= 0:
        return None
    out = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])
    return np.repeat(out, 3, 2) if out.shape[2] == 1 else out[:, :, :3]


def gray(bgr: np.ndarray) -> np.ndarray:
    return np.rint(bgr.astype(float) @ (0.114, 0.587, 0.299)).clip(0, 255)


@cache
def _weights(size: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = ((np.arange(to) + 0.5) * size / to - 0.5).clip(0, size - 1)
    low = np.floor(at).astype(int)
    return low, np.minimum(low + 1, size - 1), at - low


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    a, b, t = _weights(image.shape[0], height)
    rows = image[a] * (1 - t).reshape(-1, *[1] * (image.ndim - 1)) + image[b] * t.reshape(-1, *[1] * (image.ndim - 1))
    a, b, t = _weights(image.shape[1], width)
    t = t.reshape(1, -1, *[1] * (image.ndim - 2))
    return rows[:, a] * (1 - t) + rows[:, b] * t


def _step(x: np.ndarray, taps: tuple[float, ...]) -> np.ndarray:
    """One decomposition step along the last axis with half-sample symmetric ends: (n + taps - 1) // 2 values."""
    n, k = x.shape[-1], len(taps)
    period = np.concatenate((np.arange(n), np.arange(n)[::-1]))
    at = 2 * np.arange((n + k - 1) // 2)[:, None] + 1 - np.arange(k)[None, :]
    return x[..., period[at % (2 * n)]] @ np.array(taps)


def wavelet_coefficients(image: np.ndarray, levels: int = 4, side: int = 64) -> np.ndarray:
    """Approximation, then horizontal, vertical and diagonal details from the coarsest level on."""
    a, details = resize(gray(image), side, side), []
    for _ in range(levels):
        low, high = _step(a, BIOR68_LOW), _step(a, BIOR68_HIGH)
        parts = [_step(x.T, taps).T for x in (low, high) for taps in (BIOR68_LOW, BIOR68_HIGH)]
        a, details = parts[0], [[parts[1], parts[2], parts[3]], *details]
    return np.concatenate([a.ravel(), *(d.ravel() for level in details for d in level)])


def wavelet_hash(image: np.ndarray) -> np.ndarray:
    """A bit for each coefficient above the 60th percentile."""
    c = wavelet_coefficients(image)
    return (c > np.percentile(c, 60)).astype(np.int8)


def mean_hash(image: np.ndarray, side: int = 64) -> np.ndarray:
    """X2, per image: two-by-two means above their own mean."""
    g = resize(gray(image), side, side).reshape(side // 2, 2, side // 2, 2).mean((1, 3))
    return (g > g.mean()).astype(np.int8).ravel()


def channel_histograms(image: np.ndarray, bins: int = 256) -> np.ndarray:
    """X3, per image: shares of each channel's values."""
    found = [np.bincount(image[..., c].ravel().astype(np.int64) * bins // 256, minlength=bins) for c in range(3)]
    return np.concatenate(found) / max(1, image.shape[0] * image.shape[1])


def _edges(image: np.ndarray) -> np.ndarray:
    """Sobel magnitudes."""
    g = np.pad(gray(image), 1, mode="reflect")
    dx = g[:-2, 2:] + 2 * g[1:-1, 2:] + g[2:, 2:] - g[:-2, :-2] - 2 * g[1:-1, :-2] - g[2:, :-2]
    dy = g[2:, :-2] + 2 * g[2:, 1:-1] + g[2:, 2:] - g[:-2, :-2] - 2 * g[:-2, 1:-1] - g[:-2, 2:]
    return np.hypot(dx, dy)


def edge_histogram(image: np.ndarray, bins: int = 32) -> np.ndarray:
    """X4, per image: shares of Sobel magnitudes."""
    m = _edges(image)
    return np.histogram(m, bins, (0, max(float(m.max()), 1e-9)))[0] / m.size


def largest_edges(image: np.ndarray) -> float:
    """Share of pixels with the largest Sobel magnitude."""
    m = _edges(image)
    return float((m >= m.max() - 1e-9).mean())


def preprocess(image: np.ndarray, side: int = 224) -> np.ndarray:
    """Resized and scaled to 0..1."""
    return resize(image.astype(float), side, side) / 255


def sharpness(image: np.ndarray) -> float:
    """Variance of the Laplacian per pixel, scaled, at most 100."""
    g = np.pad(gray(image), 1, mode="reflect")
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return float(min(100.0, lap.var() / lap.size * 1e6))


def lab(bgr: np.ndarray) -> np.ndarray:
    """CIE L*a*b* (D65) in the 8-bit layout: L scaled to 255, a and b moved by 128."""
    c = bgr[..., ::-1] / 255.0
    linear = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    to_xyz = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
    x = linear @ to_xyz.T / (0.950456, 1.0, 1.088754)
    f = np.where(x > 0.008856, np.cbrt(x), 7.787 * x + 16 / 116)
    bright = np.where(x[..., 1] > 0.008856, 116 * f[..., 1] - 16, 903.3 * x[..., 1])
    return np.stack((bright * 255 / 100, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128), -1)


def dominant_colors(image: np.ndarray, n: int = 2, side: int = 64, rounds: int = 20, seed: int = 42) -> np.ndarray:
    """Centres of a seeded k-means in L*a*b*, the most frequent first."""
    points = lab(resize(image.astype(float), side, side)).reshape(-1, 3)
    r = np.random.default_rng(seed)
    centres = points[r.integers(len(points))][None]
    while len(centres) < n:
        far = ((points[:, None] - centres[None]) ** 2).sum(2).min(1)
        centres = np.vstack((centres, points[int(far.argmax())]))
    for _ in range(rounds):
        own = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.stack([points[own == k].mean(0) if (own == k).any() else centres[k] for k in range(n)])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres[np.argsort(-np.bincount(own, minlength=n), kind="stable")]


def pixel_difference(a: np.ndarray, b: np.ndarray) -> float:
    """Mean absolute L*a*b* difference at the smaller height and width."""
    h, w = min(a.shape[0], b.shape[0]), min(a.shape[1], b.shape[1])
    return float(np.abs(lab(resize(a.astype(float), h, w)) - lab(resize(b.astype(float), h, w))).mean())


# Means and standard deviations by which a global network's input is normalised, and the sides of both networks' inputs.
CHANNEL_MEAN, CHANNEL_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
GLOBAL_SIDE, LOCAL_SIDE = 600, 800


def global_vector(image: np.ndarray, network: Callable[[np.ndarray], np.ndarray], side: int = GLOBAL_SIDE) -> np.ndarray:
    """The network's feature maps (channels, height, width) of the resized, normalised image (3, side, side), averaged over the picture, as a unit vector.

    The network is any function on arrays, such as an onnxruntime session; a zero vector stays zero."""
    x = (resize(image.astype(float), side, side) / 255 - CHANNEL_MEAN) / CHANNEL_STD
    maps = np.asarray(network(np.ascontiguousarray(x.transpose(2, 0, 1), np.float32)), np.float64)
    pooled = maps.reshape(len(maps), -1).mean(1)
    return (pooled / max(float(np.sqrt((pooled * pooled).sum())), 1e-12)).astype(np.float32)


def local_features(image: np.ndarray, detector: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], side: int = LOCAL_SIDE) -> dict[str, np.ndarray]:
    """Keypoints (n, 2) and descriptors (n, d) that a detector finds in the gray image (side, side) of values 0..1; a single descriptor is one row."""
    points, descriptors = detector((resize(gray(image), side, side) / 255).astype(np.float32))
    return {"keypoints": np.atleast_2d(np.asarray(points, np.float32)), "descriptors": np.atleast_2d(np.asarray(descriptors, np.float32))}


def color_bins(image: np.ndarray, per_channel: int = 32) -> dict[int, int]:
    """X17's histogram: counts of joint colour bins in the middle 80 % of the image."""
    h, w = image.shape[:2]
    mid = image[h // 10 : h - h // 10, w // 10 : w - w // 10].astype(np.int64) * per_channel // 256
    keys, n = np.unique((mid[..., 0] * per_channel + mid[..., 1]) * per_channel + mid[..., 2], return_counts=True)
    return dict(zip(keys.tolist(), n.tolist(), strict=True))


def per_image(kernel: Callable[[np.ndarray], object], kind: str) -> Callable[[Column], Column]:
    """An Arrow function over image structs; null where an image is missing or the kernel fails on it."""

    def run(images: pd.DataFrame) -> pd.Series:
        out = []
        for x in images.to_dict("records"):
            try:
                p = pixels(x)
                v = kernel(p) if p is not None else None
            except (ValueError, IndexError, TypeError):
                v = None
            out.append(v.tolist() if isinstance(v, np.ndarray) else v)
        return pd.Series(out, dtype=object)

    return lambda image: F.pandas_udf(run, kind)(image)  # made on use: a return type is parsed by a running session


wavelet_hash_of = per_image(wavelet_hash, "array<tinyint>")
sharpness_of = per_image(sharpness, "double")
dominant_colors_of = per_image(dominant_colors, "array<array<double>>")
color_bins_of = per_image(color_bins, "map<int,long>")


def pixel_difference_of(a: Column, b: Column) -> Column:
    """X16 for pairs of image structs; 25 where one is missing."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
        both = zip(a.to_dict("records"), b.to_dict("records"), strict=True)
        return pd.Series([25.0 if (p := pixels(x)) is None or (q := pixels(y)) is None else pixel_difference(p, q) for x, y in both])

    return F.pandas_udf(run, "double")(a, b)


def extract(images: DataFrame, models: dict[str, Callable[[], Callable[[np.ndarray], object]]] | None = None) -> DataFrame:
    """(path, wavelet, quality, colors, bins, and a column of array<float> for each model) of an image table.

    X6, X7: ``models`` maps a column to a maker that loads a deep model once a worker and returns image -> vector; it is how
    a network is plugged in.  The whole extraction is one narrow pass."""
    models = models or {}
    schema = "path string, wavelet array<tinyint>, quality double, colors array<array<double>>, bins map<int,long>" + "".join(f", `{m}` array<float>" for m in models)
    kernels = {"wavelet": wavelet_hash, "quality": sharpness, "colors": dominant_colors, "bins": color_bins}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = kernels | {k: make() for k, make in models.items()}
        for b in batches:
            rows = []
            for path, image in zip(b["path"], b["image"], strict=True):
                row = {"path": path}
                for name, f in own.items():
                    try:
                        p = pixels(image.asDict() if hasattr(image, "asDict") else image)
                        v = f(p) if p is not None else None
                    except (ValueError, IndexError, TypeError):
                        v = None
                    row[name] = v.tolist() if isinstance(v, np.ndarray) else v
                rows.append(row)
            yield pd.DataFrame(rows, columns=["path", *own])

    return images.select("path", "image").mapInPandas(run, schema)
