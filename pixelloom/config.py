"""Settings of the near-duplicate stages, in one immutable record."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Image file extensions of the catalog, matched at the end of a path without regard to case.
IMAGE_EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tiff", ".tif",
    ".gif", ".jfif", ".pnm", ".ppm", ".pgm", ".pbm",
    ".heic", ".avif", ".ico", ".svg", ".raw", ".cr2",
    ".nef", ".arw", ".dng", ".raf", ".rw2", ".pef",
    ".srw", ".orf", ".x3f", ".mrw", ".mef", ".iiq",
)


@dataclass(frozen=True)
class DedupConfig:
    """Thresholds and caps of the five stages (fixed values of the method they implement)."""

    wavelet_threshold: float = 0.8
    global_threshold: float = 0.85
    local_threshold: float = 0.75
    color_threshold: float = 0.85
    ratio: float = 0.75
    color_distance: float = 50.0
    pixel_difference: float = 30.0
    color_match: float = 0.7
    color_relief: float = 0.2
    veto_factor: float = 1.2
    veto_histogram: float = 0.6
    bands: int = 2
    band_width: int = 16
    band_in_key: bool = False
    bucket_cap: int = 1000
    pair_cap: int = 50_000
    color_cap: int = 15
    color_batch: int = 5
    global_cap: int | None = 50
    """None: no cap, so that groups are refined whole."""
    global_chunk: int = 25
    local_cap: int = 25
    mode: str = "preserve"
    """preserve: every stage partitions its input; compat: members and groups are dropped as the chosen variant does."""
    keep_singletons: bool = True
    """compat mode only: whether images alone after the first stage are set aside and come back at the end."""
    color_method: str = "components"
    """components, batches (directed, fixed batches) or greedy (sequential cliques with an all-or-nothing veto)."""


def memory_efficient() -> DedupConfig:
    return DedupConfig()


def base() -> DedupConfig:
    return replace(DedupConfig(), keep_singletons=False, color_method="greedy", color_cap=30, global_cap=100, global_chunk=50, local_cap=50)


def multithreaded() -> DedupConfig:
    return base()


# Fixed values of the lookup by logical cores: most cores, class, workers (None: as many as cores), groups a chunk, careful with memory.
MACHINES = (
    (2, "low_end", 2, 3, True),
    (4, "entry_level", None, 5, True),
    (8, "mid_range", None, 8, False),
    (16, "high_end", 12, 12, False),
    (None, "server_class", 16, 15, False),
)


def machine_settings(cores: int, memory_gb: float, platform: str = "Linux") -> dict[str, object]:
    """Class, workers, chunk size and memory care for a machine: by cores, then less for little memory, then by platform."""
    kind, most, chunk, careful = next((k, w, c, m) for limit, k, w, c, m in MACHINES if limit is None or cores <= limit)
    workers = most if most is not None and kind == "low_end" else min(most or cores, cores)
    if memory_gb < 8:
        workers, chunk, careful = min(workers, 4), min(chunk, 5), True
    elif memory_gb < 16:
        workers, chunk = min(workers, 8), min(chunk, 10)
    if platform == "Windows":
        workers = max(1, workers - 1)
    elif platform == "Darwin" and cores > 8:
        workers = min(workers, 8)
    return {"config_class": kind, "max_workers": workers, "chunk_size": chunk, "memory_conservative": careful}


def sized_for(cores: int, memory_gb: float) -> dict[str, int]:
    """The same as Spark settings: a shuffle partition for each worker's share of three, and rows of an Arrow batch by chunk size."""
    found = machine_settings(cores, memory_gb)
    return {"spark.sql.shuffle.partitions": max(8, 3 * cores), "spark.sql.execution.arrow.maxRecordsPerBatch": 100 * int(found["chunk_size"])}
