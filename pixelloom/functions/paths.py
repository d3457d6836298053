"""Path predicates and address helpers as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixelloom.config import IMAGE_EXTENSIONS

# Substrings that mark a path as a test image, by the variant that uses them.
TEST_PATTERNS = {
    "base": ("test_image_", "fake_image_", "dummy_image_", "/tmp/", "\\tmp\\", "temp_", ".tmp"),
    "loader": (
        "test_", "fake_", "dummy_", "sample_",
        "/test/", "/fake/", "/dummy/", "/sample/",
        "test.", "fake.", "dummy.", "sample.",
        "/tmp/", "temp_", "/temp/",
    ),
    "strict": (
        "test_", "dummy_", "sample_", "mock_", "fake_", "placeholder", "example", "demo", "temp_", "tmp_",
        "_test.", "_dummy.", "_sample.", "_mock.", "_fake.", "_temp.", "_tmp.",
    ),
}
#: Fixed values of the strict variant: shorter paths always count as tests; those between only without the exempt word.
STRICT_SHORT, STRICT_EXEMPT, STRICT_LEAST = 5, "testequity", 10


def is_image(path: Column, extensions: tuple[str, ...] = IMAGE_EXTENSIONS) -> Column:
    """The path ends in an image extension, in any case; false for null."""
    dots = "|".join(e.lstrip(".") for e in extensions)
    return F.coalesce(F.lower(path).rlike(rf"\.({dots})$"), F.lit(False))


def is_test_path(path: Column, variant: str = "loader") -> Column:
    """one configurable predicate; the strict variant also goes by length.  Null is no test path."""
    lowered = F.lower(path)
    found = F.lit(False)
    for p in TEST_PATTERNS[variant]:
        found = found | lowered.contains(p)
    if variant == "strict":
        found = found | (F.length(path) < STRICT_SHORT) | (~lowered.contains(STRICT_EXEMPT) & (F.length(path) < STRICT_LEAST))
    return F.coalesce(found, F.lit(False))


def container_of(url: Column) -> Column:
    """The first segment of an address's path; null without one."""
    return F.nullif(F.element_at(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), 2), F.lit(""))


def query_items(url: Column) -> Column:
    """The query string as an ordered list of key=value, percent-decoded."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.try_url_decode(x))


def with_query(url: Column, query: Column) -> Column:
    """An address with a query string, with exactly one question mark."""
    return F.concat(F.regexp_replace(url, r"\?.*$", ""), F.lit("?"), F.regexp_replace(query, r"^\?", ""))


def destination(path: Column, folder: str | Column) -> Column:
    """K6: folder plus file name, one slash between."""
    folder = F.lit(folder) if isinstance(folder, str) else folder
    return F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/"), F.element_at(F.split(path, "/"), -1))
