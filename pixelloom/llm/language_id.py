"""Language identification by Bayesian evidence fusion (operator 5).

A row's language is the most probable one given four kinds of evidence, taken as independent given the language:

    P(l | row)  ~  P(text | l) * P(declared | l) * P(suffix | l) * P(l | host)

*Text*: multinomial over hashed byte trigrams, learned from at most ``SAMPLE`` labelled rows of each of the ``LANGUAGES`` most frequent
labels (the ones of smallest id hash).  A text's mean log likelihood counts for at most ``WEIGHT`` trigrams, as neighbours aren't independent.
An undetermined language, uniform over trigrams, stands for text in none of the languages.

*Declared* markup language and *address suffix*: shares of each value among the rows whose text alone suggests the language,
smoothed by ``ALPHA``.  *Host*: the shares of languages among a host's rows, drawn with ``KAPPA`` counts to those of its
domain, these to those of its suffix, and these to those of all rows.  All are grouped sums over all rows.

The texts are read once for scores; what is summed afterwards is one small row a text.  Sums combine on the map side, so
a host with a third of all rows costs its share only once, and its join is one that adaptive execution splits.

Defined cases: null or empty texts give no text evidence; null declarations, suffixes and hosts give none of their kind
(a null host has the prior of all rows); texts are read whole; repeated rows and ids are judged row by row; without
any labelled row every language is undetermined; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelloom.llm import html as markup
from pixelloom.llm.arrow import bound_batches, kind_of, sliced, utf8
from pixelloom.sources.storage import materialise

SAMPLE, WEIGHT, ALPHA, KAPPA = 1_000, 40, 0.5, 20.0
#: Labels that count as languages.
LANGUAGES = 256
#: Hashed trigrams; the undetermined language and its prior weight in rows.
TRIGRAMS, UNKNOWN, UNKNOWN_PRIOR = 1 << 15, "und", 0.001


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of the text between spaces, ASCII letters lowered and other ASCII signs as spaces."""
    raw = np.frombuffer(b" " + text.translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
    code = (raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA6B) ^ raw[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)
    letters = (raw[1:-1] != 32) if len(raw) > 2 else np.zeros(0, bool)
    return np.bincount(code[letters], minlength=TRIGRAMS)


_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def learn(df: DataFrame, text_col: str, label_col: str, id_col: str, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and (languages, trigrams) log probabilities from at most ``sample`` rows of each label.

    Labels are counted first; then only ids whose hash is below a share of the label's, four times the sample if it has more rows, are ranked."""
    bound_batches(df)
    by = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id"), "id"))
    rows = df.select(F.lower(F.col(label_col).cast("string")).alias("label"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body")).where("label is not null and body is not null")
    sizes = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(LANGUAGES).collect()
    if not sizes:
        return [], np.zeros((0, TRIGRAMS))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.label, min(1.0, 4 * sample / r["count"]))])
    below = (F.xxhash64("id").cast("double") / 2.0**64 + 0.5) <= F.try_element_at(share, F.col("label"))
    picked = rows.where(below).select("label", "id").distinct().withColumn("n", by).where(F.col("n") <= sample).select("label", "id")
    chosen = rows.join(F.broadcast(picked), ["label", "id"])  # at most ``sample`` ids of each of at most LANGUAGES languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in sliced(batches):
            for label, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                total[label] = total.get(label, 0) + trigrams(text)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([x.astype("<i8").tobytes() for x in total.values()], pa.binary())], names=["label", "counts"])

    counts: dict[str, np.ndarray] = {}
    for r in chosen.select("label", "body").mapInArrow(run, "label string, counts binary").toLocalIterator():
        counts[r.label] = counts.get(r.label, 0) + np.frombuffer(r.counts, "<i8")
    languages = sorted(counts)
    table = np.array([counts[x] for x in languages], float).reshape(len(languages), TRIGRAMS) + ALPHA
    return languages, np.log(table / table.sum(1, keepdims=True))


def _text_scores(df: DataFrame, languages: list[str], table: np.ndarray, read: Callable[[str], str] | None) -> DataFrame:
    """Each row with the log likelihoods of its text, undetermined last, and the language that they favour (null without letters)."""
    shared = df.sparkSession.sparkContext.broadcast((languages, table))
    flat = -math.log(TRIGRAMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = shared.value
        row = TaskContext.get().partitionId() << 40
        for b in sliced(batches):
            scores, best = [], []
            for text in utf8(b.column(1)) if read is None else (read(x.as_py() or "").encode("utf-8", "replace") for x in b.column(1)):
                counts = trigrams(text)
                at = np.flatnonzero(counts)
                n = int(counts[at].sum())
                own = np.append(logs[:, at] @ counts[at], flat * n) * (min(1.0, WEIGHT / n) if n else 0.0)
                scores.append(own)
                best.append(names[int(own[:-1].argmax())] if n and names else None)
            columns = [b.column(0), *b.columns[2:], pa.array(range(row, row + b.num_rows), pa.int64()), pa.array(scores, pa.list_(pa.float64())), pa.array(best, pa.string())]
            row += b.num_rows
            yield pa.RecordBatch.from_arrays(columns, names=["id", "declared", "suffix", "domain", "host", "row", "scores", "text_lang"])

    schema = f"id {kind_of(df, 'id')}, declared string, suffix string, domain string, host string, row long, scores array<double>, text_lang string"
    return df.mapInArrow(run, schema)


def _counts_of(rows: DataFrame, keys: list[str], languages: list[str]) -> DataFrame:
    """keys, n: counts of each language among the rows of a key."""
    return rows.where("text_lang is not null").groupBy(*keys).agg(F.array(*[F.sum((F.col("text_lang") == x).cast("double")) for x in languages]).alias("n"))


def _smoothed(n: Column, parent: Column) -> Column:
    """Shares drawn to the parent's by KAPPA counts."""
    total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
    return F.transform(n, lambda x, i: (x + KAPPA * parent[i]) / (total + KAPPA))


def _host_priors(rows: DataFrame, languages: list[str], overall: list[float]) -> DataFrame:
    """(host, prior): hierarchically smoothed shares; suffix, domain and host are one path."""
    base = F.array(*map(F.lit, overall))
    hosts = rows.where("host is not null")
    by_suffix = _counts_of(hosts, ["suffix"], languages).select(F.col("suffix").alias("s"), _smoothed(F.col("n"), base).alias("ps"))
    by_domain = _counts_of(hosts, ["suffix", "domain"], languages).join(by_suffix, F.col("suffix").eqNullSafe(F.col("s"))).select(F.col("suffix").alias("ds"), F.col("domain").alias("d"), _smoothed(F.col("n"), F.col("ps")).alias("pd"))
    by_host = _counts_of(hosts, ["suffix", "domain", "host"], languages)
    by_host = by_host.join(by_domain, F.col("suffix").eqNullSafe(F.col("ds")) & F.col("domain").eqNullSafe(F.col("d")))
    return by_host.select(F.col("suffix").alias("hs"), F.col("domain").alias("hd"), F.col("host").alias("h"), _smoothed(F.col("n"), F.col("pd")).alias("prior"))


def _shares(rows: DataFrame, column: str, languages: list[str]) -> dict[str, list[float]]:
    """value -> log P(value | language), for the languages' own and the most telling values; other values are one, under ""."""
    value = F.when(F.col(column).isin(languages), F.col(column)).otherwise(F.lit(""))
    counts = {r.v: r.n for r in _counts_of(rows.where(F.col(column).isNotNull()).withColumn("v", value), ["v"], languages).collect()}  # a row a language
    values = [*languages, ""]
    table = np.array([counts.get(v, [0.0] * len(languages)) for v in values], float).reshape(len(values), len(languages)) + ALPHA
    logs = np.log(table / table.sum(0, keepdims=True))
    return {v: [*map(float, logs[i]), -math.log(len(values))] for i, v in enumerate(values)}


def identify(df: DataFrame, id_col: str, text_col: str, declared: Column | None = None, suffix: Column | None = None, domain: Column | None = None, host: Column | None = None, model: tuple[list[str], np.ndarray] | None = None, label_col: str | None = None, read: Callable[[str], str] | None = None) -> DataFrame:
    """(id, lang, confidence, text_lang): the most probable language, its posterior, and the one of the text alone.

    The evidence columns are expressions over ``df``; ``model`` comes from ``learn`` or is learned from ``label_col``; ``read`` makes the text
    of what the text column holds, such as ``html.words_of`` of pages, in the worker that scores it."""
    bound_batches(df)
    languages, table = model or learn(df, text_col, label_col, id_col)
    null = F.lit(None).cast("string")
    short = lambda c: F.lower(F.regexp_extract(c.cast("string"), "^[A-Za-z]*", 0)) if c is not None else null
    lowered = lambda c: F.lower(c.cast("string")) if c is not None else null
    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"), short(declared).alias("declared"), lowered(suffix).alias("suffix"), lowered(domain).alias("domain"), lowered(host).alias("host"))
    rows = materialise(_text_scores(picked, languages, table, read), "text-scores")
    if not languages:
        return rows.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("confidence"), "text_lang")
    found = _counts_of(rows, [], languages).first()
    n = np.array([x or 0.0 for x in (found.n if found else [0.0] * len(languages))])
    overall = [float(x) for x in (n + 1) / (n.sum() + len(languages))]
    logs = {c: _shares(rows, c, languages) for c in ("declared", "suffix")}

    def share(column: str, i: int) -> Column:
        own = F.create_map(*[F.lit(x) for v, row in logs[column].items() for x in (v, row[i])])
        return F.when(F.col(column).isNull(), 0.0).otherwise(F.coalesce(F.try_element_at(own, F.col(column)), F.lit(logs[column][""][i])))

    priors = _host_priors(rows, languages, overall)
    joined = rows.join(priors, (F.col("host") == F.col("h")) & F.col("suffix").eqNullSafe(F.col("hs")) & F.col("domain").eqNullSafe(F.col("hd")), "left")
    prior = lambda i: F.coalesce(F.col("prior")[i], F.lit(overall[i]))
    parts = [F.col("scores")[i] + share("declared", i) + share("suffix", i) + F.log((1 - UNKNOWN_PRIOR) * prior(i)) for i in range(len(languages))]
    parts.append(F.col("scores")[len(languages)] + share("declared", len(languages)) + share("suffix", len(languages)) + math.log(UNKNOWN_PRIOR))
    fused = joined.select("id", "text_lang", F.array(*parts).alias("fused"))
    top = F.array_max("fused")
    mass = F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    names = F.array(*map(F.lit, [*languages, UNKNOWN]))
    return fused.select(F.col("id").alias(id_col), F.element_at(names, F.array_position("fused", top).cast("int")).alias("lang"), (1 / mass).alias("confidence"), "text_lang")


def page_evidence(url: Column, html: Column) -> dict[str, Column]:
    """Evidence expressions of a web page: its lang attribute, and the suffix, domain and host of its address."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    labels = F.split(host, "\\.")
    declared = F.nullif(F.regexp_extract(html, r"(?i)<html\b[^<>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit(""))
    return {"declared": declared, "suffix": F.element_at(labels, -1), "domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host), "host": host}


def page_text(html: Column) -> Column:
    """The visible text of pages, null for null."""
    return F.pandas_udf(lambda pages: pages.map(markup.words_of, na_action="ignore"), "string")(html)
