"""Corpus pipeline: language, near duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what a stage returns is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.

* ``language_id`` drops documents whose language stays undetermined, or whose posterior is under one half.
* ``ngram_join`` keeps the document of the smallest id of each group that is joined by five-word shingles at a Jaccard similarity of 0.8.
* ``decontamination`` cuts benchmark windows out of the texts, and drops documents that mostly consist of them.
* ``byte_bpe`` encodes the texts and decodes the ids again.

Defined cases: documents without text are kept with their declared language and end with no tokens; the language stage judges
rows, whatever their ids, and rows of equal text, language and source alike; the near-duplicate stage goes by ids: of rows of equal id it drops all or
none, and it keeps rows without one; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm import bpe, decontaminate, language_id, ngram_join
from pixelloom.sources.storage import materialise

#: The language stage's key of a row, while it runs.
KEY = "_language_evidence"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    evidence = [F.col(c) for c in ("text", "lang", "source")]
    key = F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(seed), *evidence, *[c.isNull() for c in evidence])) for seed in (1, 2)])  # 128 bits of all that is judged
    keyed = docs.withColumn(KEY, key)
    model = language_id.learn(docs, "text", "lang", "doc_id")
    found = language_id.identify(keyed, KEY, "text", declared=F.col("lang"), host=F.col("source"), model=model)
    gone = found.where((F.col("lang") == language_id.UNKNOWN) | (F.col("confidence") < 0.5)).select(F.col(KEY).alias("_gone")).distinct()
    return keyed.join(gone, F.col(KEY) == F.col("_gone"), "left_anti").select(*[keyed[c] for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, 5, (80, 100))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    how = (P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    both = bpe.round_trip(docs, *how)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("byte_bpe", encode_tokens),
]

#: The first stage's posteriors and the second's components are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
