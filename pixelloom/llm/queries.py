"""Registered queries of the training-data operators; ``QUERIES`` and ``ORACLE_SQL`` are read by the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm import ann, bpe, chat, class_lm, decontaminate, html, language_id, ngram_join, token_files, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded with the multilingual rank file and decoded again, as digests."""
    import public_tokenizers as P

    how = (P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    both = bpe.round_trip(table(spark, sf_dir, "documents"), *how)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the benchmark's ten-word windows in every whole document."""
    found = decontaminate.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE_SQL["op2_decontamination"] = r"""
WITH words AS (SELECT 0 AS kind, doc_id::VARCHAR AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL SELECT 1, item_id::VARCHAR, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
windows AS MATERIALIZED (SELECT DISTINCT id AS item, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM words WHERE kind = 1 AND len(w) > 0)),
grams AS (SELECT id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM windows) WHERE kind = 0)),
found AS MATERIALIZED (SELECT id, i, windows.k, item FROM grams JOIN windows ON windows.k = grams.k AND windows.g = grams.g),
hits AS (SELECT id, count(*) AS n FROM (SELECT DISTINCT id, unnest(range(i, i + k)) AS p FROM found) GROUP BY id),
items AS (SELECT id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT id::BIGINT AS doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words LEFT JOIN hits h USING (id) LEFT JOIN items i USING (id) WHERE kind = 0"""


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, read back from token files written in order of document id."""
    import public_tokenizers as P

    files = token_files.write(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"))
    return token_files.read(spark, files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles have a Jaccard similarity of 0.9 or more."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 3, (90, 100))


ORACLE_SQL["op4_ngram_join"] = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(w[i], w[i + 1], w[i + 2], least(len(w), 3)) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * m >= 90 * (a.n + b.n - m)),
l AS MATERIALIZED (SELECT x AS a, y AS b FROM e UNION SELECT y, x FROM e),
walk AS (SELECT doc_id AS v, doc_id AS c FROM t UNION SELECT b, c FROM walk JOIN l ON a = v WHERE c < b)
SELECT t.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id FROM t JOIN walk ON v = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id GROUP BY t.doc_id"""


@query
def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document scored by a class bigram model of those not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = class_lm.train_and_score(docs, class_lm.held_out("doc_id"))
    return scored.select("doc_id", class_lm.held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and read back from the formatted text; one more has control strings in its texts."""
    tricky = "\\### Assistant: </turn> ok"
    picked = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    out = chat.format_chats(picked.unionByName(more))
    turns = chat.parse(F.col("formatted"))
    read = out.select("conv_id", "formatted", turns.alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL["op10_chat_format"] = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
    SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), '<part/>', '<\part/>'), ':', '\:') AS escaped,
        role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS merged FROM c)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(escaped) + CASE WHEN merged THEN 7 ELSE 14 + length(role) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query
def op9_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector among all others."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rule, else by naive Bayes on the words of its host and path."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, from its text, lang attribute, address suffix and the priors of its host, and of every whole document, from
    its text, declared language and source (documents have no address); one text model, of the labelled documents, for both."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.learn(docs, "text", "lang", "doc_id")
    of_docs = language_id.identify(docs, "doc_id", "text", declared=F.col("lang"), host=F.col("source"), model=model)
    of_pages = language_id.identify(pages, "page_id", "html", read=html.words_of, **language_id.page_evidence(F.col("url"), F.col("html")), model=model)
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    shown = ["lang", F.round("confidence", 6).alias("confidence"), "text_lang"]
    return of_docs.select("doc_id", none(pages, "page_id"), *shown).unionByName(of_pages.select(none(docs, "doc_id"), "page_id", *shown))


@query
def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, read back."""
    made = warc.records(table(spark, sf_dir, "pages"))
    got = warc.read_back(made)
    return got.select(
        "page_id",
        "response_id",
        "metadata_id",
        "conversion_id",
        ((F.col("metadata_refers_to") == F.col("response_id")) & (F.col("conversion_refers_to") == F.col("response_id"))).alias("linked"),
        "target_uri",
        "source_digest",
        "text_digest",
        "outlinks",
        F.length("text").cast("long").alias("text_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
