"""URL filtering by rules, host word segmentation and naive Bayes (operator 3).

*Rules.*  A rule is a host and a path prefix, written together ("net/es/"); it fits the host and its subdomains when
the url's path starts with its path, and the longest rule decides.

*Segmentation.*  Names such as "cheappills" are split into words by the Viterbi path of a unigram model.  The model counts the
words of all pages' visible text; only the parts of host names that are such words matter, so they are found by a join
of the distinct names' substrings with the count table, and no dictionary is broadcast.

*Naive Bayes.*  There are no labels for pages, so the examples are weak ones: pages whose segmented host has a word of a
list of seeds are those to block, all other pages those to allow.  Every occurrence of a token counts, in two multinomials smoothed by ``ALPHA`` counts a token, one over the
words of hosts and one over those of paths (numbers are one token), so that a path of thousands of tokens says nothing about hosts.
Counts are grouped sums over all pages.  A page is blocked when block is likelier; what the model adds to the seeds are the other words of such
hosts and their paths, and ``tests/llm/test_url_filter.py`` measures this on hosts whose seeds are withheld.

Scores are worked out for distinct hosts and distinct urls and joined back, and counts are combined by host
before they meet, so a host with a third of all pages costs one row there.

Defined cases: a null url, or one without "://", has an empty host and path; it fits no rule and has no words, so the prior
decides; names and paths of any length are handled whole (words up to ``MAX_WORD`` letters); repeated rows and ids
each keep their row; an empty table gives no rows; null html adds no words; without any example to block, all is allowed;
only the id, url and html columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelloom.llm import html as markup
from pixelloom.llm.arrow import bound_batches
from pixelloom.sources.storage import materialise

#: Longest word that a name is split into, and the least share of all words that a seed word is taken to have.
MAX_WORD, SEED_SHARE = 20, 1e-5
#: Counts that every token gets in either class.
ALPHA = 0.1
#: Words that mark a host as an example to block.
SEEDS = "ad ads adult bet bets betting casino clickbait escort gambling jackpot loan loans lottery malware payday phishing pills poker porn replica sex slots spam viagra warez xxx".split()
#: The rules of the registered query: (rule, verdict).
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]

#: A token of a host or path: letters of any script, or digits.
_TOKEN = r"(\p{L}+|\p{N}+)"
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) columns."""
    found = lambda part: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", part), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(found(1), upper, upper.lower()), found(2)


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def text_words(html: str) -> list[bytes]:
    """Words of a page's visible text, ASCII letters lowered."""
    return markup.words_of(html).encode("utf-8", "replace").translate(_LETTERS).split()


def _word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the text of all pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            found.clear()
            return out

        for b in batches:
            for html in b.column(0):
                found.update(w for w in text_words(html.as_py() or "") if len(w) <= MAX_WORD)
                if len(found) > 400_000:
                    yield batch()
        yield batch()

    return pages.select("html").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, counts: dict[str, int], total: float) -> list[str]:
    """The likeliest split of a name; a part that isn't a word has the probability 10 / (total * 10^length)."""
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            part = name[start:end]
            p = math.log(counts[part] / total) if part in counts else math.log(10 / total) - len(part) * math.log(10)
            options.append((best[start] + p, start))
        score, start = max(options)
        best.append(score)
        back.append(start)
    out, at = [], len(name)
    while at:
        out.append(name[back[at] : at])
        at = back[at]
    return out[::-1]


def _segments(names: DataFrame, words: DataFrame, total: int, seeds: list[str]) -> DataFrame:
    """(name, parts): each distinct name of letters split into words."""
    least = max(1, int(total * SEED_SHARE))
    own = names.sparkSession.createDataFrame([(s, least) for s in seeds], "word string, n long")
    known = words.unionByName(own).groupBy("word").agg(F.max("n").alias("n"))
    start = F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at")
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - F.col("at") + 1))).alias("size")
    parts = names.select("name", start).select("name", "at", size).select("name", F.expr("substring(name, at, size)").alias("word")).distinct()
    found = parts.join(known, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [viterbi(name, {f["word"]: f["n"] for f in own or ()}, max(total, 10)) for name, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(split, pa.list_(pa.string()))], names=["name", "parts"])

    return names.join(found, "name", "left").select("name", "found").mapInArrow(run, "name string, parts array<string>")


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", seeds: list[str] = SEEDS) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every page; score is the model's log odds of block, verdict the rule's or else the model's."""
    bound_batches(pages)
    host, path = split_url(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    words = materialise(_word_counts(pages.select(F.col(html_col).cast("string").alias("html"))), "page-words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = lambda c: F.transform(F.regexp_extract_all(F.lower(c), F.lit(_TOKEN), 1), lambda t: F.when(t.rlike(r"^\p{N}"), F.lit("#")).otherwise(t))
    tokens = found("path")
    distinct = materialise(urls.groupBy("host", "path").agg(F.count("*").alias("pages")).withColumn("tokens", tokens), "urls")
    hosts = distinct.groupBy("host").agg(F.sum("pages").alias("pages"))
    named = hosts.select("host", F.explode(found("host")).alias("name"))
    parts = named.join(_segments(named.where("name <> '#'").select("name").distinct(), words, total, seeds), "name", "left")
    split = parts.groupBy("host").agg(F.flatten(F.collect_list(F.coalesce("parts", F.array("name")))).alias("host_tokens"))  # a host is one name of bounded length
    known = hosts.join(split, "host", "left").select("host", "pages", F.coalesce("host_tokens", F.array().cast("array<string>")).alias("host_tokens"))
    known = materialise(known.withColumn("bad", F.arrays_overlap("host_tokens", F.array(*map(F.lit, seeds)) if seeds else F.array().cast("array<string>"))), "hosts")
    by_path = distinct.select("host", "pages", F.explode("tokens").alias("token")).groupBy("host", "token").agg(F.sum("pages").alias("n"))
    by_path = by_path.join(known.select("host", "bad"), "host").select(F.lit("path").alias("side"), "bad", "token", "n")
    by_host = known.select(F.lit("host").alias("side"), "bad", F.explode("host_tokens").alias("token"), F.col("pages").alias("n"))
    side = lambda bad: F.coalesce(F.sum(F.when(F.col("bad") == bad, F.col("n"))), F.lit(0))
    counts = materialise(by_path.unionByName(by_host).groupBy("side", "token").agg(side(True).alias("block"), side(False).alias("allow")), "tokens")
    totals = counts.groupBy("side").agg(F.count("*").alias("v"), F.sum("block").alias("blocked"), F.sum("allow").alias("allowed"))  # two rows
    bad, good = known.select(F.coalesce(F.sum(F.when(F.col("bad"), F.col("pages"))), F.lit(0)), F.coalesce(F.sum(F.when(~F.col("bad"), F.col("pages"))), F.lit(0))).first()
    if bad and good:
        prior = math.log(bad / good)
        p = lambda n, total: F.log((F.col(n) + ALPHA) / (F.col(total) + ALPHA * F.col("v")))
        odds = counts.join(F.broadcast(totals), "side").select("side", "token", (p("block", "blocked") - p("allow", "allowed")).alias("odds"))
    else:  # nothing to learn from: the one class there is
        prior = 1e9 if bad else -1e9
        odds = counts.select("side", "token", F.lit(0.0).alias("odds"))
    of = lambda name: odds.where(F.col("side") == name).drop("side")
    of_host = known.select("host", F.explode("host_tokens").alias("token")).join(of("host"), "token").groupBy("host").agg(F.sum("odds").alias("host_odds"))
    of_path = distinct.select("path", "tokens").distinct().select("path", F.explode("tokens").alias("token")).join(of("path"), "token").groupBy("path").agg(F.sum("odds").alias("path_odds"))
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    out = urls.join(of_host.withColumnRenamed("host", "h"), F.col("host") == F.col("h"), "left").join(of_path.withColumnRenamed("path", "p"), F.col("path") == F.col("p"), "left")
    score = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    return out.select(F.col(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(score > 0, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
