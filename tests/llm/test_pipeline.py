import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_ngram_join import brute as brute_components

import corpus_pipeline
from pixelloom.llm import bpe


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(4)
    vocabulary = {"en": [f"the{i}" for i in range(300)], "de": [f"ünd{i}" for i in range(300)]}
    item = " ".join(f"item{i}" for i in range(14))
    rows = []
    for i in range(60):
        lang = r.choice(["en", "de"])
        words = [r.choice(vocabulary[lang]) for _ in range(r.choice([20, 120]))]
        rows.append((i, " ".join(words), lang, f"s{i % 3}", 0))
        if i % 5 == 0:
            words[3] = "changed"
            rows.append((100 + i, " ".join(words), lang, "s0", 0))
        if i % 7 == 0:
            rows.append((200 + i, " ".join([*words, item, *words[::-1]]), lang, "s1", 0))
    rows += [(300, item, "en", "s0", 0), (301, None, "en", None, None), (302, "", "de", "s1", 0), (None, "the1 the2", "en", "s1", 9)]
    path = f"file://{tmp_path_factory.mktemp('docs')}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, item


def test_stages_equal_brute_force(spark, folder):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "ngram_join", "decontamination", "byte_bpe"]
    first = stages["language_id"](spark, docs, path)
    assert first.columns == columns and sorted(map(str, first.collect())) == sorted(map(str, docs.collect()))
    second = stages["ngram_join"](spark, first, path)
    keyed = [(i, t) for i, t, *_ in rows if i is not None]
    gone = {i for i, _, c in brute_components(keyed, 5, 80, 100) if i != c}
    assert gone and second.columns == columns and sorted(str(r.doc_id) for r in second.collect()) == sorted(str(r[0]) for r in rows if r[0] not in gone)
    third = stages["decontamination"](spark, second, path)
    assert third.columns == columns
    was = {r[0]: r[1] for r in rows}
    for r in third.collect():
        assert brute_hits(r.text, [(1, item)])[1] == 0 and (r.text is None or r.n_chars == len(r.text))
        if brute_hits(was[r.doc_id], [(1, item)])[1] == 0:
            assert r.text == was[r.doc_id]
    assert {r.doc_id for r in second.collect()} - {r.doc_id for r in third.collect()} == {300}
    public = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in third.collect()}
    out = corpus_pipeline.run(spark, path).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = np.array(public.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_undetermined_language_goes(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    noise = spark.createDataFrame([(900, "жзик гдшщ ъыьэ юячс " * 50, None, None, 12)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(noise), path)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_rejection_goes_by_row(spark, folder):
    """Undetermined rows without an id, or with the id of a kept row, go; the kept row stays, and so do extra columns."""
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", "doc_id as id", "text as body")
    noise = "жзик гдшщ ъыьэ юячс " * 50
    more = spark.createDataFrame([(None, noise, None, None, 12, None, "x"), (0, noise, None, "s1", 12, 0, "x"), (0, noise, None, None, 12, 0, "x")], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(more), path)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
