"""Registered queries over the smallest tables: columns, whole tables, and SQL where there is some."""

import pytest

from pixelloom.llm import queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_url_filter": "page_id host path rule verdict",
    "op4_ngram_join": "doc_id n_shingles component_id",
    "op5_language_id": "doc_id page_id lang confidence",
    "op6_class_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op7_token_files": "doc_id start n_tokens ids_crc32",
    "op8_warc_derivatives": "page_id linked",
    "op9_hilbert_neighbours": "query_id rank vec_id score",
    "op10_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


def test_one_query_an_operator():
    assert sorted(queries.QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_its_table(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(out.columns)
    key = out.columns[0]
    rows = out.collect()
    if name.startswith("op9"):
        assert len(rows) == 20 * len({r.query_id for r in rows}) == 20 * spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 20 = 0").count()
        return
    whole = spark.read.parquet(f"{SF}/{ {'doc_id': 'documents', 'page_id': 'pages', 'conv_id': 'conversations'}[key]}.parquet")
    assert {r[key] for r in rows} - ({None} if name.startswith("op5") else set()) == {r[0] for r in whole.select(key).distinct().collect()} | ({-7} if key == "conv_id" else set())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    _, off = compare(connect(SF), queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name])
    assert off is None
