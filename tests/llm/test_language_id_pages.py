import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_page_and_document_is_judged(spark):
    out = entry.queries()["op5_language_id"](spark, SF).collect()
    for table, key, other in (("pages", "page_id", "doc_id"), ("documents", "doc_id", "page_id")):
        whole = spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()
        assert sorted(r[key] for r in out if r[other] is None) == sorted(r[0] for r in whole)
    assert all(r.lang and 0 < r.confidence <= 1 for r in out)


def test_suffix_is_evidence(spark, tmp_path):
    """A page without letters takes the language of its address's suffix."""
    docs = [(i, *x) for i, x in enumerate([("the dog runs and the cat sleeps", "en"), ("der hund rennt und die katze schläft", "de")] * 20)]
    spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(i, f"http://h{i}.{'en' if i % 2 else 'de'}/", f"<p>{docs[1 - i % 2][1]}</p>") for i in range(200)]
    rows += [(1000, "http://new.en/", "<p>1 2 3</p>"), (1001, "http://new.de/", "<p>1 2 3</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.lang for r in entry.queries()["op5_language_id"](spark, str(tmp_path)).collect()}
    assert got[1000] == got[1] == "en" and got[1001] == got[0] == "de"

