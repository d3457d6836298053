import random

import pytest
from pyspark.sql import functions as F

from pixelloom.llm import language_id as L
from pixelloom.llm.html import words_of

WORDS = {"en": "the and with house water from".split(), "de": "der und mit haus wasser über".split(), "fr": "le et avec maison eau être".split()}


def corpus():
    r = random.Random(8)
    rows = []
    for i in range(400):
        lang = r.choice(list(WORDS))
        rows.append((i, " ".join(r.choice(WORDS[lang]) for _ in range(r.choice([1, 3, 30, 400]))), lang if r.random() < 0.95 else r.choice(list(WORDS)), f"s{i % 7}", lang))
    return rows


def test_held_out_accuracy_and_defined_cases(spark):
    rows = corpus()
    extra = [(900, None, "de", "s0", None), (901, "", None, None, None), (902, "zzqx@@ 12 wqzj xxkq " * 20, "en", "s1", None), (903, "le " * 40_000, None, "new", None), (903, "le " * 9, None, "new", None)]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string, truth string").repartition(4)
    model = L.learn(df.where("doc_id % 2 = 0 and truth is not null"), "text", "truth", "doc_id", sample=60)
    got = {r.doc_id: r for r in L.identify(df, "doc_id", "text", declared=F.col("lang"), host=F.col("source"), model=model).collect()}
    held = [r for r in rows if r[0] % 2]
    assert sum(got[r[0]].lang == r[4] for r in held) >= 0.97 * len(held)
    assert all(0 < r.confidence <= 1 + 1e-9 for r in got.values())
    assert got[900].lang == "de" and got[900].text_lang is None
    assert got[902].lang == L.UNKNOWN and got[903].lang == "fr"
    assert L.identify(df, "doc_id", "text", label_col="lang").count() == len(rows) + 5
    assert {r.lang for r in L.identify(df.withColumn("lang", F.lit(None)), "doc_id", "text", label_col="lang").collect()} == {L.UNKNOWN}
    assert L.identify(df.limit(0), "doc_id", "text", label_col="lang").count() == 0


def test_page_evidence_decides_where_text_is_silent(spark):
    pages = [(i, f"http://www.site{i % 3}.{'de' if i % 2 else 'fr'}/x", f'<html lang="{"de-AT" if i % 2 else "fr"}"><script>the and</script><p>{" ".join(WORDS["de" if i % 2 else "fr"])}</p>') for i in range(40)]
    pages += [(90, "https://www.site1.de:80/y", "<html><p>12</p>"), (91, "http://other.org/", '<HTML LANG=fr><p>?'), (92, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", L.page_text(F.col("html")))
    ev = L.page_evidence(F.col("url"), F.col("html"))
    first = df.select("page_id", *[c.alias(n) for n, c in ev.items()]).where("page_id in (1, 91, 92)").orderBy("page_id").collect()
    assert [tuple(r) for r in first] == [(1, "de", "de", "site1.de", "www.site1.de"), (91, "fr", "org", "other.org", "other.org"), (92, None, None, None, None)]
    model = L.learn(df.where("page_id < 40").withColumn("l", ev["declared"]), "text", "l", "page_id")
    got = {r.page_id: r.lang for r in L.identify(df, "page_id", "text", model=model, **ev).collect()}
    assert got == {r.page_id: r.lang for r in L.identify(df, "page_id", "html", model=model, read=words_of, **ev).collect()}
    assert got[90] == "de" and got[91] == "fr"
    assert all(got[i] == ("de" if i % 2 else "fr") for i in range(40))


def test_fusion_equals_hand_sum(spark):
    import math

    import numpy as np

    rows = [(i, "the house" if i % 4 else "der haus", "en" if i % 4 else "de", "h" if i % 3 else "g") for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    names, table = L.learn(df, "text", "lang", "doc_id")
    got = {r.doc_id: r.confidence for r in L.identify(df, "doc_id", "text", declared=F.col("lang"), host=F.col("source"), model=(names, table)).collect()}
    text_lang = {i: names[int((table @ L.trigrams(t.encode())).argmax())] for i, t, _, _ in rows}
    n = np.array([sum(v == x for v in text_lang.values()) for x in names], float)
    overall = (n + 1) / (n.sum() + 2)
    for i, text, lang, host in rows:
        counts = L.trigrams(text.encode())
        k = int(counts.sum())
        score = np.append(table @ counts, -math.log(L.TRIGRAMS) * k) * min(1, L.WEIGHT / k)
        prior = overall
        for keep in (lambda r: True, lambda r: True, lambda r: r[3] == host):
            own = np.array([sum(text_lang[r[0]] == x for r in rows if keep(r)) for x in names], float)
            prior = (own + L.KAPPA * prior) / (own.sum() + L.KAPPA)
        both = np.array([[sum(r[2] == v and text_lang[r[0]] == x for r in rows) for x in names] for v in [*names, ""]], float) + L.ALPHA
        share = np.log(both / both.sum(0))[names.index(lang)]
        fused = score + np.append(share + np.log((1 - L.UNKNOWN_PRIOR) * prior), -math.log(3) + math.log(L.UNKNOWN_PRIOR))
        p = np.exp(fused - fused.max())
        assert got[i] == pytest.approx(1 / p.sum())


def test_fusion_of_all_evidence_equals_brute_force(spark):
    """Text, declaration, suffix, and host priors over suffix, domain and host; the labels are those of another table."""
    import math
    from collections import Counter

    import numpy as np

    r = random.Random(11)
    learned = [(i, " ".join(r.choice(WORDS[x]) for _ in range(20)), x) for i, x in enumerate(list(WORDS) * 30)]
    model = names, table = L.learn(spark.createDataFrame(learned, "doc_id long, text string, lang string"), "text", "lang", "doc_id")
    rows = []
    for i in range(300):
        lang, suffix = r.choice(list(WORDS)), r.choice(["de", "fr", "org"])
        text = r.choice([None, "", "12"] + [" ".join(r.choice(WORDS[lang]) for _ in range(r.choice([1, 2, 9])))] * 5)
        host = r.choice([f"h{i % 4}.site{i % 3}.{suffix}", f"www.site{i % 3}.{suffix}", None])
        rows.append((i, text, r.choice([None, "xx", lang, "de"]), host and suffix, host and f"site{i % 3}.{suffix}", host))
    df = spark.createDataFrame(rows, "page_id long, text string, declared string, suffix string, domain string, host string").repartition(3)
    got = {x.page_id: x for x in L.identify(df, "page_id", "text", F.col("declared"), F.col("suffix"), F.col("domain"), F.col("host"), model=model).collect()}
    n = len(names)
    scores, text_lang = {}, {}
    for i, text, *_ in rows:
        counts = L.trigrams((text or "").encode())
        k = int(counts.sum())
        scores[i] = np.append(table @ counts, -math.log(L.TRIGRAMS) * k) * (min(1, L.WEIGHT / k) if k else 0)
        text_lang[i] = names[int(scores[i][:-1].argmax())] if k else None
    shares = lambda some: np.array([sum(text_lang[x[0]] == y for x in some) for y in names], float)
    overall = (shares(rows) + 1) / (shares(rows).sum() + n)
    logs = {}
    for c in (2, 3):
        seen = Counter((x[c] if x[c] in names else "", text_lang[x[0]]) for x in rows if x[c] is not None and text_lang[x[0]])
        t = np.array([[seen[v, y] for y in names] for v in [*names, ""]], float) + L.ALPHA
        logs[c] = np.log(t / t.sum(0))
    found = 0
    for x in rows:
        i, _, *evidence = x
        prior = overall
        if x[5] is not None and shares([y for y in rows if y[3:] == x[3:]]).sum():
            for c in (4, 5, 6):
                own = shares([y for y in rows if y[5] is not None and y[3:c] == x[3:c]])
                prior = (own + L.KAPPA * prior) / (own.sum() + L.KAPPA)
        fused = scores[i] + np.append(np.log((1 - L.UNKNOWN_PRIOR) * prior), math.log(L.UNKNOWN_PRIOR))
        for c, value in zip((2, 3), evidence):
            if value is not None:
                fused += np.append(logs[c][names.index(value) if value in names else n], -math.log(n + 1))
        p = np.exp(fused - fused.max())
        assert got[i].confidence == pytest.approx(1 / p.sum()) and got[i].text_lang == text_lang[i]
        assert got[i].lang == [*names, L.UNKNOWN][int(fused.argmax())]
        found += text_lang[i] is None and got[i].lang != names[int(overall.argmax())]
    assert found  # evidence beside the text decides rows without any
