import random
import re

from pixelloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window=10):
    ws = WORD.findall(lowered(text))
    hit, found = set(), set()
    for name, item in items:
        iw = WORD.findall(lowered(item))
        k = min(window, len(iw))
        grams = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(ws) - k + 1 if k else 0):
            if tuple(ws[i : i + k]) in grams:
                found.add(str(name))
                hit |= set(range(i, i + k))
    return len(ws), len(hit), sorted(found)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["a", "B", "ç", "d4", "É"]
    text = lambda k: "".join(r.choice(vocabulary) + r.choice([" ", "-", ", ", "\n", "\x7f"]) for _ in range(k))
    items = [(i, text(r.choice([0, 3, 9, 10, 11, 25]))) for i in range(12)] + [(3, text(14)), (90, None), (91, "a b ç a b ç a b ç a b ç"), (92, "A b ç a b ç a b ç a b ç")]
    docs = []
    for i in range(n):
        body = text(r.choice([0, 5, 40, 200]))
        if r.random() < 0.6:
            body += r.choice(items)[1] or ""
        docs.append((i, body + text(3), "clash"))
    return docs + [(n, None, None), (n, None, None), (n + 1, "", "x"), (n + 2, "a b ç " * 4000, "x")], items


def test_match_equals_brute_force_in_one_or_many_blocks(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        d = spark.createDataFrame(docs, "doc_id long, text string, items string").repartition(3)
        t = spark.createDataFrame(items, "item_id long, text string")
        want = sorted((i, *brute(text, items)) for i, text, _ in docs)
        for block in (D.BLOCK_WORDS, 40):
            got = [(r.doc_id, r.n_words, sum(e - s for s, e in r.spans), r.items) for r in D.match(d, t, block_words=block).collect()]
            assert sorted(got) == want


def test_decontaminate_leaves_no_window_and_keeps_the_rest(spark):
    docs, items = corpus(3)
    d = spark.createDataFrame(docs, "doc_id long, text string, items string")
    t = spark.createDataFrame(items, "item_id long, text string")
    out = D.decontaminate(d, t, max_coverage=1.0)
    assert out.schema == d.schema
    was = {i: text for i, text, _ in docs}
    for r in out.collect():
        assert brute(r.text, items)[1] == 0
        if brute(was[r.doc_id], items)[1] == 0:
            assert r.text == was[r.doc_id]
    low = {r.doc_id for r in D.decontaminate(d, t, max_coverage=0.5).collect()}
    assert low == {i for i, text in was.items() if (b := brute(text, items))[1] <= 0.5 * b[0]}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    t = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [tuple(r) for r in D.match(d, t.limit(0)).collect()] == [(1, 2, 0, [], [])]
    assert D.match(d.limit(0), t).count() == 0


def test_decontaminate_is_the_same_in_one_or_many_blocks(spark):
    """Coverage adds up over blocks, and a cut of one block can join a window of another."""
    items = [(k, " ".join(f"{'abcdef'[k]}{i}" for i in range(10))) for k in range(6)]
    body = [x.split() for _, x in items]
    docs = [(1, " ".join([*body[0], *body[1], *body[2], *(f"z{i}" for i in range(15))]), "x")]  # each a quarter or less, together two thirds
    for i, (a, b) in enumerate([(a, b) for a in range(6) for b in range(6) if a != b]):
        docs.append((10 + i, " ".join([*(f"z{j}" for j in range(40)), *body[a][:5], *body[b], *body[a][5:]]), "x"))
    more, others = corpus(4)
    for d, t in ((docs, items), (more, others)):
        df, it = spark.createDataFrame(d, "doc_id long, text string, items string"), spark.createDataFrame(t, "item_id long, text string")
        for most in (0.5, 1.0):
            one, many = ([tuple(r) for r in D.decontaminate(df, it, max_coverage=most, block_words=k).collect()] for k in (D.BLOCK_WORDS, 20))
            assert sorted(one, key=str) == sorted(many, key=str)
        assert all(brute(r[1], t)[1] == 0 for r in many)
    assert D.decontaminate(df, it, block_words=20).schema == df.schema
