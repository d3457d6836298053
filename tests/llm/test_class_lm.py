import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pixelloom.llm import class_lm as L


def named(rows, *texts):
    """The word table with words for hashes."""
    words = {L.word_hash(w): w for t in texts for w in [b"", *(t or "").encode().lower().split()]}
    return {words[r.word]: r for r in rows}


def symbol_of(model):
    known = L._symbols(model.frequent, model.endings)
    return lambda w: int(L.symbols(*L.coded([w])[1:], known, model.endings)[0]) if w else len(model.of) - 1


def corpus():
    r = random.Random(3)
    kinds = [["the", "dog", "runs", "fast"], ["der", "hund", "rennt", "é"]]
    rows = [(i, " ".join(r.choice(kinds[i % 2]) + ("" if r.random() < 0.9 else str(r.randrange(30))) for _ in range(r.choice([1, 5, 40])))) for i in range(200)]
    return rows + [(500, None), (501, ""), (501, ""), (502, "THE unknown " * 3000), (None, "the dog")]


def test_base_scores_counts_and_gain(spark):
    rows = corpus()
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n int").repartition(4)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    toks = lambda t: (t or "").encode().lower().split() + [None]
    c = Counter(w for i, t in rows if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    model = L.train(df.where(~L.held_out("doc_id")), frequent=5, endings=16, classes=4, hot=4)
    got = L.score(df, model).collect()
    want = sorted((str(i), len(toks(t)), sum(w in c for w in toks(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got if held(r.doc_id)) > sum(r.base_score for r in got if held(r.doc_id))


def test_probabilities_sum_to_one(spark):
    """All texts of up to two words, with one stand-in for unknown words of each class, and what is longer."""
    df = spark.createDataFrame([(1, "a b a c"), (2, "b b c a"), (3, "c a")], "doc_id long, text string")
    model = L.train(df, frequent=3, endings=2, classes=2)
    seen, symbol = {w: r.n for w, r in named(model.counts.collect(), "a b c").items()}, symbol_of(model)
    for before in range(3):
        total = 0.0
        for k in range(3):
            words = [n for w, n in seen.items() if model.of[symbol(w)] == k] + [0]
            total += sum(10 ** (model.transition[before, k] + math.log10(n + L.ALPHA) - model.spread[k]) for n in words)
        assert total == pytest.approx(1)


def likelihood(bigrams, of):
    k = of.max() + 1
    pairs = np.zeros((k, k))
    np.add.at(pairs, (of[:, None], of[None, :]), bigrams)
    f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return f(pairs) - f(pairs.sum(1)) - f(pairs.sum(1))


def test_exchange_reaches_a_local_optimum():
    r = np.random.default_rng(4)
    b = r.poisson(1.0, (13, 13)) + 9 * (np.arange(13)[:, None] % 3 == np.arange(13)[None, :] % 3)
    of = L.exchange(b, 3, 50)
    best = likelihood(b, of)
    for w, k in itertools.product(range(12), range(3)):
        other = of.copy()
        other[w] = k
        freq_out, freq_in = b.sum(1), b.sum(0)
        if (freq_out == freq_in).all():
            assert likelihood(b, other) <= best + 1e-6
    assert of[-1] == 3 and best > likelihood(b, np.append(np.arange(12) % 2, 3))


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = L.score(df, L.train(df.limit(0))).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == pytest.approx(0)


def test_most_frequent_is_bounded(spark):
    counts = spark.createDataFrame([(L.END, 1)] + [(i, i) for i in range(1, 400)], "word long, n long")
    for most in (0, 1, 7, 50, 399, 1000):
        got = {r.n for r in L._most_frequent(counts, most).collect() if r.word != L.END}
        assert len(got) <= most and got == set(range(400 - len(got), 400))


def test_best_classes_is_one_step_of_exchange():
    r = np.random.default_rng(5)
    for _ in range(5):
        b = r.poisson(2.0, (12, 12))
        of = np.append(r.integers(0, 3, 11), 3)
        pairs = np.zeros((4, 4))
        np.add.at(pairs, (of[:, None], of[None, :]), b)
        for w in range(11):
            right, left = (np.bincount(of, weights=x, minlength=4) for x in (b[w], b[:, w]))
            right[of[w]] -= b[w, w]
            left[of[w]] -= b[w, w]
            left[3] += right.sum() - left.sum()  # as in texts, a word has as many before as after it
            if left[3] < 0:
                continue
            b2 = b.copy()
            b2[11, w] += left[3] - b[11, w]
            pairs2 = np.zeros((4, 4))
            np.add.at(pairs2, (of[:, None], of[None, :]), b2)
            moved = []
            for k in range(3):
                other = of.copy()
                other[w] = k
                moved.append(likelihood(b2, other))
            best = int(L.best_classes(right[None], left[None], np.array([float(b[w, w])]), of[w : w + 1], pairs2)[0])
            assert moved[best] == pytest.approx(max(moved))


def test_every_training_word_is_clustered_by_its_neighbours(spark):
    """Words beyond the frequent ones, of no common ending, get the class of those that stand in the same places."""
    r = random.Random(6)
    left, right = ([f"{side}{i:03d}" for i in range(60)] for side in ("x", "y"))
    r.shuffle(left)
    often = lambda side: r.choice(side[:8] if r.random() < 0.5 else side)
    texts = [" ".join(w for _ in range(30) for w in ("the", often(left), "of", often(right))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = L.train(df, frequent=18, endings=16, classes=6, hot=25)
    found = {w.decode(): x for w, x in named(model.counts.collect(), *texts).items()}
    table = {w: x["class"] for w, x in found.items()}
    assert len(table) == 123
    by_side = [Counter(table[w] for w in side) for side in (left, right)]  # x012 and y012 have one ending
    assert sum(min(by_side[0][k], by_side[1][k]) for k in range(6)) <= 5
    words = Counter(w for t in texts for w in t.split())
    assert {w: x.n for w, x in found.items()} == {**words, "": 40}


def test_score_equals_brute_force(spark):
    """Class pairs, sizes and probabilities from the texts and the word table alone; one pass for training and scoring gives the same."""
    rows = corpus()
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n int").repartition(4)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    sizes = {"frequent": 5, "endings": 16, "classes": 4, "hot": 4}
    model = L.train(df.where(~L.held_out("doc_id")), **sizes)
    table = {w: (r.n, r["class"]) for w, r in named(model.counts.collect(), *(t for _, t in rows)).items()}
    symbol = symbol_of(model)
    known = lambda w: table.get(w) or (0, int(model.of[symbol(w)]))
    line = lambda t: [b"", *(t or "").encode().lower().split(), b""]
    pairs = Counter((known(a)[1], known(b)[1]) for i, t in rows if not held(i) for a, b in itertools.pairwise(line(t)))
    before = Counter()
    for (a, _), n in pairs.items():
        before[a] += n
    spread = [sum(n for n, c in table.values() if c == k) + L.ALPHA * (sum(c == k and n > 0 for n, c in table.values()) + 1) for k in range(5)]

    def score(t):
        out = 0.0
        for a, b in itertools.pairwise(line(t)):
            (n, k), c = known(b), known(a)[1]
            out += math.log10((pairs[c, k] + L.MU * spread[k] / sum(spread)) / (before[c] + L.MU)) + math.log10((n + L.ALPHA) / spread[k])
        return out

    want = sorted((str(i), round(score(t), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in L.score(df, model).collect()) == want
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in L.train_and_score(df, L.held_out("doc_id"), **sizes).collect()) == want
    assert L.train_and_score(df.limit(0), L.held_out("doc_id")).count() == 0


def test_contexts_and_classes_equal_brute_force(spark, monkeypatch):
    """Every word beyond the frequent ones goes where one step of exchange would take it, whatever the cuts of batches and memos."""
    for limits in ({}, {"MEMO_CONTEXTS": 7, "STEP_WORDS": 2}):
        for name, value in limits.items():
            monkeypatch.setattr(L, name, value)
        rows = corpus() + [(600, "x x x y"), (601, "y y"), (602, "x")]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        words = [b"the", b"der"]
        of = np.array([0, 1, *(i % 3 for i in range(16)), 3])
        symbol = symbol_of(L.ClassModel(None, 0, 0, None, [L.word_hash(w) for w in words], 16, of))
        symbols = {w: symbol(w) for _, t in rows for w in [b"", *(t or "").encode().lower().split()]}
        left, right, pairs = {}, {}, np.zeros((4, 4))
        for _, t in rows:
            line = [b"", *(t or "").encode().lower().split(), b""]
            for a, b in itertools.pairwise(line):
                pairs[of[symbols[a]], of[symbols[b]]] += 1
                if b not in words and b:
                    left.setdefault(b, Counter())[4 if a == b else of[symbols[a]]] += 1
                if a not in words and a:
                    right.setdefault(a, Counter())[4 if a == b else of[symbols[b]]] += 1
        vec = lambda c: np.array([float(c[k]) for k in range(5)])
        want = {w: (sum(left[w].values()), int(L.best_classes(vec(right[w])[None, :4], vec(left[w])[None, :4], vec(left[w])[4:], of[[symbols[w]]], pairs)[0])) for w in left}
        found = L._assigned(L._contexts(df, "text", [L.word_hash(w) for w in words], 16, of), of[2:-1], pairs).collect()
        assert {w: (r.n, r["class"]) for w, r in named(found, *(t for _, t in rows)).items()} == want and len(found) == len(want)


def test_coded_texts():
    texts = [b"", b" ", b"Aa bB\tc\x0bdd\x0cee\r\n", "É é x".encode(), b"abcd", b"\x00 \x1f"]
    sizes, words, tails = L.coded(texts)
    want = [t.lower().split() for t in texts]
    assert sizes.tolist() == [len(w) + 1 for w in want]
    assert words.tolist() == [h for w in want for h in (*map(L.word_hash, w), L.END)]
    assert tails.tolist() == [int.from_bytes(x[-3:][::-1], "little") for w in want for x in (*w, b"")]
    assert [len(x) for x in L.coded([])] == [0, 0, 0]
