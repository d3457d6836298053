import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pixelloom.llm import ngram_join as J


def plain_sets(texts, n):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(n, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def brute(rows, n, num, den):
    sets = plain_sets([t for _, t in rows], n)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[y] = x
    return sorted((i, len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True))


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    text = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passage = text(20)
    rows, i = [], 0
    for _ in range(25):
        base = text(r.choice([1, 2, 3, 12, 60, 150])) + (passage if r.random() < 0.5 else [])
        for _ in range(r.choice([1, 1, 2, 9])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((i, r.choice([" ", "\n"]).join(own).replace("w1", r.choice(["w1", "W1"]))))
            i += 1
    r.shuffle(rows)
    return rows + [(9001, None), (9002, ""), (9003, " \t"), (9004, "One two"), (9005, "one  TWO"), (9006, rows[0][1]), (9007, "é É"), (9008, "word " * 9000)]


@pytest.mark.parametrize("seed,n,num,den,small", [(1, 3, 90, 100, False), (2, 5, 80, 100, False), (3, 3, 90, 100, True)])
def test_components_equal_brute_force(spark, monkeypatch, seed, n, num, den, small):
    rows = corpus(seed)
    if small:  # families are split into blocks
        monkeypatch.setattr(J, "GROUP_SETS", 4)
        monkeypatch.setattr(J, "GROUP_SHINGLES", 200)
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, component_id int").repartition(5)
    got = sorted(tuple(x) for x in J.jaccard_components(df, n, (num, den)).collect())
    assert got == brute(rows, n, num, den)


def test_repeated_and_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "e f g h"), (2, "e f g h"), (None, "a b c d"), (3, None), (3, None)], "doc_id long, text string")
    got = [tuple(x) for x in J.jaccard_components(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None), (3, 0, 3), (3, 0, 3)], key=str)
    assert J.jaccard_components(df.limit(0)).count() == 0
    kept = J.keep_one(df.withColumn("extra", df.text))
    assert sorted((tuple(x) for x in kept.where("doc_id is not null").collect()), key=str) == [(1, "a b c d", "a b c d"), (1, "e f g h", "e f g h"), (3, None, None), (3, None, None)]
    assert kept.columns == ["doc_id", "text", "extra"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 200), min_size=1, max_size=150), min_size=2, max_size=14), st.sampled_from([(9, 10), (8, 10), (1, 2)]), st.randoms())
def test_trie_links_span_brute_links(sets, threshold, r):
    num, den = threshold
    for s in list(sets):  # near copies
        sets.append({x for x in s if r.random() > 0.05} or {1})
    found = J.trie_links([np.array(sorted(s), np.uint64) for s in sets], num, den)
    true = {(a, b) for b in range(len(sets)) for a in range(b) if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])}
    assert {tuple(sorted(x)) for x in found} <= true
    label = list(range(len(sets)))
    for a, b in found:
        label = [label[a] if x == label[b] else x for x in label]
    assert all(label[a] == label[b] for a, b in true)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.sampled_from([(90, 100), (80, 100), (1, 2)]), st.randoms())
def test_near_sets_share_a_signature(base, threshold, r):
    num, den = threshold
    other = {v for v in base if r.random() > (den - num) / den / 2} | {r.getrandbits(64) for _ in range(r.randrange(1 + len(base) // 8))}
    if den * len(base & other) >= num * len(base | other):
        slices = J.Slices(num, den)
        signs = [set(zip(*(a.tolist() for a in slices.signatures(np.array(sorted(s), np.uint64))))) for s in (base, other)]
        level = slices.levels(max(len(base), len(other)))
        least = [k for k in slices.levels(min(len(base), len(other))) if k in level][0]
        shared = {s for s, mark in signs[0] & signs[1] if mark == slices.mark(least)}
        assert len(shared) >= slices.need[least] >= 1


def test_sets_of_a_large_family_that_cannot_link_are_not_dealt_out(spark, monkeypatch):
    """Texts chained by a passage that all have, and a few near copies: what goes to pairs of blocks is no multiple of the texts."""
    monkeypatch.setattr(J, "GROUP_SETS", 8)
    r = random.Random(9)
    text = lambda k: [f"w{r.randrange(10**6)}" for _ in range(k)]
    passage, base = text(60), text(90)
    rows = [(i, " ".join(passage + text(30))) for i in range(160)] + [(200 + i, " ".join(base[:-1] + text(1) + passage)) for i in range(6)]
    dealt, groups = [], J._members_linked
    monkeypatch.setattr(J, "_members_linked", lambda g, *how: dealt.append(g.count()) or groups(g, *how))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.jaccard_components(df, 5, (80, 100)).collect())) == brute(rows, 5, 80, 100)
    assert sum(dealt) <= 2 * len(rows)


@pytest.mark.parametrize("turns", [1, 2, 3, 7])
def test_turns_deal_out_each_pair_of_blocks_once(spark, turns):
    members = spark.range(60).selectExpr("id % 2 as family", "id as k1", "id as k2", "id as rep", "cast('' as binary) as set", "cast(if(id % 2 = 0, 1, 7) as int) as blocks")
    dealt = [(r.family, r.block_a, r.block_b, r.rep) for t in range(turns) for r in J._dealt(members, t, turns).collect()]
    assert len(dealt) == len(set(dealt)) == 30 + 30 * 6
    assert len({d[:3] for d in dealt}) == 1 + 21
