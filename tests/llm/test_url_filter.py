import itertools
import math
import random
import re
import time
from collections import Counter

import pytest

from pixelloom.llm import url_filter as U


def plain_rule(host, path):
    fits = [r for r in U.RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0])) and path.startswith(r[0][r[0].index("/") :])]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


URLS = [
    (1, "HTTP://WWW.Example.com/en/1?x"), (2, "http://example.com/en/2"), (3, "http://a.example.com/en"), (4, "http://b.example.com/de/"), (5, "http://x.net/es/1"), (6, "http://x.net"),
    (7, None), (8, "no url"), (9, "://?q"), (10, "http://x.net/fr/a#b://c/"), (11, "http://É.org/Ü/1"), (12, "ftp://notexample.com/en/"), (13, "http://com/"), (13, "http://com/"), (14, ""), (15, "http://" + "ab" * 300 + ".org/" + "x/" * 5000),
    (20, "http://cheappills.org/buy"), (21, "http://www.free-bets.org/de/7"), (22, "http://mygarden.org/de/7"), (23, "http://spamgarden.org/en/"), (24, "http://thecasino.net/de/1"),
    *((i, f"http://www.mygarden.org/de/{i}") for i in range(30, 60)), *((i, f"http://thecasino.net/de/{i}") for i in range(60, 70)),
]


def test_rules_and_verdicts(spark):
    text = "<html><script>casino casino</script><p>my Garden the free cheap pills bets</p> the the my garden</html>"
    df = spark.createDataFrame([(i, u, text if i % 2 else None, "clash") for i, u in URLS], "page_id long, url string, html string, host string").repartition(3)
    got = sorted(tuple(r)[:5] for r in U.judge(df).collect())
    assert [(g[0], g[1], g[2]) for g in got] == sorted((i, *plain_split(u)) for i, u in URLS)
    for i, host, path, rule, verdict in got:
        want, what = plain_rule(host, path)
        assert rule == want
        if want:
            assert verdict == what
        elif i in (20, 21, 24) or i >= 30:
            assert (i, host, verdict) == (i, host, "block" if i in (20, 21, 24) or i >= 60 else "allow")
    assert U.judge(df.limit(0)).count() == 0


def test_viterbi_equals_brute_force():
    r = random.Random(6)
    for _ in range(60):
        name = "".join(r.choice("abc") for _ in range(r.randrange(1, 9)))
        counts = {"".join(r.choice("abc") for _ in range(r.randrange(1, 4))): r.randrange(1, 50) for _ in range(9)}
        p = lambda w: math.log(counts[w] / 200) if w in counts else math.log(10 / 200) - len(w) * math.log(10)
        best = -1e9
        for cuts in itertools.product((0, 1), repeat=len(name) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(name)]
            best = max(best, sum(p(name[a:b]) for a, b in zip(at, at[1:])))
        found = U.viterbi(name, counts, 200)
        assert "".join(found) == name and sum(map(p, found)) == pytest.approx(best)


def test_scores_equal_brute_force(spark):
    urls = [(i, u) for i, u in URLS if i >= 20] * 3 + [(90, "http://pills4garden.org/a/a/a/7/7"), (91, "http://gärten24.org/ä/a_b")]
    df = spark.createDataFrame([(i, u, "the free my cheap garden pills bets") for i, u in urls], "page_id long, url string, html string")
    words = Counter("the free my cheap garden pills bets".split() * len(urls))
    total = sum(words.values())
    known = {**{s: 1 for s in U.SEEDS}, **words}
    rows = []
    for _, u in urls:
        host, path = plain_split(u)
        tokens = lambda x: re.findall(r"[^\W\d_]+|\d+", x)
        h = [w for n in tokens(host) for w in (["#"] if n.isdigit() else U.viterbi(n, known, total))]
        rows.append((h, ["#" if t.isdigit() else t for t in tokens(path.lower())]))
    bad = [bool(set(h) & set(U.SEEDS)) for h, _ in rows]
    side = {(k, b): Counter(t for r, x in zip(rows, bad) if x == b for t in r[k]) for b in (True, False) for k in (0, 1)}
    log = lambda k, b, t: math.log((side[k, b][t] + U.ALPHA) / (sum(side[k, b].values()) + U.ALPHA * len(side[k, True] | side[k, False])))
    odds = lambda k, tokens: sum(log(k, True, t) - log(k, False, t) for t in tokens)
    want = sorted(round(math.log(sum(bad) / (len(bad) - sum(bad))) + odds(0, h) + odds(1, p), 6) for h, p in rows)
    assert sorted(round(r.score, 6) for r in U.judge(df).collect()) == want


def test_words_of_blocked_hosts_find_hosts_whose_seeds_are_withheld(spark):
    """A seed that the model isn't told of: hosts with it are blocked for the words that they share with others, clean ones aren't."""
    r = random.Random(9)
    text = "win free cheap bonus pills casino poker garden house river music the"
    lure, clean = ["win", "free", "cheap", "bonus"], ["garden", "house", "river", "music"]
    urls = [(f"http://{r.choice(lure)}{r.choice(lure)}{r.choice(['pills', 'casino'])}{i % 5}.org/go/{i}", "told") for i in range(80)]
    urls += [(f"http://www.{r.choice(clean)}-{r.choice(clean)}.org/de/{i}", "clean") for i in range(400)]
    urls += [(f"http://{r.choice(lure)}{r.choice(lure)}poker.org/go/{i}", "withheld") for i in range(40)]
    df = spark.createDataFrame([(i, u, text, k) for i, (u, k) in enumerate(urls)], "page_id long, url string, html string, kind string")
    got = {x.page_id: x.verdict for x in U.judge(df, rules=[], seeds=[s for s in U.SEEDS if s != "poker"]).collect()}
    share = {k: sum(got[i] == "block" for i, (_, x) in enumerate(urls) if x == k) / sum(x == k for _, x in urls) for k in ("told", "clean", "withheld")}
    assert share["told"] == 1 and share["clean"] == 0 and share["withheld"] >= 0.7  # they also count as examples to allow


def test_hostile_pages_take_linear_time():
    for page in ("<script>" * 130_000, "<" * 1_000_000, "<!--" * 250_000, "<a " * 330_000, "<title>" * 150_000, "<html " * 160_000, "</script" * 120_000 + "<script>" * 10):
        began = time.time()
        U.text_words(page)
        assert time.time() - began < 5
