import random

from pixelloom.operators import components, grouping, keyed
from pixelloom.operators.components import connected_components


def test_components_equal_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3), (3, None), (777, 777)] + [(2000, 3000 + i) for i in range(50)] * 2
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_do_not_depend_on_which_nodes_are_hot(spark, monkeypatch):
    """A star of half of all edges, chains and small groups: no hub, some hubs and all nodes by broadcast."""
    edges = [(7, 1000 + i) for i in range(300)] + [(5000, i) for i in range(100, 400)] + [(i, i + 1) for i in range(2000, 2040)] + [(3000 + i, 3000 + i % 5) for i in range(60)]
    found = [sorted(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()))]
    monkeypatch.setattr(components, "ONE_TASK", 0)
    for hot in (2, 1000):
        monkeypatch.setattr(keyed, "HOT", hot)
        found.append(sorted(map(tuple, connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())))
    assert found[0] == found[1] == found[2] and dict(found[0])[1299] == 7 and dict(found[0])[5000] == 100 and dict(found[0])[2040] == 2000


def test_attach_with_null_keys_ties_and_clashing_names(spark, monkeypatch):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 9 + [None] * 5 + [2, 2, 3, 3, 4])], "gid long, size long")
    found = rows.groupBy("gid").count().withColumnRenamed("gid", "_g").withColumnRenamed("count", "size")
    for hot in (1, 2, 3, 9):
        monkeypatch.setattr(keyed, "HOT", hot)
        got = keyed.attach(rows, found.where("_g is null or _g <> 4"), "gid", "_g", "size")
        assert got.columns == ["gid", "size", "size"]
        assert sorted((r[1], r[0], r[2]) for r in got.collect()) == [(i, k, n) for i, (k, n) in enumerate([(1, 9)] * 9 + [(None, 5)] * 5 + [(2, 2)] * 2 + [(3, 2)] * 2)]
    assert keyed.attach(rows.limit(0), found, "gid", "_g", "size").count() == 0


def test_chunks_of_hot_groups(spark):
    members = spark.createDataFrame([(k, o) for k, n in ((1, 101), (2, 5), (3, 1)) for o in range(n)], "gid long, ord long")
    got = sorted(map(tuple, grouping.chunks(members, 25).collect()))
    assert got == sorted((k, o, o // 25) for k, n in ((1, 101), (2, 5), (3, 1)) for o in range(n))
    assert grouping.chunks(members, 25, drop_single=True).where("gid = 1 and ord = 100 or gid = 3").count() == 0
