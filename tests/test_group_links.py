import itertools

import numpy as np
import pytest

from pixelloom.functions.kernels import COSINE
from pixelloom.operators import grouping


def smallest_reachable(rows, least):
    label = {o: o for o, _, _ in rows}
    for (a, g, x), (b, h, y) in itertools.combinations(rows, 2):
        if g is not None and g == h and x is not None and y is not None and np.dot(x, y) / ((np.linalg.norm(x) + 1e-7) * (np.linalg.norm(y) + 1e-7)) >= least:
            low, high = sorted((label[a], label[b]))
            label = {o: low if c == high else c for o, c in label.items()}
    return label


@pytest.mark.parametrize("least", [-2.0, 0.5, 0.75, 0.9, 0.97, 2.0])
def test_links_of_large_groups_have_the_components_of_all_pairs(spark, least):
    """From one component a group over one large and many small ones to none; groups of 150, 60 and 12 rows, at once up to 40, in blocks of 16."""
    r = np.random.default_rng(11)
    rows = [(3 * i + 1, 7 if i < 150 else 8 if i < 210 else 9 if i < 222 else None, None if i % 50 == 9 else r.normal(size=4).tolist()) for i in range(230)]
    df = spark.createDataFrame(rows, "ord long, gid long, v array<double>")
    links = grouping.group_links(df.where("v is not null"), ["gid"], "v", COSINE, least, at_once=40, block=16)
    got = grouping.components_of(df, links).collect()
    assert {x.ord: x.gid for x in got} == smallest_reachable(rows, least) and len(got) == len(rows)
