import random

import numpy as np
import pytest

from tesselon.llm.components import group_pairs, union


def brute(rows):
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for s, u, v in rows:
        if None not in (s, u, v):
            a, b = find((s, u)), find((s, v))
            parent[max(a, b)] = min(a, b)
    return {(s, x, find((s, x))[1]) for s, x in parent}


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "noise", 0) for r in rows], "scope string, u long, v long, label string, vertex int")
    return {(r.scope, r.vertex, r.label) for r in group_pairs(df, "scope", "u", "v", **kw).collect()}


@pytest.mark.parametrize("block_edges", [500_000, 40])
def test_random_graph(spark, block_edges):
    rnd = random.Random(2)
    rows = [(rnd.choice("abc"), rnd.randrange(-300, 300), rnd.randrange(-300, 300)) for _ in range(500)]
    rows += [("a", None, 1), (None, 1, 2), ("a", 5, None), ("c", 999, 999)] + rows[:50]
    assert got(spark, rows, block_edges=block_edges) == brute(rows)


def test_path_and_hub(spark):
    order = list(range(400))
    random.Random(4).shuffle(order)
    rows = [("p", a, b) for a, b in zip(order, order[1:])] + [("h", 7, k) for k in range(1000, 1600)]
    assert got(spark, rows, block_edges=60) == brute(rows)


def test_empty(spark):
    assert got(spark, []) == set()
    assert got(spark, [("a", None, None)]) == set()


def test_union_matches_labels():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    label = union(a, b, 200)
    assert (label[a] == label[b]).all() and (label <= np.arange(200)).all() and (label[label] == label).all()
