import random

import numpy as np
import pytest

from tesselon.llm import packing as P

SCHEMA = "doc string, id long, n int, capacity string, piece int"


def run(spark, sizes, **kw):
    df = spark.createDataFrame([("noise", i, n, "x", 7) for i, n in enumerate(sizes)], SCHEMA)
    return P.pack(df, "id", "n", **kw).collect()


@pytest.mark.parametrize("shard_items", [50_000, 120])
def test_pack(spark, shard_items):
    rnd = random.Random(1)
    sizes = [min(5_000, int(rnd.lognormvariate(5, 1))) for _ in range(800)] + [0, 0, None, 4096, 4097, 9_000]
    got = run(spark, sizes, shard_items=shard_items)
    bins, pieces = {}, {}
    for r in got:
        bins.setdefault((r.container_id, r.capacity), 0)
        bins[r.container_id, r.capacity] += r["size"]
        pieces.setdefault(r.id, []).append((r.piece, r["size"]))
    assert len({c for c, _ in bins}) == len(bins)
    assert all(used <= c for (_, c), used in bins.items())
    for i, n in enumerate(sizes):
        n = n or 0
        own = sorted(pieces[i])
        assert sum(s for _, s in own) == n and [p for p, _ in own] == list(range(max(1, -(-n // 4096)))) and all(s == 4096 for _, s in own[:-1])
    assert sum(bins.values()) / sum(c for _, c in bins) > 0.95


def test_downsizing_and_order():
    where, capacity = P.best_fit(np.array([600, 500, 400, 100]), [512, 1024, 2048])
    used = np.bincount(where, weights=[600, 500, 400, 100])
    assert all(u <= c and (c == 512 or u > c // 2) for u, c in zip(used, capacity)) and sum(capacity) <= 2048


def test_empty(spark):
    assert run(spark, []) == []
