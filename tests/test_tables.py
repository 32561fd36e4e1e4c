import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselon.operators import learn as L
from tesselon.operators import masks as K
from tesselon.operators import nearest as N
from tesselon.operators import quantiles as Q
from tesselon.operators import tables as T


def test_quantiles_of_hot_tied_and_empty_groups(spark):
    rnd = random.Random(1)
    values = [("hot", rnd.choice([1.0, 2.0, 2.0, 7.5])) for _ in range(30_000)] + [("wide", rnd.gauss(0, 1e6)) for _ in range(12_000)] + [("one", 3.0), ("none", None), (None, 4.0), (None, 8.0)]
    df = spark.createDataFrame([(*v, "x") for v in values], "g string, v double, _v0 string").repartition(7)
    got = {r.g: r for r in Q.quantiles(df, ["g"], a=("v", 0.0), b=("v", 0.37), c=("v", 0.995), d=("v", 1.0)).collect()}
    for g in ("hot", "wide", "one", None):
        own = [v for k, v in values if k == g]
        assert [got[g][n] for n in "abcd"] == pytest.approx(np.quantile(own, [0, 0.37, 0.995, 1]).tolist())
    assert got["none"].a is None and len(got) == 5
    whole = Q.quantiles(df, [], m=("v", 0.5)).first().m
    assert whole == pytest.approx(np.median([v for _, v in values if v is not None]))
    assert Q.quantiles(df.limit(0), ["g"], a=("v", 0.5)).count() == 0


def test_ranks_by_ranges(spark):
    rows = [("a", float(k % 50), 1 + k % 3) for k in range(50)] + [("b", 1.0, 4)]
    got = {(r.g, r.v): r.before for r in Q.value_ranks(spark.createDataFrame(rows, "g string, v double, t int").repartition(5), ["g"], "v", "t").collect()}
    total = 0
    for g, v, t in rows[:-1]:
        assert got[g, v] == total
        total += t
    assert got["b", 1.0] == 0


def test_profile_chain_and_levels(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), (None, 4.0)], "s string, v double")
    got = {r["column"]: r for r in T.value_profile(df, ["s", "v"]).collect()}
    assert (got["s"].n, got["s"].n_null, got["s"].n_distinct, got["s"].top, got["s"].top_n) == (4, 1, 2, "a", 2)
    assert (got["v"].n_null, got["v"].top) == (1, "1.0") and T.value_profile(df.where("v is null"), ["v"]).first().top is None
    assert sorted(r.level for r in T.to_bytes(spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", 5.0), ("b", 3.0)], "s string, v double"), "v", "s").collect()) == [0, 0, 127, 255]
    long = spark.createDataFrame([(o, f, "p" if o < 3 else "q", float(f == "x" or o)) for o in range(4) for f in ("x", "y")], "obs long, feature string, sample string, value double")
    assert {(r.obs, r.feature) for r in T.cell_chain(long, "sample", 2, 1, 2).collect()} == {(1, "x"), (1, "y"), (2, "x"), (2, "y")}
    nth = spark.createDataFrame([("s", k) for k in range(10)] * 2 + [(None, 1)], "s string, k long")
    assert sorted(r.k for r in T.every_nth(nth, "s", "k", 4).collect()) == [0, 4, 8]


def test_nearest_vectors_and_annotation(spark):
    p = spark.createDataFrame([(1, "s", 0.0, 0.0, None), (2, "s", 3.0, 0.0, "T"), (3, "s", 90.0, 0.0, None), (4, "t", 0.0, 0.0, None)], "id long, scope string, x double, y double, label string")
    v = spark.createDataFrame([(2, [1.0, 2.0])], "id long, vector array<double>")
    got = {r.left_id: (r.right_id, r.vector) for r in N.nearest_vectors(p.where("id <> 2"), p.where("id = 2"), v, 30.0).collect()}
    assert got == {1: (2, [1.0, 2.0]), 3: (None, [0.0, 0.0]), 4: (None, [0.0, 0.0])}
    named = {r.id: (r.label, r.source) for r in N.annotate(p, p, "label", 30.0).collect()}
    assert named == {1: ("T", "nearest"), 2: ("T", "own"), 3: (None, None), 4: (None, None)}


def test_connected_and_mask_areas(spark):
    edges = [(k, k + 1) for k in range(0, 40) if k != 20] + [(100, 99)]
    got = {r.node: r.label for r in L.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(21)}, **{k: 21 for k in range(21, 41)}, 99: 99, 100: 99}
    # a U whose arms meet far below, a dot, and another label beside it, over several bands
    runs = [("s", y, 0, 2, "a") for y in range(300)] + [("s", y, 8, 9, "a") for y in range(300)] + [("s", 300, 0, 9, "a"), ("s", 5, 20, 21, "a"), ("s", 5, 21, 22, "b")]
    areas = K.mask_components(spark.createDataFrame(runs, "scope string, py long, start long, stop long, label string")).orderBy("component").collect()
    assert [(r.label, r.n_pixels, r.x0, r.y0, r.x1, r.y1) for r in areas] == [("a", 909, 0, 0, 9, 301), ("a", 1, 20, 5, 21, 6), ("b", 1, 21, 5, 22, 6)]


def test_mask_polygons_round_trip(spark):
    rng = np.random.default_rng(3)
    frames = {f"m{k}": rng.random((24, 17)) < (0.35, 0.6, 0.85)[k] for k in range(3)}
    frames["ring"] = np.pad(np.ones((3, 3), bool), 1)
    frames["ring"][2, 2] = False
    runs = []
    for scope, frame in frames.items():
        for y, line in enumerate(np.pad(frame, ((0, 0), (1, 1))).astype(int)):
            d = np.diff(line)
            runs += [(scope, y, int(a), int(b), "a") for a, b in zip(np.flatnonzero(d > 0), np.flatnonzero(d < 0))]
    schema = "scope string, py long, start long, stop long, label string"
    mask = spark.createDataFrame(runs, schema)
    found = K.mask_polygons(mask).collect()
    assert len(found) == K.mask_components(mask).count() and len({r.root for r in found}) == len(found)
    back = {s: np.zeros(f.shape, int) for s, f in frames.items()}
    for r in found:
        rings = [np.array(x) for x in r.rings]
        areas = [(x[:-1, 0] * x[1:, 1] - x[1:, 0] * x[:-1, 1]).sum() for x in rings]
        assert areas[0] > 0 and all(a < 0 for a in areas[1:])
        for y, start, stop in K.region_runs(rings):
            back[r.scope][y, start:stop] += 1
    assert all((back[s] == f).all() for s, f in frames.items())
    assert [len(x) for r in found if r.scope == "ring" for x in r.rings] == [5, 5]
    assert K.mask_polygons(spark.createDataFrame([], schema)).count() == 0


def test_moran_z_and_welch(spark):
    n = 30
    values = spark.createDataFrame([(k, "s", "f", float(k % 10)) for k in range(n)] + [(99, "s", "f", None)], "id long, scope string, feature string, value double")
    w = spark.createDataFrame([(k, k + 1, 1.0) for k in range(n - 1)] + [(k + 1, k, 1.0) for k in range(n - 1)] + [(99, 0, 1.0)], "src long, dst long, w double")
    r = N.morans_i(values, w).first()
    x = np.arange(n) % 10 - 4.5
    m = np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
    s0, s1, s2 = m.sum(), ((m + m.T) ** 2).sum() / 2, ((m.sum(0) + m.sum(1)) ** 2).sum()
    i, e = n / s0 * (x @ m @ x) / (x @ x), -1 / (n - 1)
    sd = np.sqrt((n * n * s1 - n * s2 + 3 * s0 * s0) / ((n * n - 1) * s0 * s0) - e * e)
    assert (r.n, r.i, r.z) == (n, pytest.approx(i), pytest.approx((i - e) / sd))
    long = spark.createDataFrame([(k, "p", "ab"[k % 2], "f", float(k % 7 + k % 2)) for k in range(40)], "obs long, p string, g string, feature string, value double")
    a, b = [np.array([k % 7 + k % 2 for k in range(40) if k % 2 == s]) for s in (0, 1)]
    t = (a.mean() - b.mean()) / np.sqrt(a.var(ddof=1) / len(a) + b.var(ddof=1) / len(b))
    assert {x.g: x.t for x in T.welch_t(long, "p", "g", 5).collect()} == {"a": pytest.approx(t), "b": pytest.approx(-t)}


def test_communities_end_where_no_node_gains(spark):
    rnd = random.Random(3)
    edges = [(a, b, 1.0 if a // 8 == b // 8 else 0.3) for a in range(64) for b in range(a) if (a // 8 == b // 8 and rnd.random() < 0.6) or rnd.random() < 0.03]
    labels = {r.node: r.community for r in L.communities(spark.createDataFrame(edges, "src long, dst long, w double"), together=2).collect()}
    for node in labels:
        votes = {}
        for a, b, w in edges:
            if node in (a, b):
                other = labels[b if a == node else a]
                votes[other] = votes.get(other, 0) + w
        assert votes.get(labels[node], 0) >= max(votes.values()) - 1e-8


def test_windowed_counts(spark, tmp_path):
    from tesselon.streaming.ingest import windowed_counts

    for n, rows in enumerate(([("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 00:20:00"), ("b", "2024-01-01 00:30:00")], [("a", "2024-01-01 05:00:00")], [("a", "2024-01-01 00:15:00"), ("a", "2024-01-01 06:30:00")])):
        spark.createDataFrame(rows, "k string, t string").select("k", F.to_timestamp("t").alias("t")).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k string, t timestamp").parquet(str(tmp_path / "in"))
        query = windowed_counts(stream, "t", "k").writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).start()
        query.awaitTermination()
    got = {(r.k, r.since.hour): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", 0): 2, ("b", 0): 1, ("a", 5): 1}  # the late row is dropped, the last window is still open


def test_components_and_silhouette(spark):
    rnd = random.Random(2)
    rows = [(k, [10.0 * (k % 2) + rnd.random(), rnd.random()], k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    assert L.silhouette(df, "v", "label") > 0.95
    scores = {r.id: r.score for r in L.component_scores(df, "id", "v", 2).collect()}
    assert len({scores[k] > 0 for k in range(0, 60, 2)}) == 1 and (scores[0] > 0) != (scores[1] > 0)
    x = np.array([r[1] for r in rows])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    top = vectors[:, values.argmax()]
    loads = [r.loading for r in L.component_loadings(df, "id", "v", 1).orderBy("position").collect()]
    assert loads == pytest.approx(list(top * np.sign(top[np.abs(top).argmax()])))
    assert {(r.i, r.j): r.covariance for r in L.covariance(df, "v", 2).collect()} == {(i, j): pytest.approx(np.cov(x.T, bias=True)[i, j]) for i, j in ((0, 0), (0, 1), (1, 1))}


def test_repair(spark):
    from tesselon.functions.geometry import largest_ring, repaired

    ring = [[0.0, 0.0], [0.0, 0.0], None, [float("nan"), 1.0], [4.0, 0.0], [4.0, 4.0]]
    df = spark.createDataFrame([(ring, [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]], [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0]]]), ([[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]], [])], "r array<array<double>>, m array<array<array<double>>>")
    got = df.select(repaired(F.col("r")).alias("r"), largest_ring(F.col("m")).alias("m")).collect()
    assert got[0].r == [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]] and got[1].r is None
    assert got[0].m == [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]] and got[1].m is None
