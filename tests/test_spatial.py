import math
import random

import pytest
from pyspark.sql import functions as F

from tesselon.functions import geometry as G
from tesselon.operators import learn as L
from tesselon.operators import masks as K
from tesselon.operators import nearest as N
from tesselon.operators.density import dense_windows, density_bins, smooth

P = "id long, scope string, x double, y double"


def pts(spark, rows):
    return spark.createDataFrame(rows, P)


def test_nearest_is_exact_beyond_the_first_radius(spark):
    rnd = random.Random(0)
    left = [(i, rnd.choice("ab"), rnd.uniform(0, 400), rnd.uniform(0, 400)) for i in range(120)] + [(900, "c", 0.0, 0.0), (901, None, 0.0, 0.0)]
    right = [(i, rnd.choice("ab"), rnd.uniform(0, 400), rnd.uniform(0, 400)) for i in range(100, 180)]
    got = {}
    for r in N.nearest(pts(spark, left), pts(spark, right), 3, 20.0).collect():
        got.setdefault(r.left_id, {})[r["rank"]] = r.right_id
    for i, s, x, y in left[:120]:
        own = sorted((math.hypot(x - u, y - v), j) for j, t, u, v in right if t == s)[:3]
        assert got[i] == {k + 1: j for k, (_, j) in enumerate(own)}
    assert 900 not in got and N.nearest(pts(spark, []), pts(spark, right)).count() == 0


def test_nearest_with_crowds_repeats_and_scopes_apart(spark):
    """Half of scope a in one spot, repeated positions, a scope of one point, one without partners, radii of their own."""
    rnd = random.Random(1)
    rows = [(i, "a", rnd.gauss(5000, 2), rnd.gauss(5000, 2)) for i in range(60)] + [(100 + i, "a", rnd.uniform(0, 1e4), rnd.uniform(0, 1e4)) for i in range(60)]
    rows += [(200 + i, "b", float(i % 3), 0.0) for i in range(9)] + [(300, "one", 7.0, 7.0), (301, "same", 1.0, 1.0), (302, "same", 1.0, 1.0)]
    points = pts(spark, rows)
    got = {(r.left_id, r["rank"]): (r.right_id, r.dist) for r in N.nearest(points, points, 4, same=True).collect()}
    want = {}
    for i, s, x, y in rows:
        own = sorted((math.sqrt((x - u) ** 2 + (y - v) ** 2), j) for j, t, u, v in rows if t == s and i != j)[:4]
        want |= {(i, n + 1): (j, pytest.approx(d)) for n, (d, j) in enumerate(own)}
    assert got == want
    radii = {r.scope: r.radius for r in N.first_radii(points, points, 4).collect()}
    assert set(radii) == {"a", "b", "one", "same"} and radii["a"] < 1000 and min(radii.values()) > 0


def test_cap_is_inclusive(spark):
    a, b = pts(spark, [(1, "s", 0.0, 0.0), (2, "s", 500.0, 0.0)]), pts(spark, [(7, "s", 50.0, 0.0)])
    got = {r.left_id: (r.right_id, r.dist, r.mapped) for r in N.map_to_nearest(a, b, 50.0).collect()}
    assert got == {1: (7, 50.0, True), 2: (7, 450.0, False)}
    m = N.alignment_metrics(a, b).first()
    assert m.pct_within_50px == 0.0 and m.quality == "POOR"


def test_match_classes(spark):
    a, b = pts(spark, [(1, "s", 0.0, 0.0), (2, "s", 10.0, 0.0), (3, "s", 900.0, 0.0)]), pts(spark, [(1, "s", 3.0, 0.0), (9, "s", 500.0, 0.0)])
    got = {(r.side, r.id): r["class"] for r in N.match_classes(a, b).collect()}
    assert got == {("left", 1): "1to1", ("left", 2): "merged", ("left", 3): "left_only", ("right", 1): "1to1", ("right", 9): "right_only"}


def test_morans_sign(spark):
    grid = [(4 * i + j, "s", float(i), float(j)) for i in range(4) for j in range(4)]
    w = N.distance_weights(pts(spark, grid), 1.0)
    board = [(i, "s", "check", float((int(x) + int(y)) % 2)) for i, _, x, y in grid]
    half = [(i, "s", "half", float(x < 2)) for i, _, x, y in grid]
    flat = [(i, "s", "flat", 3.0) for i, *_ in grid]
    values = spark.createDataFrame(board + half + flat, "id long, scope string, feature string, value double")
    got = {r.feature: r for r in N.morans_i(values, w).collect()}
    assert got["check"].i == pytest.approx(-1.0) and got["half"].i > 0.5 and got["flat"].i is None and got["half"].expected_i == pytest.approx(-1 / 15)
    p = {r.feature: r.p_sim for r in N.permuted_p(values.where("feature <> 'flat'"), w, 39).collect()}
    assert p["half"] <= 0.05 and p["check"] <= 0.05


RING = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]


def test_rings(spark):
    df = spark.createDataFrame([(RING,), (RING + RING[:1],), (RING[::-1],)], "r array<array<double>>")
    rows = df.select(*[c.alias(n) for c, n in zip(G.vertex_centroid(F.col("r")), "xy")], G.signed_area(G.close_ring(F.col("r"))).alias("a"), G.oriented(G.close_ring(F.col("r")), True).alias("o"), F.size(G.by_angle(G.open_ring(F.col("r")))).alias("n")).collect()
    assert [(r.x, r.y) for r in rows] == [(0.5, 0.5)] * 3 and [r.a for r in rows] == [1.0, 1.0, -1.0] and [r.n for r in rows] == [4] * 3
    assert spark.createDataFrame([(rows[2].o,)], "r array<array<double>>").select(G.signed_area(F.col("r"))).first()[0] == 1.0


def test_affine(spark):
    m = [[2.0, 1.0, 5.0], [0.5, 3.0, -4.0]]
    df = spark.createDataFrame([(m, 7.0, -2.0)], "m array<array<double>>, x double, y double")
    inv = G.invert_affine(F.col("m"))
    fx, fy = G.apply_affine(F.col("m"), F.col("x"), F.col("y"))
    row = df.withColumns({"fx": fx, "fy": fy, "inv": inv}).withColumns(dict(zip(("bx", "by"), G.apply_affine(F.col("inv"), F.col("fx"), F.col("fy"))))).withColumn("id", G.compose_affine(F.col("m"), F.col("inv"))).first()
    assert row.bx == pytest.approx(7.0) and row.by == pytest.approx(-2.0)
    assert [v for r in row.id for v in r] == pytest.approx([1, 0, 0, 0, 1, 0], abs=1e-12)
    singular = spark.createDataFrame([([[1.0, 2.0, 0.0], [2.0, 4.0, 0.0]],)], "m array<array<double>>")
    assert singular.select(inv).first()[0] is None
    with pytest.raises(Exception, match="singular"):
        singular.select(G.invert_affine(F.col("m"), strict=True)).collect()
    warped = df.select(G.warp_rings(F.col("m"), F.array(F.array(F.array(F.lit(7.0), F.lit(-2.0)))))).first()[0]
    assert warped[0][0] == [row.fx, row.fy]


def test_raster_priority_holes_and_overlap(spark):
    square = lambda a, b: [[a, a], [b, a], [b, b], [a, b]]
    rows = [(1, "s", "TME ROI", [square(0.0, 10.0), square(2.0, 4.0)]), (2, "s", "Vessels ROI", [square(8.0, 12.0)]), (3, "s", "Tumor ROI", [[[0.0, 0.0], [1.0, 1.0]]])]
    regions = spark.createDataFrame(rows, "rid long, sid string, roi_class string, rings array<array<array<double>>>")
    mask = K.rasterize(K.usable_regions(regions, "rid", "sid", "rings", "roi_class"), "roi_class", K.roi_priority("roi_class"))
    got = {(r.px, r.py): r.label for r in K.pixels_of(mask).collect()}
    assert len(got) == 100 - 4 + 16 - 4 and got[9, 9] == "Vessels ROI" and got[0, 0] == "TME ROI" and (2, 2) not in got
    over = K.mask_overlap(mask.where("label = 'TME ROI'"), mask).first()
    assert (over.n_one, over.n_two, over.n_both, over.n_any) == (92, 108, 92, 108)
    looked = K.mask_lookup(spark.createDataFrame([("s", 9.5, 9.5), ("s", 3.0, 3.0), ("t", 1.0, 1.0)], "scope string, x double, y double"), mask, 1.0, "Outside ROI")
    assert sorted(r.label for r in looked.collect()) == ["Outside ROI", "Outside ROI", "Vessels ROI"]
    edges = {(r.px, r.py) for r in K.mask_edges(mask).collect()}
    assert (0, 0) in edges and (1, 1) not in edges and (8, 8) in edges and (4, 2) in edges


def test_raster_is_that_of_the_pixel_centres(spark):
    from tesselon.operators.proximity import strictly_inside

    rnd = random.Random(7)
    ring = [[rnd.randrange(0, 60) / 2, rnd.randrange(0, 60) / 2] for _ in range(9)]
    hole = [[8.5, 8.5], [14.0, 9.0], [10.0, 15.5]]
    regions = K.usable_regions(spark.createDataFrame([(1, "s", [ring, hole])], "rid long, sid string, rings array<array<array<double>>>"), "rid", "sid", "rings").withColumn("c", F.lit("x"))
    got = {(r.px, r.py) for r in K.pixels_of(K.rasterize(regions, "c", F.lit(0))).collect()}
    grid = spark.range(32).select(F.col("id").alias("px")).crossJoin(spark.range(32).select(F.col("id").alias("py"))).crossJoin(regions)
    assert got == {(r.px, r.py) for r in grid.where(strictly_inside(F.col("rings"), F.col("px") + 0.5, F.col("py") + 0.5)).collect()}


def test_rules(spark):
    df = spark.createDataFrame([(1, True, True, True, False), (2, True, True, None, False), (3, None, None, None, True), (4, True, None, None, True), (5, None, None, None, None)], "id int, cd45 boolean, cd4 boolean, foxp3 boolean, keratin8 boolean")
    got = df.select("id", K.classify({m: F.col(m.lower()) for m in ("CD45", "CD4", "FOXP3", "KERATIN8")}).alias("c")).collect()
    assert [r.c for r in got] == ["Treg", "CD4+ T cell", "Epithelial", "Immune (other)", "Unclassified"]


def test_density(spark):
    rows = [("s", 10.0 * i, 0.0, 1.0) for i in range(100)] + [("s", 500.0, 0.0, 50.0)]
    bins = density_bins(spark.createDataFrame(rows, "scope string, x double, y double, weight double"), 100.0)
    assert bins.count() == 10
    got = [(r["rank"], r.x) for r in dense_windows(bins, 100.0, 250.0, 3).orderBy("rank").collect()]
    assert got == [(1, 550.0), (2, 50.0), (3, 850.0)] or got[0] == (1, 550.0) and len(got) == 3
    assert smooth(bins).agg(F.sum("weight")).first()[0] == pytest.approx(150.0)


def test_simplify(spark):
    wavy = [[float(i), 0.1 * (i % 2)] for i in range(20)] + [[19.0, 20.0], [0.0, 20.0]]
    df = spark.createDataFrame([(wavy,), (RING,), (None,)], "r array<array<double>>")
    got = [r[0] for r in df.select(L.simplify_ring(F.col("r"), 1.0)).collect()]
    assert len(got[0]) == 5 and got[0][0] == got[0][-1] and len(got[1]) == 5 and got[2] is None


def test_communities(spark):
    def clique(a):
        return [(a + i, a + j, 1.0) for i in range(6) for j in range(i)]

    edges = spark.createDataFrame(clique(0) + clique(10) + [(5, 10, 0.2)], "src long, dst long, w double")
    labels = L.communities(edges)
    assert labels.groupBy("community").count().count() == 2
    assert L.modularity(edges, labels).first()[0] > 0.4


def test_pca(spark):
    rnd = random.Random(0)
    rows = [(i, [t, 2 * t + rnd.gauss(0, 0.01), None if i == 5 else 0.0]) for i, t in ((i, rnd.gauss(3, 1)) for i in range(100))]
    scores, ratio = L.principal_components(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 2)
    assert ratio.orderBy("component").first().ratio > 0.99 and scores.count() == 100
