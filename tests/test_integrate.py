import pytest
from pyspark.sql import functions as F

from tesselon.operators import integrate as I


def test_transcripts_are_conserved(spark):
    rows = [("s", 0, 0, "g", 2), ("s", 0, 0, "g", 3), ("s", 1, 0, "g__x", 4), ("s", 9, 9, "g", 5), ("t", 0, 0, "g", 7), ("s", 0, 0, "h", None)]
    dnb = spark.createDataFrame(rows, "scope string, px long, py long, gene string, count long")
    mask = spark.createDataFrame([("s", 0, 0, 1, "noise"), ("s", 1, 0, 1, "noise")], "scope string, px long, py long, label long, count string")
    inside, outside = I.aggregate_by_mask(dnb, mask)
    assert {(r.scope, r.cell, r.gene, r["count"]) for r in inside.collect()} == {("s", 1, "g", 5), ("s", 1, "g__x", 4), ("s", 1, "h", 0)}
    assert {(r.scope, r.gene, r["count"]) for r in outside.collect()} == {("s", "g", 5), ("t", "g", 7)}
    total = I.cell_totals(inside).first()
    assert (total.n_transcripts, total.n_genes, total.n_taxa) == (9, 2, 4)
    assert I.aggregate_by_mask(dnb.limit(0), mask)[0].count() == 0


def test_matched_correlation(spark):
    one = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", 3.0), (2, "a", 1.0), (2, "b", 1.0), (2, "only", 1.0)], "obs long, feature string, value double")
    two = spark.createDataFrame([(5, "a", 2.0), (5, "b", 4.0), (6, "a", 3.0), (6, "b", 9.0), (6, "c", 1.0)], "obs long, feature string, value double")
    pairs = spark.createDataFrame([(1, 5), (2, 6)], "a long, b long")
    by_pair, by_feature = I.matched_correlation(pairs, one, two)
    got = {r.a: (r.n, round(r.r, 6)) for r in by_pair.collect()}
    assert got[1] == (3, -0.5) and got[2][0] == 3
    assert {r.feature: r.r for r in by_feature.collect()}["a"] == 0.0


def test_warp_has_no_holes(spark):
    pixels = spark.createDataFrame([("s", x, y, float(10 * x + y)) for x in range(4) for y in range(4)], "scope string, px long, py long, value double")
    double = spark.createDataFrame([("s", [[2.0, 0.0, 1.0], [0.0, 2.0, 0.0]]), ("t", None)], "scope string, matrix array<array<double>>")
    got = {(r.px, r.py): r.value for r in I.warp_raster(pixels, double, 9, 8, bilinear=False).collect()}
    assert got[1, 0] == 0.0 and got[3, 2] == 11.0 and got[7, 6] == 33.0 and (0, 0) in got and len(got) >= 49
    smooth = {(r.px, r.py): r.value for r in I.warp_raster(pixels, double, 9, 8).collect()}
    assert smooth[3, 2] == 11.0 and smooth[4, 2] == 16.0 and smooth[4, 3] == 16.5 and smooth[8, 0] == 15.0


def test_agreement_stretch_and_small_ones(spark):
    a = spark.createDataFrame([("s", x, 0, float(x)) for x in range(40)], "scope string, px long, py long, value double")
    r = I.image_agreement(a, a, 9.0, 10).first()
    assert r.overlap_pct == 100.0 and r.ncc == pytest.approx(1.0)
    assert I.image_agreement(a, a, 9.0, 100).first().ncc is None
    s = {r.px: r.stretched for r in I.stretch(a, "value", "scope", 0.0, 1.0).collect()}
    assert s[0] == 0.0 and s[1] == 0.0 and s[39] == 1.0
    row = spark.range(1).select(
        I.border_ring(F.lit(5), F.lit(6), F.expr("array(struct(1 as dx, 2 as dy))")).alias("b"), I.rectangle_ring(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(1.0)).alias("r"), I.rectangle_ring(F.lit(1e11), F.lit(0.0), F.lit(2.0), F.lit(1.0)).alias("e"),
        I.volcano(F.lit(-2.0), F.lit(0.01))[0].alias("v"), I.recommend(F.lit(10), F.lit(20), F.lit(5.0)).alias("w"), I.modality_threshold(F.lit("nothing known")).alias("t"),
    ).first()
    assert row.b == [[6.0, 8.0]] and len(row.r) == 5 and row.e is None and row.v is True and row.w == "USE_MLD" and row.t == 0.1


def test_windows_pairs_and_remaining(spark):
    p = spark.createDataFrame([(i, "s", float(i % 7), float(i // 7)) for i in range(60)], "id long, scope string, x double, y double")
    got = I.dual_dense_windows(p.where("id % 2 = 0"), p.where("id % 2 = 1"), 10.0).collect()
    assert [(r.cx, r.cy, r.weight) for r in got] == [(0, 0, 30)]
    one, two = spark.createDataFrame([("a", "1/a"), ("b", "1/b")], "stem string, path string"), spark.createDataFrame([("b", "2/b"), ("c", "2/c")], "stem string, path string")
    assert sorted((r.stem, r.path_one, r.path_two) for r in I.pair_files(one, two).collect()) == [("a", "1/a", None), ("b", "1/b", "2/b"), ("c", None, "2/c")]
    assert [r.stem for r in I.remaining(one, two, "stem").collect()] == ["a"]
