import math

import numpy as np
import pytest

from tesselon.operators import stats as S


def test_incomplete_beta_known_values():
    assert S.incomplete_beta(0.5, 0.5, 0.5) == pytest.approx(0.5)
    assert S.incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248)
    # two-sided p of t = 2.228 with 10 degrees of freedom is 5 %
    assert S.incomplete_beta(5, 0.5, 10 / (10 + 2.228139**2)) == pytest.approx(0.05, abs=1e-6)


def test_t_test(spark):
    one, two = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    rows = [("g1", "f", v) for v in one] + [("g2", "f", v) for v in two] + [("g1", "few", 1.0), ("g2", "few", 1.0), ("g1", "flat", 1.0), ("g1", "flat", 1.0), ("g2", "flat", 1.0), ("g2", "flat", 1.0), ("g3", "f", 9.0)]
    got = {r.feature: r for r in S.t_test(spark.createDataFrame(rows, "g string, feature string, mean double"), "g", "g1", "g2").collect()}
    a, b = np.array(one), np.array(two)
    sp = ((a.var(ddof=1) * 3 + b.var(ddof=1) * 2) / 5) ** 0.5
    t = (a.mean() - b.mean()) / (sp * (1 / 4 + 1 / 3) ** 0.5)
    assert got["f"].t == pytest.approx(t) and got["f"].log2_fc == pytest.approx(math.log2(3.5 / 5)) and 0 < got["f"].p < 1
    assert got["few"].t is None and got["few"].p == 1.0 and got["flat"].p == 1.0


def test_adjust_is_monotone(spark):
    p = {"a": 0.01, "b": 0.02, "c": 0.02, "d": 0.9, "e": None}
    got = {r.feature: r.p_adjusted for r in S.adjust(spark.createDataFrame(list(p.items()), "feature string, p double"), "p").collect()}
    assert got["a"] == pytest.approx(0.1 / 3) and got["b"] == got["c"] == pytest.approx(0.1 / 3) and got["d"] == 1.0 and got["e"] == 1.0


def test_rank_sum_against_counts(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "s", "ab"[i % 2], "f", float(rng.integers(0, 6) + i % 2)) for i in range(120)]
    rows += [(1000 + i, "s", "tiny", "f", 1.0) for i in range(49)] + [(2000 + i, "lonely", "a", "f", 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "obs long, s string, g string, feature string, value double")
    got = {r.g: r for r in S.rank_sum(df, "s", "g").collect()}
    assert set(got) == {"a", "b"} and got["a"].z == pytest.approx(-got["b"].z)
    v, g = np.array([r[4] for r in rows[:120]]), np.array([r[2] for r in rows[:120]])
    ranks = np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])
    t = np.unique(v, return_counts=True)[1].astype(float)
    var = 60 * 60 / 12 * (121 - (t**3 - t).sum() / (120 * 119))
    assert got["a"].z == pytest.approx((ranks[g == "a"].sum() - 60 * 121 / 2) / var**0.5)


def test_pearson_of_constant_is_zero(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "x double, y double")
    assert df.agg(S.pearson(F.col("x"), F.col("y"))).first()[0] == 0.0


def test_peaks(spark):
    rows = [("g1", f"f{i}", float(i)) for i in range(8)] + [("g2", f"f{i}", float(-i)) for i in range(7)] + [("g2", "f7", 9.0)]
    peaks = S.variable_peaks(spark.createDataFrame(rows, "g string, feature string, mean double"), "g")
    assert {r.feature for r in S.shared_peaks(peaks, "g").collect()} == {"f7"}
    assert {(r.g, r.feature) for r in S.specific_peaks(peaks, "g").collect()} == {("g1", "f6"), ("g2", "f0")}


def test_composition(spark):
    df = spark.createDataFrame([("s", "d", "x"), ("s", "d", "x"), ("s", "d", "y"), ("s", "d", None), (None, "d", "x")], "s string, d string, p string")
    counts = S.composition(df, "s", "d", "p")
    assert {(r.p, r.n, round(r.proportion, 3)) for r in counts.collect()} == {("x", 2, 0.667), ("y", 1, 0.333)}
    more = S.composition(df.unionByName(spark.createDataFrame([("t", "d", "z")], df.schema)), "s", "d", "p")
    assert {r.s: (round(r.x, 3), r.z) for r in S.composition_wide(more, "s", "d", "p").collect()} == {"s": (0.667, 0.0), "t": (0.0, 1.0)}
