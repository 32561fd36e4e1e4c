
import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselon.operators import matrix as M


def long(spark, rows):
    return spark.createDataFrame(rows, "obs long, feature string, value double")


def values(df):
    return {(r.obs, r.feature): r.value for r in df.collect()}


def test_nan_becomes_missing(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan"), None]), (2, None)], "id long, v array<double>")
    assert values(M.long_matrix(df, "id", "v")) == {(1, "f00"): 1.0, (1, "f01"): None, (1, "f02"): None}


def test_feature_qc(spark):
    v = [0.0, 1.0, 2.0, 10.0, None]
    r = M.feature_qc(long(spark, [(i, "a", x) for i, x in enumerate(v)])).first()
    x = np.array(v[:4])
    assert (r["mean"], r["median"], r["min"], r["max"]) == (x.mean(), np.median(x), 0.0, 10.0)
    assert r["std"] == pytest.approx(x.std()) and r["pct_nonzero"] == 60.0 and r["pct_95"] == pytest.approx(np.percentile(x, 95))


def test_zero_range_counts_as_one(spark):
    rows = [(i, "a", 5.0) for i in range(99)] + [(99, "a", 100.0)]
    got = values(M.robust_scale(long(spark, rows)))
    assert got[0, "a"] == 0.0 and got[99, "a"] == 95.0


def test_constant_feature_has_no_zscore(spark):
    got = values(M.zscore(long(spark, [(1, "a", 3.0), (2, "a", 3.0), (1, "b", 1.0), (2, "b", 3.0)])))
    assert got[1, "a"] is None and got[1, "b"] == -1.0


def test_tic_keeps_zero_rows(spark):
    rows = [(1, "a", 0.0), (1, "b", 0.0), (2, "a", 1.0), (2, "b", 1.0), (3, "a", 3.0), (3, "b", 3.0)]
    got = values(M.tic_normalize(long(spark, rows)))
    assert got[1, "a"] == 0.0 and got[2, "a"] == 2.0 and got[3, "b"] == 2.0
    assert values(M.tic_normalize(long(spark, rows), 10.0))[2, "a"] == 5.0


def test_log_of_nonpositive_is_missing(spark):
    got = values(M.log_transform(long(spark, [(1, "a", -1.0), (2, "a", 7.0)]), base=2))
    assert got == {(1, "a"): None, (2, "a"): 3.0}


def test_filters(spark):
    df = long(spark, [(i, "a", float(i)) for i in range(11)] + [(i, "b", 0.0) for i in range(11)])
    assert sorted({r.obs for r in M.filter_by_intensity(df, min_percentile=10, max_percentile=90).collect()}) == list(range(1, 10))
    assert {r.obs for r in M.filter_by_intensity(df, min_total=9).collect()} == {9, 10}
    assert {r.feature for r in M.filter_features(df, 50).collect()} == {"a"}


def test_channel_merge(spark):
    rows = [(0, 0, "a", 1.0), (0, 1, "b", 2.0), (0, 2, "a", 3.0), (0, 2, "b", 4.0), (0, 2, "c", 9.0)]
    df = spark.createDataFrame(rows, "x int, y int, channel string, value double")
    assert sorted(map(tuple, M.merge_channels(df, ["a", "b"]).collect())) == [(0, 0, 1.0, 0.0), (0, 1, 0.0, 2.0), (0, 2, 3.0, 4.0)]
    assert [tuple(r) for r in M.merge_channels(df, ["a", "b"], "inner").collect()] == [(0, 2, 3.0, 4.0)]
    back = M.split_channels(M.merge_channels(df, ["a", "b"]), ["a", "b"], above=2.0)
    assert {(r.y, r.channel, r.value) for r in back.collect()} == {(2, "a", 3.0), (2, "b", 4.0)}


def test_top_features_tie_by_name(spark):
    df = long(spark, [(1, f, 0.0) for f in "cab"] + [(2, f, 1.0) for f in "cab"])
    assert [r.feature for r in M.top_features(M.variability(df), 2).collect()] == ["a", "b"]


def test_composites(spark):
    df = long(spark, [(1, "a", 1.0), (1, "b", 4.0), (2, "a", 3.0), (2, "b", 4.0)])
    assert {r.obs: r.score for r in M.composite(df, "mip").collect()} == {1: 4.0, 2: 4.0}
    snr = {r.obs: r.score for r in M.composite(df, "snr", 1).collect()}
    assert snr == {1: 4.0, 2: 4.0}


def test_location_scale(spark):
    df = long(spark, [(1, "a", 0.0), (2, "a", 2.0), (3, "a", 10.0), (4, "a", 14.0)]).withColumn("batch", (F.col("obs") > 2).cast("int"))
    got = {r.obs: r.value for r in M.location_scale(df, "batch").collect()}
    assert got[1] == pytest.approx(got[3]) and got[2] == pytest.approx(got[4]) and (got[1] + got[2]) / 2 == pytest.approx(6.5)


def test_empty(spark):
    df = long(spark, [])
    for out in (M.feature_qc(df), M.robust_scale(df), M.zscore(df), M.tic_normalize(df), M.filter_by_intensity(df, min_percentile=1), M.tissue_contrast(df), M.composite(df), M.library_size(df), M.variability(df)):
        assert out.count() == 0
