"""Observation by feature matrices: quality metrics, normalisation, filters, feature selection, composites.

The canonical form is long, ``obs, feature, value``; a missing value is a row with null (NaN is turned into null on
entry) or no row. Percentiles interpolate linearly. Statistics are population ones unless said otherwise. Empty tables
give empty results throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.operators.quantiles import quantiles
from tesselon.session import clean, materialize, small

TINY = 1e-10


def long_matrix(df: DataFrame, obs: str, vector: str, keep: Sequence[str] = (), prefix: str = "f") -> DataFrame:
    """``obs, feature, value`` and ``keep`` of an array column; features are named by position. Null arrays have no rows."""
    return df.select(F.col(f"`{obs}`").alias("obs"), *keep, F.posexplode(f"`{vector}`").alias("pos", "v")).select("obs", *keep, F.format_string(f"{prefix}%02d", "pos").alias("feature"), clean(F.col("v")).alias("value"))


def percentile(column: Column | str, q: float) -> Column:
    """Spark's exact aggregate, for groups of a few thousand values at most (samples, features); else ``quantiles``."""
    return F.percentile(column, F.lit(q))


def feature_qc(long: DataFrame) -> DataFrame:
    """Per feature mean, std, median, min, max, 5th and 95th percentile of what is present, and the percentage above 0
    of all rows, missing ones included."""
    v = F.col("value")
    plain = long.groupBy("feature").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), (100 * F.count_if(v > 0) / F.count("*")).alias("pct_nonzero"))
    return plain.join(small(quantiles(long, ["feature"], median=(v, 0.5), pct_5=(v, 0.05), pct_95=(v, 0.95))), "feature")


def row_qc(df: DataFrame, obs: str, vector: str) -> DataFrame:
    """Per observation total, features above 0, mean and maximum, from the array itself; null arrays give nulls."""
    present = F.filter(F.transform(f"`{vector}`", lambda x: x.cast("double")), lambda x: x.isNotNull() & ~F.isnan(x))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return df.select(F.col(f"`{obs}`").alias("obs"), present.alias("v")).select(
        "obs", F.when(F.col("v").isNotNull(), total).alias("total"), F.size(F.filter("v", lambda x: x > 0)).alias("n_positive"), F.try_divide(total, F.size("v")).alias("mean"), F.array_max("v").alias("max")
    )


def robust_scale(long: DataFrame, low: float = 0.05, high: float = 0.95, centre: bool = True) -> DataFrame:
    """(value - median) / (q high - q low) by feature; a zero range counts as 1. Two passes: the feature statistics
    are one row for each feature and joined back."""
    stats = quantiles(long, ["feature"], m=("value", 0.5), _hi=("value", high), _lo=("value", low)).select("feature", "m", (F.col("_hi") - F.col("_lo")).alias("r"))
    shifted = F.col("value") - F.col("m") if centre else F.col("value")
    return long.join(small(stats), "feature").withColumn("value", shifted / F.when(F.col("r") == 0, 1.0).otherwise(F.col("r"))).drop("m", "r")


def zscore(long: DataFrame, ddof: int = 0) -> DataFrame:
    """(value - mean) / std by feature, null for a constant feature."""
    std = F.stddev_pop("value") if ddof == 0 else F.stddev_samp("value")
    stats = long.groupBy("feature").agg(F.avg("value").alias("m"), std.alias("s"))
    return long.join(small(stats), "feature").withColumn("value", F.when(F.col("s") > 0, (F.col("value") - F.col("m")) / F.col("s"))).drop("m", "s")


def log_transform(long: DataFrame, pseudocount: float = 1.0, base: float | None = None) -> DataFrame:
    """log(value + pseudocount); null where that isn't positive."""
    shifted = F.col("value") + pseudocount
    found = F.log(shifted) if base is None else F.log2(shifted) if base == 2 else F.log10(shifted) if base == 10 else F.log(float(base), shifted)
    return long.withColumn("value", F.when(shifted > 0, found))


def row_totals(long: DataFrame) -> DataFrame:
    return long.groupBy("obs").agg(F.sum("value").alias("total"))


def tic_normalize(long: DataFrame, target: float | None = None) -> DataFrame:
    """Rows scaled to ``target`` or to the median of the positive row totals; rows of total 0 stay as they are."""
    totals = row_totals(long)
    if target is None:
        totals = materialize(totals)
        goal = quantiles(totals.where("total > 0"), [], goal=("total", 0.5))
        totals = totals.join(F.broadcast(goal))  # one row
    else:
        totals = totals.withColumn("goal", F.lit(float(target)))
    return long.join(totals, "obs").withColumn("value", F.when(F.col("total") == 0, F.col("value")).otherwise(F.col("value") * F.col("goal") / F.col("total"))).drop("total", "goal")


def filter_by_intensity(long: DataFrame, min_total: float | None = None, max_total: float | None = None, min_percentile: float | None = None, max_percentile: float | None = None) -> DataFrame:
    """Observations (``obs``) whose total lies within the bounds, inclusive; percentiles are those of all totals."""
    totals = materialize(row_totals(long))
    keep = F.lit(True)
    if min_total is not None:
        keep = keep & (F.col("total") >= min_total)
    if max_total is not None:
        keep = keep & (F.col("total") <= max_total)
    if min_percentile is not None or max_percentile is not None:
        bounds = quantiles(totals, [], lo=("total", (min_percentile or 0) / 100), hi=("total", (100 if max_percentile is None else max_percentile) / 100))
        totals = totals.join(F.broadcast(bounds))  # one row
        keep = keep & F.col("total").between(F.col("lo"), F.col("hi"))
    return totals.where(keep).select("obs")


def filter_features(long: DataFrame, min_nonzero_pct: float = 1.0) -> DataFrame:
    """Features (``feature``) above 0 in at least this percentage of all rows."""
    return long.groupBy("feature").agg((100 * F.count_if(F.col("value") > 0) / F.count("*")).alias("p")).where(F.col("p") >= min_nonzero_pct).select("feature")


def variability(long: DataFrame, method: str = "variance") -> DataFrame:
    """``feature, score``: variance, variance / mean (dispersion) or std / mean (cv)."""
    mean, var, std = F.avg("value"), F.var_pop("value"), F.stddev_pop("value")
    score = {"variance": var, "dispersion": var / (mean + TINY), "cv": std / (mean + TINY)}[method]
    return long.groupBy("feature").agg(score.alias("score"))


def top_features(scores: DataFrame, n: int) -> DataFrame:
    """The ``n`` highest scores, ties by feature name."""
    return scores.orderBy(F.desc("score"), "feature").limit(n)


def tissue_contrast(long: DataFrame, min_rows: int = 10) -> DataFrame:
    """``feature, score``: |mean in tissue - mean in background| / (std in tissue + 1e-10).

    Tissue is where the row total exceeds the 25th percentile of the positive totals; with fewer than ``min_rows`` rows
    on either side the score is the variance.
    """
    totals = materialize(row_totals(long))
    cut = quantiles(totals.where("total > 0"), [], cut=("total", 0.25))
    marked = totals.join(F.broadcast(cut)).select("obs", (F.col("total") > F.col("cut")).alias("tissue"))  # one row
    sides = marked.agg(F.count_if("tissue").alias("n_t"), F.count_if(~F.col("tissue")).alias("n_b"))
    t, b = F.when(F.col("tissue"), F.col("value")), F.when(~F.col("tissue"), F.col("value"))
    by = long.join(marked, "obs").groupBy("feature").agg((F.abs(F.avg(t) - F.avg(b)) / (F.stddev_pop(t) + TINY)).alias("contrast"), F.var_pop("value").alias("var"))
    enough = (F.col("n_t") >= min_rows) & (F.col("n_b") >= min_rows)
    return by.join(F.broadcast(sides)).select("feature", F.when(enough, F.col("contrast")).otherwise(F.col("var")).alias("score"))


def composite(long: DataFrame, method: str = "snr", top_n: int = 10) -> DataFrame:
    """``obs, score``: one value for each observation.

    ``snr``: weighted sum of the ``top_n`` features by mean / std, weights summing to 1; ``weighted_sum``: of all
    features, weighted by cv; ``mip``: the maximum.
    """
    if method == "mip":
        return long.groupBy("obs").agg(F.max("value").alias("score"))
    if method == "snr":
        weights = top_features(long.groupBy("feature").agg((F.avg("value") / (F.stddev_pop("value") + TINY)).alias("score")), top_n)
    else:
        weights = variability(long, "cv")
    share = F.col("score") / F.sum("score").over(Window.partitionBy(F.lit(0)))  # over one row for each feature
    weights = weights.select("feature", share.alias("w"))
    return long.join(small(weights), "feature").groupBy("obs").agg(F.sum(F.col("w") * F.col("value")).alias("score"))


def merge_channels(long: DataFrame, channels: Sequence[str], how: str = "outer", fill: float = 0.0, by: Sequence[str] = ("x", "y")) -> DataFrame:
    """One column for each of ``channels`` from rows ``*by, channel, value``; a repeated pixel is summed.

    The N-way join on the position is one shuffle: a pivot. ``inner`` keeps positions that all channels have, ``outer``
    fills the others.
    """
    wide = long.where(F.col("channel").isin(list(channels))).groupBy(*by).agg(*[F.sum(F.when(F.col("channel") == c, F.col("value"))).alias(c) for c in channels])
    if how == "inner":
        return wide.na.drop(subset=list(channels))
    return wide.na.fill(fill, subset=list(channels))


def split_channels(wide: DataFrame, channels: Sequence[str], by: Sequence[str] = ("x", "y"), above: float | None = None) -> DataFrame:
    """The long form ``*by, channel, value``; with ``above``, values not above it are missing and left out."""
    long = wide.unpivot(list(by), list(channels), "channel", "value").where("value is not null")
    return long if above is None else long.where(F.col("value") > above)


def library_size(long: DataFrame, target: float | None = 1e4, log: bool = True) -> DataFrame:
    """Counts scaled so that each observation sums to ``target`` (to the median total if None), then log1p."""
    scaled = tic_normalize(long, target)
    return scaled.withColumn("value", F.log1p("value")) if log else scaled


def common_features(long: DataFrame, sample: str) -> DataFrame:
    """``feature``: those that every sample has."""
    n = long.agg(F.countDistinct(sample).alias("all"))
    return long.groupBy("feature").agg(F.countDistinct(sample).alias("n")).join(F.broadcast(n)).where("n = all").select("feature")  # one row


def location_scale(long: DataFrame, batch: str) -> DataFrame:
    """Batch correction: each batch's feature is moved to the feature's mean and std over all (constant ones: to its mean)."""
    by_batch = long.groupBy(batch, "feature").agg(F.avg("value").alias("bm"), F.stddev_pop("value").alias("bs"))
    by_all = long.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    stats = small(by_batch.join(by_all, "feature"))
    scaled = F.when(F.col("bs") > 0, (F.col("value") - F.col("bm")) / F.col("bs") * F.col("s") + F.col("m")).otherwise(F.col("m"))
    return long.join(stats, [batch, "feature"]).withColumn("value", scaled).drop("bm", "bs", "m", "s")
