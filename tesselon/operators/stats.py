"""Group statistics, tests, feature sets, correlations and composition."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselon.operators.matrix import percentile
from tesselon.operators.quantiles import value_ranks
from tesselon.session import materialize, small


def sample_moments(long: DataFrame, sample: str) -> DataFrame:
    """``sample, feature, mean, variance`` (population) over the observations of each sample."""
    return long.groupBy(sample, "feature").agg(F.avg("value").alias("mean"), F.var_pop("value").alias("variance"))


def group_stats(moments: DataFrame, group: str, measure: str = "mean") -> DataFrame:
    """Over the samples of each group: mean, sample standard deviation (null for one sample) and median by feature."""
    n = F.count(measure)
    std = F.when(n > 1, F.stddev_samp(measure))
    return moments.groupBy(group, "feature").agg(F.avg(measure).alias("mean"), std.alias("std"), percentile(measure, 0.5).alias("median"))


def variable_peaks(stats: DataFrame, group: str, q: float = 0.75) -> DataFrame:
    """Features of a group whose value is at least the group's q-quantile."""
    cut = stats.groupBy(group).agg(percentile("mean", q).alias("cut"))
    return stats.join(small(cut), group).where(F.col("mean") >= F.col("cut")).select(group, "feature")


def shared_peaks(peaks: DataFrame, group: str) -> DataFrame:
    """Features that are peaks of every group."""
    n = peaks.agg(F.countDistinct(group).alias("all"))
    return peaks.groupBy("feature").agg(F.countDistinct(group).alias("n")).join(F.broadcast(n)).where("n = all").select("feature")  # one row


def specific_peaks(peaks: DataFrame, group: str) -> DataFrame:
    """Features that are peaks of one group only, with it."""
    return peaks.groupBy("feature").agg(F.countDistinct(group).alias("n"), F.min(group).alias(group)).where("n = 1").select(group, "feature")


def fold_change(a: Column, b: Column) -> Column:
    return F.log2((a + 1) / (b + 1))


def t_test(moments: DataFrame, group: str, one: str, two: str) -> DataFrame:
    """Per feature pooled-variance two-sample t of the sample means, log2 fold change and the two-sided p.

    Fewer than two samples on a side or no variance at all give t null and p 1.
    """
    side = lambda g, f: f(F.when(F.col(group) == g, F.col("mean")))
    m = moments.where(F.col(group).isin(one, two)).groupBy("feature").agg(
        side(one, F.count).alias("n1"), side(two, F.count).alias("n2"), side(one, F.avg).alias("m1"), side(two, F.avg).alias("m2"),
        F.coalesce(side(one, F.var_pop), F.lit(0.0)).alias("v1"), F.coalesce(side(two, F.var_pop), F.lit(0.0)).alias("v2"),
    )
    df = F.col("n1") + F.col("n2") - 2
    pooled = F.try_divide(F.col("v1") * F.col("n1") + F.col("v2") * F.col("n2"), df)
    spread = F.sqrt(pooled * (F.try_divide(F.lit(1), F.col("n1")) + F.try_divide(F.lit(1), F.col("n2"))))
    t = F.when((F.col("n1") > 1) & (F.col("n2") > 1) & (spread > 0), (F.col("m1") - F.col("m2")) / spread)
    m = m.select("feature", F.col("m1").alias("mean_1"), F.col("m2").alias("mean_2"), fold_change(F.col("m1"), F.col("m2")).alias("log2_fc"), t.alias("t"), df.alias("df"))
    return m.withColumn("p", F.coalesce(t_p(F.col("t"), F.col("df")), F.lit(1.0)))


def t_p(t: Column, df: Column) -> Column:
    """Two-sided p of Student's t, by the incomplete beta function on Arrow batches."""

    @F.pandas_udf(T.DoubleType())
    def run(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or pd.isna(n) or n <= 0 else incomplete_beta(n / 2, 0.5, n / (n + a * a)) for a, n in zip(t, df)], dtype="float64")

    return run(t, df)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    h = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + top * d)
            c = 1 + top / c
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * h / a


def adjust(tests: DataFrame, p: str, *strata: str) -> DataFrame:
    """``p_adjusted`` of Benjamini and Hochberg within ``strata`` (one row for each feature there); null p counts as 1."""
    by = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    up = by.orderBy("_p", "feature")
    out = tests.withColumn("_p", F.coalesce(F.col(p), F.lit(1.0))).withColumn("_r", F.row_number().over(up)).withColumn("_m", F.count("*").over(by))
    raw = F.col("_p") * F.col("_m") / F.col("_r")
    return out.withColumn("p_adjusted", F.least(F.lit(1.0), F.min(raw).over(up.rowsBetween(0, Window.unboundedFollowing)))).drop("_p", "_r", "_m")


def rank_sum(long: DataFrame, stratum: str, group: str, min_rows: int = 50) -> DataFrame:
    """Per stratum, group and feature: z and p of the rank-sum test of the group against the others in the stratum.

    Normal approximation with average ranks and tie correction. Groups of fewer than ``min_rows`` observations don't
    take part; a stratum with fewer than two groups left is skipped. Ranks are told from counts of equal values in
    ranges of values (``value_ranks``), so a stratum's values are never ordered in one task.
    """
    sizes = long.groupBy(stratum, group).agg(F.countDistinct("obs").alias("n")).where(F.col("n") >= min_rows)
    sizes = sizes.withColumn("groups", F.count("*").over(Window.partitionBy(stratum))).where("groups > 1").select(stratum, group)
    rows = long.join(small(sizes), [stratum, group]).where("value is not null")
    by_value = rows.groupBy(stratum, "feature", "value", group).agg(F.count("*").alias("c"))
    values = by_value.groupBy(stratum, "feature", "value").agg(F.sum("c").alias("t"), F.map_from_entries(F.collect_list(F.struct(group, "c"))).alias("by"))
    ranked = materialize(value_ranks(values, [stratum, "feature"], "value", "t").withColumn("rank", F.col("before") + (F.col("t") + 1) / 2))
    totals = ranked.groupBy(stratum, "feature").agg(F.sum("t").alias("n"), F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"))
    sums = ranked.select(stratum, "feature", "rank", F.explode("by").alias(group, "c")).groupBy(stratum, "feature", group).agg(F.sum("c").alias("n1"), F.sum(F.col("rank") * F.col("c")).alias("w"))
    both = sums.join(totals, [stratum, "feature"])
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    var = n1 * (n - n1) / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1)))
    z = F.when(var > 0, (F.col("w") - n1 * (n + 1) / 2) / F.sqrt(var))
    return both.select(stratum, group, "feature", F.col("n1"), z.alias("z")).withColumn("p", F.coalesce(normal_p(F.col("z")), F.lit(1.0)))


def normal_p(z: Column) -> Column:
    """Two-sided p of a standard normal z, on Arrow batches."""

    @F.pandas_udf(T.DoubleType())
    def run(z: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) else math.erfc(abs(x) / math.sqrt(2)) for x in z], dtype="float64")

    return run(z)


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: Pearson's r of the rows where both are present; 0 where either is constant or none are."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b))
    return F.coalesce(F.when(spread > 1e-12, F.covar_pop(a, b) / spread), F.lit(0.0))


def average_ranks(df: DataFrame, value: str, name: str, *by: str) -> DataFrame:
    """Adds the average rank of ``value`` within ``by``, from counts of equal values; null for null."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_t"))
    ranks = materialize(value_ranks(counts, by, value, "_t").select(*by, value, (F.col("before") + (F.col("_t") + 1) / 2).alias(name)))
    return df.join(small(ranks), [*by, value], "left")


def composition(df: DataFrame, sample: str, group: str, label: str) -> DataFrame:
    """Count of each label in a sample and its share of the sample's rows; null labels are left out."""
    counts = df.where(F.col(label).isNotNull() & F.col(sample).isNotNull()).groupBy(sample, group, label).agg(F.count("*").alias("n"))
    return counts.withColumn("proportion", F.col("n") / F.sum("n").over(Window.partitionBy(sample)))


def composition_wide(counts: DataFrame, sample: str, group: str, label: str) -> DataFrame:
    """One column of shares for each label that occurs, 0 where absent. The labels are as many columns, so a few."""
    labels = [r[0] for r in counts.select(label).distinct().orderBy(label).collect()]
    return counts.groupBy(sample, group).pivot(label, labels).agg(F.sum("proportion")).na.fill(0.0, subset=labels)


def spearman_map(df: DataFrame, one: list[str], two: list[str], record_id: str, least: int = 10) -> DataFrame:
    """``one, two, n, rho`` for every pair of a column of either list: rank correlation of the rows where both are present.

    Ranks are those of such rows, told from value counts by ranges of values; all pairs go through one job.
    """
    values = F.array(*[F.struct(F.lit(a).alias("one"), F.lit(b).alias("two"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a in one for b in two])
    there = lambda c: c.isNotNull() & ~F.isnan(c)
    rows = df.select(record_id, F.explode(values).alias("v")).select(record_id, "v.*").where(there(F.col("x")) & there(F.col("y")))
    rows = materialize(rows)
    ranked = average_ranks(average_ranks(rows, "x", "rx", "one", "two"), "y", "ry", "one", "two")
    return ranked.groupBy("one", "two").agg(F.count("*").alias("n"), pearson(F.col("rx"), F.col("ry")).alias("rho")).where(F.col("n") >= least)
