"""Profiles, selections and reports on tables of any width."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.operators.quantiles import value_ranks
from tesselon.session import small


def value_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n, n_null, n_distinct, top, top_n``: of each column its rows, nulls, different values and the most frequent
    value as text (ties to the smaller). Counts of equal values are combined on the map side; a column of nulls has a
    null ``top``."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("t"))
    there = F.col("value").isNotNull()
    top = F.min(F.when(there, F.struct((-F.col("t")).alias("t"), "value")))
    return counts.groupBy("column").agg(F.sum("t").alias("n"), F.coalesce(F.sum(F.when(~there, F.col("t"))), F.lit(0)).alias("n_null"), F.count("value").alias("n_distinct"), top.alias("_top")).select(
        "column", "n", "n_null", "n_distinct", F.col("_top.value").alias("top"), (-F.col("_top.t")).alias("top_n")
    )


def first_seen(df: DataFrame, value: str, *order: str) -> DataFrame:
    """``value, place``: different values in the order of their first row (by ``order``, unique), as its order columns."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(F.struct(*order)).alias("first"))


def every_nth(df: DataFrame, scope: str, order: str, n: int) -> DataFrame:
    """Every ``n``-th row of a scope in the order of a key, from the first; rows repeated with a key count once. Places
    come from ranges of keys, so no scope is ordered in one task."""
    keys = df.where(F.col(scope).isNotNull() & F.col(order).isNotNull()).select(scope, order).distinct().withColumn("_one", F.lit(1))
    return value_ranks(keys, [scope], order, "_one").where(F.col("before") % n == 0).select(scope, order)


def cumulative_share(scores: DataFrame, name: str, score: str) -> DataFrame:
    """``name, share, cumulative`` in falling order of the score (a row for each feature, so few)."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(score), name)
    whole = Window.partitionBy(F.lit(0))
    share = F.col(score) / F.sum(score).over(whole)
    return scores.select(name, share.alias("share"), (F.sum(score).over(order) / F.sum(score).over(whole)).alias("cumulative"))


def feature_report(long: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """``feature, present, n``: for each wanted feature whether the matrix has it, with its values."""
    spark = long.sparkSession
    asked = spark.createDataFrame([(w,) for w in wanted], "feature string")
    there = long.join(F.broadcast(asked), "feature", "left_semi").groupBy("feature").agg(F.count("value").alias("n"))  # as many as were asked for
    return asked.join(there, "feature", "left").select("feature", F.col("n").isNotNull().alias("present"), F.coalesce("n", F.lit(0)).alias("n"))


def to_bytes(df: DataFrame, column: str, by: str) -> DataFrame:
    """Adds ``level``: the column between its least and largest value of a group as 0 to 255 (cut off, not rounded); 0
    without a range, null for null."""
    bounds = df.groupBy(by).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    scaled = F.when(F.col("_hi") > F.col("_lo"), F.floor(255 * (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))).otherwise(0)
    return df.join(small(bounds), by).withColumn("level", F.when(F.col(column).isNotNull(), scaled).cast("int")).drop("_lo", "_hi")


def cell_chain(long: DataFrame, sample: str, min_features: int, min_rows: int, min_sample: int) -> DataFrame:
    """A matrix with the filters in order: observations with at least ``min_features`` values above 0, then features above
    0 in at least ``min_rows`` of those, then samples of at least ``min_sample`` of those. Null values stay with their
    observation."""
    enough = long.groupBy("obs").agg(F.count_if(F.col("value") > 0).alias("k")).where(F.col("k") >= min_features).select("obs")
    kept = long.join(enough, "obs", "left_semi")
    features = small(kept.groupBy("feature").agg(F.count_if(F.col("value") > 0).alias("k")).where(F.col("k") >= min_rows).select("feature"))
    samples = small(kept.groupBy(sample).agg(F.countDistinct("obs").alias("k")).where(F.col("k") >= min_sample).select(sample))
    return kept.join(features, "feature", "left_semi").join(samples, sample, "left_semi")


def status_table(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every expected combination of ``keys`` with the number of rows there are of it and ``missing`` or ``present``."""
    there = present.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return expected.select(*keys).distinct().join(there, list(keys), "left").select(*keys, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(F.col("n_rows") > 0, "present").otherwise("missing").alias("status"))


def label_means(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of each column within a label, nulls and NaN left out, with the number of rows; null labels are left out."""
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    rows = df
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.avg(value(c)).alias(f"mean_{c}") for c in columns])


def welch_t(long: DataFrame, stratum: str, group: str, min_rows: int = 50) -> DataFrame:
    """``stratum, group, feature, t``: each group against the others of its stratum, variances apart.

    The others' moments follow from those of all and of the group, so one aggregate serves all groups. Groups of fewer
    than ``min_rows`` observations take no part; no variance on both sides gives null.
    """
    sizes = long.groupBy(stratum, group).agg(F.countDistinct("obs").alias("k")).where(F.col("k") >= min_rows).drop("k")
    v = F.col("value")
    own = long.join(small(sizes), [stratum, group]).where("value is not null").groupBy(stratum, group, "feature").agg(F.count("*").cast("double").alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v"))
    all_ = Window.partitionBy(stratum, "feature")  # over one row for each group
    n, total = F.col("n"), F.sum("n").over(all_)
    mean = F.sum(F.col("n") * F.col("m")).over(all_) / total
    square = F.sum(F.col("n") * (F.col("v") + F.pow(F.col("m"), 2))).over(all_)
    rest = own.withColumns({"rn": total - n, "rm": (mean * total - n * F.col("m")) / F.nullif(total - n, F.lit(0.0)), "rs": square - n * (F.col("v") + F.pow(F.col("m"), 2))})
    rv = F.col("rs") / F.col("rn") - F.pow(F.col("rm"), 2)
    spread = F.sqrt(F.col("v") / F.nullif(n - 1, F.lit(0.0)) + F.greatest(rv, F.lit(0.0)) / F.nullif(F.col("rn") - 1, F.lit(0.0)))
    return rest.where("rn > 0").select(stratum, group, "feature", F.when(spread > 0, (F.col("m") - F.col("rm")) / spread).alias("t"))


def pick(flags: Sequence[tuple[Column, str]], other: str) -> Column:
    """Name of the first flag that holds; a null flag doesn't."""
    out = None
    for flag, name in flags:
        out = F.when(F.coalesce(flag, F.lit(False)), name) if out is None else out.when(F.coalesce(flag, F.lit(False)), name)
    return F.lit(other) if out is None else out.otherwise(other)
