"""Percentiles of very large numeric columns (problem 2).

Method: radix selection. Doubles are mapped to integers of the same order; a histogram of the leading digit (16 bits)
tells in which digit each wanted rank lies, then only rows with that digit are counted by their next one, until all
64 bits are known. Histograms of separate parts or days are added up; after the first digits alone they bound every
percentile, after the last they are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselon.session import clean, materialize, small

DIGIT, BITS = 16, 64


@F.pandas_udf(T.LongType())
def order_key(values: pd.Series) -> pd.Series:
    """Integers in the order of the doubles; -0.0 counts as 0.0. Not for nulls or NaN."""
    bits = (values.to_numpy(np.float64) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits))


@F.pandas_udf(T.DoubleType())
def key_value(keys: pd.Series) -> pd.Series:
    bits = keys.to_numpy(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits).view(np.float64))


def measure_keys(df: DataFrame, group: str, field: str, name: str | None = None) -> DataFrame:
    """``field_name, grp, key`` of the rows whose group and measure are present (neither null nor NaN)."""
    rows = df.select(F.col(f"`{group}`").cast("string").alias("grp"), clean(F.col(f"`{field}`")).alias("value")).na.drop()
    return rows.select(F.lit(name or field).alias("field_name"), "grp", order_key("value").alias("key"))


def digit_histogram(keys: DataFrame, bits: int = DIGIT) -> DataFrame:
    """``field_name, grp, prefix, n``: rows by the leading ``bits`` of their key; combined before the shuffle."""
    return keys.groupBy("field_name", "grp", F.shiftright("key", BITS - bits).alias("prefix")).agg(F.count("*").alias("n"))


def merge_histograms(parts: Iterable[DataFrame]) -> DataFrame:
    """The histogram of all parts from those of each (same number of bits)."""
    return reduce(DataFrame.unionByName, parts).groupBy("field_name", "grp", "prefix").agg(F.sum("n").alias("n"))


def bounded_percentiles(histogram: DataFrame, bits: int, quantiles: Sequence[float]) -> DataFrame:
    """``field_name, grp, q, low, high``: bounds of each percentile from a histogram of the leading ``bits``.

    The percentile (linear interpolation) lies in ``low`` .. ``high``. Each of the two values it is interpolated from
    is known to a relative 2 ** -(bits - 12), so ``bits`` = 20 gives 0.4 %, with at most 2 ** bits counts a group.
    """
    ranks = _ranks(histogram, quantiles)
    at = _locate(histogram.withColumn("parent", F.lit(0).cast("long")), ranks.withColumn("parent", F.lit(0).cast("long")))
    shift = BITS - bits
    low = key_value(F.shiftleft("prefix", shift))
    high = key_value(F.shiftleft("prefix", shift) + F.lit(2**shift - 1))
    return at.select("field_name", "grp", "q", low.alias("a"), high.alias("b")).groupBy("field_name", "grp", "q").agg(F.min("a").alias("low"), F.max("b").alias("high"))


def exact_percentiles(keys: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """``field_name, grp, q, value``: percentiles with linear interpolation of the keys of ``measure_keys``.

    Groups without a present value have no row; an empty table gives none. Ties and repeated rows all count.
    """
    keys = materialize(keys)
    histogram = materialize(digit_histogram(keys))
    follow = materialize(_locate(histogram.withColumn("parent", F.lit(0).cast("long")), _ranks(histogram, quantiles).withColumn("parent", F.lit(0).cast("long"))))
    for bits in range(2 * DIGIT, BITS + 1, DIGIT):
        parent = F.shiftright("key", BITS - bits + DIGIT)
        wanted = small(follow.select("field_name", "grp", F.col("prefix").alias("parent")).distinct())
        within = keys.withColumn("parent", parent).join(wanted, ["field_name", "grp", "parent"], "left_semi")
        histogram = within.groupBy("field_name", "grp", "parent", F.shiftright("key", BITS - bits).alias("prefix")).agg(F.count("*").alias("n"))
        follow = materialize(_locate(histogram, follow.select("field_name", "grp", F.col("prefix").alias("parent"), "q", "side", "share", "rank")))
    ends = follow.select("field_name", "grp", "q", "share", "side", key_value("prefix").alias("value"))
    low, high = (F.max(F.when(F.col("side") == i, F.col("value"))) for i in (0, 1))
    return ends.groupBy("field_name", "grp", "q").agg(low.alias("low"), high.alias("high"), F.first("share").alias("share")).select("field_name", "grp", "q", (F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias("value"))


def _ranks(histogram: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """The two ranks (from 0) that each percentile of a group lies between, and its share of the way."""
    at = (F.col("total") - 1) * F.col("q")
    return (
        histogram.groupBy("field_name", "grp")
        .agg(F.sum("n").alias("total"))
        .withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .select("field_name", "grp", "q", "side", (at - F.floor(at)).alias("share"), F.when(F.col("side") == 0, F.floor(at)).otherwise(F.ceil(at)).cast("long").alias("rank"))
    )


def _locate(histogram: DataFrame, ranks: DataFrame) -> DataFrame:
    """Each rank with the prefix it falls in, counted from that prefix's first row. Ranks count within ``parent``."""
    before = Window.partitionBy("field_name", "grp", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    spans = histogram.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within: Column = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    return spans.join(ranks, ["field_name", "grp", "parent"]).where(within).select("field_name", "grp", "prefix", "q", "side", "share", (F.col("rank") - F.col("before")).alias("rank"))
