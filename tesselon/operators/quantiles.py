"""Exact quantiles and ranks of large groups, no group of which is gathered in one task.

Quantiles are bracketed by Spark's mergeable sketch in a first pass; a second one counts what lies below the bracket and
combines, on the map side, the few distinct values within it. Ranks come from value counts in a range-partitioned order,
whose parts are summed up before the values of a part are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.session import materialize, small

#: Of the sketch: a rank is known to one in so many rows.
ACCURACY = 2_000


def quantiles(df: DataFrame, by: Sequence[str], **wanted: tuple[Column | str, float]) -> DataFrame:
    """``by`` and a column for each of ``wanted`` (name = (column, q)): exact quantiles with linear interpolation.

    Null values are left out; a group without any has null, an empty table without ``by`` a row of nulls. Groups with a
    null key count as any other.
    """
    names = list(wanted)
    columns = {n: F.col(c) if isinstance(c, str) else c for n, (c, _) in wanted.items()}
    keys = [f"_g{i}" for i in range(len(by))]
    values = [f"_v{i}" for i in range(len(names))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], *[columns[n].cast("double").alias(v) for n, v in zip(names, values)])
    about = []
    for n, v in zip(names, values):
        q = wanted[n][1]
        span = F.percentile_approx(v, [max(0.0, q - 2 / ACCURACY), min(1.0, q + 2 / ACCURACY)], ACCURACY)
        about += [F.when(F.count(v) > 4 * ACCURACY, span).otherwise(F.array(F.min(v), F.max(v))).alias(f"_s{v}"), F.count(v).alias(f"_n{v}")]
    spans = materialize(rows.groupBy(*keys).agg(*about))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    spans = small(spans)  # of a group with few values they span all of it
    both = rows.alias("l").join(spans.alias("r"), _all(on)) if keys else rows.join(F.broadcast(spans))  # one row
    both = both.select(*[F.col(f"l.{k}" if keys else k).alias(k) for k in keys], *values, *[f"_s{v}" for v in values])
    # by group and quantile: the number below the bracket (value null) and the counts of the values within
    cells = [F.when(F.col(v) < F.get(f"_s{v}", F.lit(0)), F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("v"))).when(F.col(v) <= F.get(f"_s{v}", F.lit(1)), F.struct(F.lit(i).alias("i"), F.col(v).alias("v"))) for i, v in enumerate(values)]
    counted = both.select(*keys, F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c")).groupBy(*keys, "c.i", "c.v").agg(F.count("*").alias("t"))
    before = F.sum("t").over(Window.partitionBy(*keys, "i").orderBy(F.asc_nulls_first("v"))) - F.col("t")
    ends = counted.withColumn("before", before).where("v is not null")
    sizes = spans.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_n{v}").alias("n"), F.lit(float(wanted[m][1])).alias("q")) for i, (m, v) in enumerate(zip(names, values))])).alias("s")).select(*keys, "s.*").where("n > 0")
    on = [F.col(f"e.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys] + [F.col("e.i") == F.col("s.i")]
    at = (F.col("n") - 1) * F.col("q")
    holds = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("t"))
    found = ends.alias("e").join(small(sizes).alias("s"), _all(on)).select(*[f"e.{k}" for k in keys], "e.i", "v", "before", "t", at.alias("at"))
    low, high = F.max(F.when(holds(F.floor("at")), F.col("v"))), F.max(F.when(holds(F.ceil("at")), F.col("v")))
    each = found.groupBy(*keys, "i").agg(low.alias("low"), high.alias("high"), F.first("at").alias("at"))
    each = each.withColumn("value", F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at")))
    wide = each.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("value"))).alias(n) for i, n in enumerate(names)])
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    whole = spans.select(*keys).alias("l").join(wide.alias("r"), _all(on), "left") if keys else wide
    return materialize(whole.select(*[F.col(f"l.{k}").alias(c) for k, c in zip(keys, by)], *names))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def value_ranks(counts: DataFrame, by: Sequence[str], value: str, count: str) -> DataFrame:
    """``counts`` (a row for each ``by`` and ``value``) with ``before``: rows of smaller values in the group.

    The values are range-partitioned; the rows of whole parts before a value's part are added up from one number a group
    and part, so no group is ordered in one task.
    """
    laid = counts.repartitionByRange(*by, value) if by else counts.repartitionByRange(value)
    laid = materialize(laid.withColumn("_part", F.spark_partition_id()))
    parts = laid.groupBy(*by, "_part").agg(F.sum(count).alias("_t"))
    ahead = F.coalesce(F.sum("_t").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = small(parts.select(*by, "_part", ahead.alias("_ahead")))
    within = F.coalesce(F.sum(count).over(Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return laid.withColumn("before", within).join(parts, [*by, "_part"]).withColumn("before", F.col("before") + F.col("_ahead")).drop("_part", "_ahead")
