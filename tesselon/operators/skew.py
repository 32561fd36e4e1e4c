"""Per-key results where a few keys hold most rows (problem 5).

Method: map-side combining. Every aggregate here is algebraic, so Spark's partial hash aggregation keeps one state
for each key in a task (falling back to sorting when its table outgrows memory) and only these states are shuffled: a
key with a third of all rows sends as many states as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.session import materialize, small


def top_k_per_key(df: DataFrame, keys: Sequence[str], measure: str, record_id: str, k: int = 3) -> DataFrame:
    """The ``k`` records of each key with the largest ``measure``; ties go to the smaller ``record_id``.

    Rows with a null key, measure or id are left out, NaN measures too. Repeated rows of a record count once. A key
    with fewer than ``k`` records gives what it has; an empty table gives none. Result: keys, ``measure``,
    ``record_id``, ``rank``; other columns of ``df`` play no part, whatever their names.

    First the largest measure in each of 64 or 4 ``k`` id-buckets of a key, an ordinary ``max`` on a primitive, so that
    it runs as a hash aggregate. The k-th largest of these maxima is reached by at least k records, so only rows from
    there on can be among the top k: a handful for each key, however large it is. A key whose records fall into fewer
    than ``k`` buckets has no bound; its few distinct records are all compared. Where very many records tie at the
    bound, ``distinct`` spreads them by record and the rank filter keeps k of each key before the last shuffle.
    """
    buckets = max(64, 4 * k)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keys, names)],
        F.col(f"`{measure}`").alias("_m"),
        F.col(f"`{record_id}`").alias("_r"),
    ).where(_present(names) & F.col("_m").isNotNull() & F.col("_r").isNotNull())
    if dict(df.dtypes)[measure] in ("double", "float"):
        rows = rows.where(~F.isnan("_m"))
    maxima = rows.groupBy(*names, F.pmod(F.xxhash64("_r"), F.lit(buckets)).alias("_b")).agg(F.max("_m").alias("_m"))
    bound = materialize(
        maxima.groupBy(*names).agg(F.sort_array(F.collect_list("_m"), asc=False).alias("a")).select(*names, F.get("a", F.lit(k - 1)).alias("_low"))
    )
    near = rows.join(small(bound), names).where(F.col("_low").isNull() | (F.col("_m") >= F.col("_low"))).select(*names, "_m", "_r").distinct()
    order = Window.partitionBy(*names).orderBy(F.col("_m").desc(), F.col("_r"))
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(*[F.col(n).alias(c) for c, n in zip(keys, names)], F.col("_m").alias(measure), F.col("_r").alias(record_id), "rank")
    )


def key_summary(df: DataFrame, keys: Sequence[str], record_id: str, measures: Sequence[str]) -> DataFrame:
    """For each key the number of records and, for each measure, its count, sum, mean, minimum and maximum.

    A record that comes several times counts once (its values must agree; the largest is taken), so rows are first
    combined by key and record, which spreads the largest keys by their records; then the algebraic states of a key
    are combined on the map side. Null keys are left out, null and NaN measures count as absent.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keys, names)],
        F.col(f"`{record_id}`").alias("_r"),
        *[F.when(~F.isnan(F.col(f"`{m}`").cast("double")), F.col(f"`{m}`").cast("double")).alias(f"_m{i}") for i, m in enumerate(measures)],
    ).where(_present(names) & F.col("_r").isNotNull())
    single = rows.groupBy(*names, "_r").agg(*[F.max(f"_m{i}").alias(f"_m{i}") for i in range(len(measures))])
    stats = [F.count("*").alias("n_records")]
    for i, m in enumerate(measures):
        c = F.col(f"_m{i}")
        stats += [F.count(c).alias(f"n_{m}"), F.sum(c).alias(f"sum_{m}"), F.avg(c).alias(f"avg_{m}"), F.min(c).alias(f"min_{m}"), F.max(c).alias(f"max_{m}")]
    return single.groupBy(*names).agg(*stats).withColumnsRenamed(dict(zip(names, keys)))


def _present(names: Sequence[str]) -> Column:
    keep = F.lit(True)
    for n in names:
        keep = keep & F.col(n).isNotNull()
    return keep
