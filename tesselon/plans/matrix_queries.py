"""Matrix queries: quality, normalisation, filters, selection, composites, channel layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselon.operators import matrix as M
from tesselon.plans.registry import Registry
from tesselon.session import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql


def embedded(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return M.long_matrix(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", keep)


def expressed(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    cells = table(spark, sf_dir, "integrated_cells").where("x is not null").select("cell_uid", "x", *keep).dropDuplicates(["cell_uid"])
    return M.long_matrix(cells, "cell_uid", "x", keep)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


E = "e AS (SELECT vec_id AS obs, label, printf('f%02d', i - 1) AS feature, embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) t(i))"
C = """cells AS (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells WHERE x IS NOT NULL),
    c AS (SELECT cell_uid AS obs, sample_id, disease, phenotype, printf('f%02d', i - 1) AS feature, x[i]::DOUBLE AS value FROM cells, range(1, 33) t(i))"""


@R.query(f"""WITH {C} SELECT feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS median,
    round(min(value), 6) AS min, round(max(value), 6) AS max, round(100.0 * count(*) FILTER (value > 0) / count(*), 6) AS pct_nonzero,
    round(quantile_cont(value, 0.05), 6) AS pct_5, round(quantile_cont(value, 0.95), 6) AS pct_95 FROM c GROUP BY ALL""")
def feature_qc(spark, sf_dir):
    return rounded(M.feature_qc(expressed(spark, sf_dir)), "mean", "std", "median", "min", "max", "pct_nonzero", "pct_5", "pct_95")


@R.query("""SELECT cell_uid AS obs, round(list_sum(x::DOUBLE[]), 6) + 0 AS total, len(list_filter(x, lambda v: v > 0))::INT AS n_positive, round(list_avg(x::DOUBLE[]), 6) + 0 AS mean,
    round(list_max(x::DOUBLE[]), 6) AS max FROM (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells WHERE x IS NOT NULL)""")
def row_qc(spark, sf_dir):
    cells = table(spark, sf_dir, "integrated_cells").where("x is not null").select("cell_uid", "x").dropDuplicates(["cell_uid"])
    out = rounded(M.row_qc(cells, "cell_uid", "x"), "total", "mean", "max")
    return out.withColumns({c: F.col(c) + 0.0 for c in ("total", "mean")})  # no negative zero


@R.query(f"""WITH {E}, s AS (SELECT feature, quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.95) - quantile_cont(value, 0.05) AS r FROM e GROUP BY ALL)
    SELECT obs, feature, round((value - m) / CASE WHEN r = 0 THEN 1 ELSE r END, 6) AS value FROM e JOIN s USING (feature)""")
def robust_scale(spark, sf_dir):
    return rounded(M.robust_scale(embedded(spark, sf_dir)), "value").select("obs", "feature", "value")


@R.query(f"""WITH {E}, s AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM e GROUP BY ALL)
    SELECT obs, feature, round(CASE WHEN s > 0 THEN (value - m) / s END, 6) AS value FROM e JOIN s USING (feature)""")
def zscore(spark, sf_dir):
    return rounded(M.zscore(embedded(spark, sf_dir)), "value").select("obs", "feature", "value")


@R.query(f"""WITH {E} SELECT obs, feature, 'e' AS base, round(CASE WHEN value > -1 THEN ln(value + 1) END, 6) AS value FROM e
    UNION ALL SELECT obs, feature, '2', round(CASE WHEN value > -2 THEN log2(value + 2) END, 6) FROM e
    UNION ALL SELECT obs, feature, '10', round(CASE WHEN value > -1 THEN log10(value + 1) END, 6) FROM e""")
def log_transform(spark, sf_dir):
    long = embedded(spark, sf_dir).select("obs", "feature", "value")
    parts = [("e", M.log_transform(long)), ("2", M.log_transform(long, 2.0, 2)), ("10", M.log_transform(long, base=10))]
    named = [part.withColumn("base", F.lit(name)) for name, part in parts]
    return rounded(named[0].unionByName(named[1]).unionByName(named[2]), "value")


@R.query(f"""WITH {E}, p AS (SELECT obs, feature, abs(value) AS value FROM e), t AS (SELECT obs, sum(value) AS total FROM p GROUP BY ALL),
    g AS (SELECT quantile_cont(total, 0.5) AS goal FROM t WHERE total > 0)
    SELECT obs, feature, round(CASE WHEN total = 0 THEN value ELSE value * goal / total END, 6) AS value FROM p JOIN t USING (obs), g""")
def tic_normalize(spark, sf_dir):
    return rounded(M.tic_normalize(embedded(spark, sf_dir).withColumn("value", F.abs("value"))), "value").select("obs", "feature", "value")


@R.query(f"""WITH {C}, t AS (SELECT obs, sum(value) AS total FROM c GROUP BY ALL), b AS (SELECT quantile_cont(total, 0.01) AS lo, quantile_cont(total, 0.99) AS hi FROM t)
    SELECT obs FROM t, b WHERE total BETWEEN lo AND hi""")
def intensity_filter(spark, sf_dir):
    return M.filter_by_intensity(expressed(spark, sf_dir), min_percentile=1, max_percentile=99)


@R.query(f"WITH {C} SELECT feature FROM c GROUP BY feature HAVING 100.0 * count(*) FILTER (value > 0) / count(*) >= 47")
def coverage_filter(spark, sf_dir):
    return M.filter_features(expressed(spark, sf_dir), 47)


def _top(score: str) -> str:
    return f"WITH {C}, s AS (SELECT feature, {score} AS score FROM c GROUP BY ALL) SELECT feature, round(score, 6) AS score FROM s ORDER BY s.score DESC, feature LIMIT 10"


@R.query(_top("var_pop(value)"))
def hvg_variance(spark, sf_dir):
    return rounded(M.top_features(M.variability(expressed(spark, sf_dir)), 10), "score")


@R.query(_top("var_pop(abs(value)) / (avg(abs(value)) + 1e-10)"))
def hvg_dispersion(spark, sf_dir):
    return rounded(M.top_features(M.variability(expressed(spark, sf_dir).withColumn("value", F.abs("value")), "dispersion"), 10), "score")


@R.query(_top("stddev_pop(abs(value)) / (avg(abs(value)) + 1e-10)"))
def hvg_cv(spark, sf_dir):
    return rounded(M.top_features(M.variability(expressed(spark, sf_dir).withColumn("value", F.abs("value")), "cv"), 10), "score")


@R.query(f"""WITH {C}, t AS (SELECT obs, sum(value) AS total FROM c GROUP BY ALL), k AS (SELECT quantile_cont(total, 0.25) AS cut FROM t WHERE total > 0),
    m AS (SELECT obs, total > cut AS tissue FROM t, k)
    SELECT feature, round(abs(avg(value) FILTER (tissue) - avg(value) FILTER (NOT tissue)) / (stddev_pop(value) FILTER (tissue) + 1e-10), 6) AS score FROM c JOIN m USING (obs) GROUP BY ALL""")
def tissue_contrast(spark, sf_dir):
    return rounded(M.tissue_contrast(expressed(spark, sf_dir)), "score")


@R.query(f"""WITH {C}, p AS (SELECT obs, feature, abs(value) AS value FROM c), s AS (SELECT feature, avg(value) / (stddev_pop(value) + 1e-10) AS score FROM p GROUP BY ALL ORDER BY score DESC, feature LIMIT 10),
    w AS (SELECT feature, score / sum(score) OVER () AS w FROM s) SELECT obs, round(sum(w * value), 6) AS score FROM p JOIN w USING (feature) GROUP BY ALL""")
def snr_composite(spark, sf_dir):
    return rounded(M.composite(expressed(spark, sf_dir).withColumn("value", F.abs("value")), "snr"), "score")


@R.query(f"""WITH {C}, p AS (SELECT obs, feature, abs(value) AS value FROM c), s AS (SELECT feature, stddev_pop(value) / (avg(value) + 1e-10) AS score FROM p GROUP BY ALL),
    w AS (SELECT feature, score / sum(score) OVER () AS w FROM s) SELECT obs, round(sum(w * value), 6) AS score FROM p JOIN w USING (feature) GROUP BY ALL""")
def cv_composite(spark, sf_dir):
    return rounded(M.composite(expressed(spark, sf_dir).withColumn("value", F.abs("value")), "weighted_sum"), "score")


@R.query(f"WITH {C} SELECT obs, round(max(value), 6) AS score FROM c GROUP BY ALL")
def mip_composite(spark, sf_dir):
    return rounded(M.composite(expressed(spark, sf_dir), "mip"), "score")


def _pixels(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").cast("long").alias("x"), F.col("user_id").alias("y"), F.col("event_type").alias("channel"), F.col("value"))


_PIVOT = "SELECT (props->>'$.k')::BIGINT AS x, user_id AS y, event_type AS channel, value FROM events"


def _kinds(spark, sf_dir):
    """The event types that occur, a handful, in order."""
    return [r[0] for r in _pixels(spark, sf_dir).select("channel").where("channel is not null").distinct().orderBy("channel").collect()]


@R.query(f"SELECT x, y, channel, round(sum(value), 6) AS value FROM (SELECT x, y, channel, value FROM ({_PIVOT})) GROUP BY ALL HAVING sum(value) > 0")
def unpivot_channels(spark, sf_dir):
    kinds = _kinds(spark, sf_dir)
    return rounded(M.split_channels(M.merge_channels(_pixels(spark, sf_dir), kinds), kinds, above=0.0), "value")


@R.query(f"SELECT x, y, count(DISTINCT channel) AS n_channels, round(sum(value), 6) AS total FROM ({_PIVOT}) GROUP BY ALL")
def channel_merge_outer(spark, sf_dir):
    kinds = _kinds(spark, sf_dir)
    wide = M.merge_channels(_pixels(spark, sf_dir), kinds)
    total = sum((F.col(k) for k in kinds), F.lit(0.0))
    present = sum(((F.col(k) > 0).cast("long") for k in kinds), F.lit(0).cast("long"))
    return wide.select("x", "y", present.alias("n_channels"), F.round(total, 6).alias("total"))


@R.query(f"SELECT x, y // 100 AS y, round(sum(value), 6) AS total FROM ({_PIVOT}) GROUP BY ALL HAVING count(DISTINCT channel) = (SELECT count(DISTINCT event_type) FROM events)")
def channel_merge_inner(spark, sf_dir):
    """Blocks of 100 users that have every channel."""
    kinds = _kinds(spark, sf_dir)
    blocks = _pixels(spark, sf_dir).withColumn("y", F.floor(F.col("y") / 100))
    return M.merge_channels(blocks, kinds, "inner").select("x", "y", F.round(sum((F.col(k) for k in kinds), F.lit(0.0)), 6).alias("total"))


@R.query(f"""WITH c AS (SELECT y AS obs, channel AS feature, sum(ceil(value)) AS value FROM ({_PIVOT}) GROUP BY ALL), t AS (SELECT obs, sum(value) AS total FROM c GROUP BY ALL)
    SELECT obs, feature, round(ln(1 + value * 10000 / total), 6) AS value FROM c JOIN t USING (obs)""")
def library_size_log1p(spark, sf_dir):
    counts = _pixels(spark, sf_dir).groupBy(F.col("y").alias("obs"), F.col("channel").alias("feature")).agg(F.sum(F.ceil("value").cast("double")).alias("value"))
    return rounded(M.library_size(counts), "value").select("obs", "feature", "value")


@R.query("""WITH p AS (SELECT DISTINCT sample_id AS s, phenotype AS f FROM integrated_cells WHERE phenotype IS NOT NULL AND sample_id IS NOT NULL)
    SELECT f AS feature FROM p GROUP BY f HAVING count(*) = (SELECT count(DISTINCT s) FROM p)""")
def common_features(spark, sf_dir):
    rows = table(spark, sf_dir, "integrated_cells").select("sample_id", F.col("phenotype").alias("feature")).na.drop()
    return M.common_features(rows, "sample_id")


@R.query(f"""WITH {E}, b AS (SELECT label, feature, avg(value) AS bm, stddev_pop(value) AS bs FROM e GROUP BY ALL), a AS (SELECT feature, avg(value) AS m, stddev_pop(value) AS s FROM e GROUP BY ALL)
    SELECT obs, feature, round(CASE WHEN bs > 0 THEN (value - bm) / bs * s + m ELSE m END, 6) AS value FROM e JOIN b USING (label, feature) JOIN a USING (feature)""")
def location_scale(spark, sf_dir):
    return rounded(M.location_scale(embedded(spark, sf_dir, ("label",)), "label"), "value").select("obs", "feature", "value")
