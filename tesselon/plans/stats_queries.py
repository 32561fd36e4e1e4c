"""Cohort queries: group statistics, tests, feature sets, correlation, composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.operators import stats as S
from tesselon.plans.matrix_queries import C, expressed, rounded
from tesselon.plans.registry import Registry
from tesselon.operators.quantiles import quantiles
from tesselon.session import clean, small, table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

MOMENTS = f"{C}, m AS (SELECT disease, sample_id, feature, avg(value) AS mean, var_pop(value) AS variance FROM c WHERE disease IS NOT NULL GROUP BY ALL)"
PEAKS = f"""{MOMENTS}, g AS (SELECT disease, feature, avg(variance) AS mean FROM m GROUP BY ALL), q AS (SELECT disease, quantile_cont(mean, 0.75) AS cut FROM g GROUP BY ALL),
    p AS (SELECT disease, feature FROM g JOIN q USING (disease) WHERE mean >= cut)"""


def _moments(spark, sf_dir):
    long = expressed(spark, sf_dir, ("sample_id", "disease")).where("disease is not null")
    return S.sample_moments(long.withColumn("sample", F.struct("disease", "sample_id")), "sample").select("sample.disease", "sample.sample_id", "feature", "mean", "variance")


def _peaks(spark, sf_dir):
    return S.variable_peaks(S.group_stats(_moments(spark, sf_dir), "disease", "variance"), "disease")


@R.query(f"WITH {MOMENTS} SELECT disease, sample_id, feature, round(mean, 6) AS mean, round(variance, 6) AS variance FROM m")
def sample_moments(spark, sf_dir):
    return rounded(_moments(spark, sf_dir), "mean", "variance")


@R.query(f"WITH {MOMENTS} SELECT disease, feature, round(avg(mean), 6) AS mean, round(stddev_samp(mean), 6) AS std, round(quantile_cont(mean, 0.5), 6) AS median FROM m GROUP BY ALL")
def group_mean_std_median(spark, sf_dir):
    return rounded(S.group_stats(_moments(spark, sf_dir), "disease"), "mean", "std", "median")


@R.query(f"WITH {PEAKS} SELECT * FROM p")
def group_variance_peaks(spark, sf_dir):
    return _peaks(spark, sf_dir)


@R.query(f"WITH {PEAKS} SELECT feature FROM p GROUP BY feature HAVING count(*) = (SELECT count(DISTINCT disease) FROM p)")
def peaks_shared(spark, sf_dir):
    return S.shared_peaks(_peaks(spark, sf_dir), "disease")


@R.query(f"WITH {PEAKS} SELECT min(disease) AS disease, feature FROM p GROUP BY feature HAVING count(*) = 1")
def peaks_specific(spark, sf_dir):
    return S.specific_peaks(_peaks(spark, sf_dir), "disease")


@R.query(f"""WITH {MOMENTS}, two AS (SELECT disease, row_number() OVER (ORDER BY count(*) DESC, disease) AS place FROM integrated_cells WHERE disease IS NOT NULL GROUP BY disease),
    a AS (SELECT feature, count(mean) FILTER (place = 1) AS n1, count(mean) FILTER (place = 2) AS n2, avg(mean) FILTER (place = 1) AS m1, avg(mean) FILTER (place = 2) AS m2,
      var_pop(mean) FILTER (place = 1) AS v1, var_pop(mean) FILTER (place = 2) AS v2 FROM m JOIN two USING (disease) GROUP BY ALL)
    SELECT feature, round(m1, 6) AS mean_1, round(m2, 6) AS mean_2, round(log2((m1 + 1) / (m2 + 1)), 6) AS log2_fc,
      round((m1 - m2) / sqrt((v1 * n1 + v2 * n2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t, n1 + n2 - 2 AS df FROM a""")
def ttest_statistic(spark, sf_dir):
    """The two diseases with the most cells against one another."""
    return rounded(_two_diseases(spark, sf_dir).drop("p"), "mean_1", "mean_2", "log2_fc", "t")


def _two_diseases(spark, sf_dir):
    sizes = table(spark, sf_dir, "integrated_cells").where("disease is not null").groupBy("disease").count().orderBy(F.desc("count"), "disease")
    one, two = ([r[0] for r in sizes.limit(2).collect()] + [None, None])[:2]
    return S.t_test(_moments(spark, sf_dir), "disease", one, two)


@R.query()
def differential_test(spark, sf_dir):
    """t, p and false discovery rate of each feature between the two largest diseases."""
    return S.adjust(_two_diseases(spark, sf_dir), "p")


@R.query("""WITH a AS (SELECT metric_id AS feature, sample_id, least(1.0, mean_distance / 100) AS p FROM (SELECT DISTINCT * EXCLUDE (run_at) FROM alignment_metrics)
      WHERE sample_id IS NOT NULL AND mean_distance IS NOT NULL AND NOT isnan(mean_distance) AND mean_distance >= 0 QUALIFY row_number() OVER (PARTITION BY metric_id ORDER BY mean_distance) = 1),
    r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY p, feature) AS r, count(*) OVER (PARTITION BY sample_id) AS m FROM a)
    SELECT feature, sample_id, round(least(1.0, min(p * m / r) OVER (PARTITION BY sample_id ORDER BY p, feature ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS p_adjusted FROM r""")
def bh_adjust(spark, sf_dir):
    """The adjustment on a number between 0 and 1 that stands in for a p."""
    rows = table(spark, sf_dir, "alignment_metrics").select(F.col("metric_id").alias("feature"), "sample_id", clean("mean_distance").alias("d")).where("sample_id is not null and d >= 0")
    single = rows.groupBy("feature").agg(F.min_by("sample_id", "d").alias("sample_id"), F.least(F.lit(1.0), F.min("d") / 100).alias("p"))
    return rounded(S.adjust(single, "p", "sample_id"), "p_adjusted").select("feature", "sample_id", "p_adjusted")


RANKS = f"""{C}, k AS (SELECT phenotype, disease FROM cells WHERE phenotype IS NOT NULL AND disease IS NOT NULL GROUP BY ALL HAVING count(*) >= 50),
    k2 AS (SELECT * FROM k QUALIFY count(*) OVER (PARTITION BY phenotype) > 1),
    r AS (SELECT phenotype, disease, feature, value, rank() OVER w + (count(*) OVER (PARTITION BY phenotype, feature, value) - 1) / 2.0 AS rank,
      count(*) OVER (PARTITION BY phenotype, feature, value) AS t FROM c JOIN k2 USING (phenotype, disease) WINDOW w AS (PARTITION BY phenotype, feature ORDER BY value)),
    n AS (SELECT phenotype, feature, count(*)::DOUBLE AS n, sum(t::DOUBLE * t - 1) AS ties FROM r GROUP BY ALL),
    w AS (SELECT phenotype, disease, feature, count(*) AS n1, sum(rank) AS w FROM r GROUP BY ALL)"""


@R.query(f"""WITH {RANKS} SELECT phenotype, disease, feature, n1, round(CASE WHEN n1 * (n - n1) > 0 THEN (w - n1 * (n + 1) / 2) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))) END, 6) AS z
    FROM w JOIN n USING (phenotype, feature)""")
def ranksum_z(spark, sf_dir):
    long = expressed(spark, sf_dir, ("phenotype", "disease")).where("phenotype is not null and disease is not null")
    return rounded(S.rank_sum(long, "phenotype", "disease").drop("p"), "z")


@R.query()
def ranksum_differential(spark, sf_dir):
    """Stratified rank-sum test with false discovery rates: the 100 features of the least p of each stratum and group."""
    long = expressed(spark, sf_dir, ("phenotype", "disease")).where("phenotype is not null and disease is not null")
    tests = S.adjust(S.rank_sum(long, "phenotype", "disease"), "p", "phenotype", "disease")
    from pyspark.sql import Window

    return tests.withColumn("rank", F.row_number().over(Window.partitionBy("phenotype", "disease").orderBy("p", "feature"))).where("rank <= 100")


CELLS = "(SELECT DISTINCT ON (cell_uid) * FROM integrated_cells)"


def _cells(spark, sf_dir, *columns):
    return table(spark, sf_dir, "integrated_cells").select("cell_uid", *columns).dropDuplicates(["cell_uid"])


@R.query(f"""WITH r AS (SELECT disease, n_transcripts::DOUBLE AS a, protein_cd45::DOUBLE AS b FROM {CELLS} WHERE n_transcripts IS NOT NULL AND protein_cd45 IS NOT NULL AND NOT isnan(protein_cd45) AND disease IS NOT NULL),
    k AS (SELECT disease, rank() OVER (PARTITION BY disease ORDER BY a) + (count(*) OVER (PARTITION BY disease, a) - 1) / 2.0 AS ra,
      rank() OVER (PARTITION BY disease ORDER BY b) + (count(*) OVER (PARTITION BY disease, b) - 1) / 2.0 AS rb FROM r)
    SELECT disease, count(*) AS n, round(corr(ra, rb), 6) AS rho FROM k GROUP BY ALL HAVING count(*) >= 10""")
def spearman_by_disease(spark, sf_dir):
    rows = _cells(spark, sf_dir, "disease", clean("n_transcripts").alias("a"), clean("protein_cd45").alias("b")).where("a is not null and b is not null and disease is not null")
    ranked = S.average_ranks(S.average_ranks(rows, "a", "ra", "disease"), "b", "rb", "disease")
    return rounded(ranked.groupBy("disease").agg(F.count("*").alias("n"), S.pearson(F.col("ra"), F.col("rb")).alias("rho")).where("n >= 10"), "rho")


@R.query(f"""WITH r AS (SELECT sample_id, n_transcripts::DOUBLE AS a, n_genes::DOUBLE AS b FROM {CELLS} WHERE n_transcripts IS NOT NULL AND n_genes IS NOT NULL)
    SELECT sample_id, round(coalesce(CASE WHEN stddev_pop(a) * stddev_pop(b) > 1e-12 THEN covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) END, 0), 6) AS r FROM r GROUP BY ALL""")
def pearson_by_sample(spark, sf_dir):
    rows = _cells(spark, sf_dir, "sample_id", clean("n_transcripts").alias("a"), clean("n_genes").alias("b")).where("a is not null and b is not null")
    return rounded(rows.groupBy("sample_id").agg(S.pearson(F.col("a"), F.col("b")).alias("r")), "r")


COMPOSITION = f"""n AS (SELECT sample_id, disease, phenotype, count(*) AS n FROM {CELLS} WHERE phenotype IS NOT NULL AND sample_id IS NOT NULL GROUP BY ALL),
    s AS (SELECT *, n / sum(n) OVER (PARTITION BY sample_id) AS proportion FROM n)"""


@R.query(f"WITH {COMPOSITION} SELECT sample_id, disease, phenotype, n, round(proportion, 6) AS proportion FROM s")
def composition_share(spark, sf_dir):
    return rounded(S.composition(_cells(spark, sf_dir, "sample_id", "disease", "phenotype"), "sample_id", "disease", "phenotype"), "proportion")


@R.query(f"""WITH {COMPOSITION}, w AS (SELECT sample_id, disease, coalesce(sum(proportion) FILTER (phenotype = p), 0) AS share, p FROM s CROSS JOIN (SELECT DISTINCT phenotype AS p FROM s) GROUP BY ALL)
    SELECT sample_id, disease, string_agg(p || '=' || printf('%.6f', share), ';' ORDER BY p) AS shares FROM w GROUP BY ALL""")
def composition_pivot(spark, sf_dir):
    """A column for each phenotype of the data, here joined into one, for a schema that doesn't follow the data."""
    counts = S.composition(_cells(spark, sf_dir, "sample_id", "disease", "phenotype"), "sample_id", "disease", "phenotype")
    wide = S.composition_wide(counts, "sample_id", "disease", "phenotype")
    labels = sorted(c for c in wide.columns if c not in ("sample_id", "disease"))
    return wide.select("sample_id", "disease", F.concat_ws(";", *[F.concat(F.lit(f"{c}="), F.format_string("%.6f", F.col(f"`{c}`"))) for c in labels]).alias("shares"))


@R.query(f"SELECT phenotype, count(*) AS n FROM {CELLS} WHERE phenotype IS NOT NULL GROUP BY ALL ORDER BY n DESC, phenotype LIMIT 5")
def top_phenotypes(spark, sf_dir):
    return _cells(spark, sf_dir, "phenotype").where("phenotype is not null").groupBy("phenotype").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "phenotype").limit(5)


@R.query(f"""SELECT sample_id, count(*) AS cells, median(n_transcripts)::DOUBLE AS median_counts, round(quantile_cont(n_transcripts::DOUBLE, 0.01), 6) AS q01, round(quantile_cont(n_transcripts::DOUBLE, 0.99), 6) AS q99,
    median(n_genes)::DOUBLE AS median_genes FROM {CELLS} GROUP BY ALL""")
def sample_summary(spark, sf_dir):
    cells = _cells(spark, sf_dir, "sample_id", "n_transcripts", "n_genes")
    q = quantiles(cells, ["sample_id"], median_counts=("n_transcripts", 0.5), q01=("n_transcripts", 0.01), q99=("n_transcripts", 0.99), median_genes=("n_genes", 0.5))
    sizes = cells.groupBy("sample_id").agg(F.count("*").alias("cells"))
    return rounded(sizes.join(small(q), sizes["sample_id"].eqNullSafe(q["sample_id"])).drop(q["sample_id"]), "q01", "q99")


@R.query(f"""WITH c AS (SELECT cell_uid, sample_id, n_genes::DOUBLE AS g, n_transcripts::DOUBLE AS t FROM {CELLS}),
    b AS (SELECT sample_id, quantile_cont(g, 0.01) AS g1, quantile_cont(t, 0.01) AS t1, quantile_cont(t, 0.99) AS t99 FROM c GROUP BY ALL)
    SELECT cell_uid FROM c JOIN b USING (sample_id) WHERE g >= g1 AND t BETWEEN t1 AND t99""")
def quantile_cell_filter(spark, sf_dir):
    cells = _cells(spark, sf_dir, "sample_id", F.col("n_genes").cast("double").alias("g"), F.col("n_transcripts").cast("double").alias("t"))
    bounds = quantiles(cells, ["sample_id"], g1=("g", 0.01), t1=("t", 0.01), t99=("t", 0.99))
    return cells.join(small(bounds), "sample_id").where("g >= g1 and t between t1 and t99").select("cell_uid")
