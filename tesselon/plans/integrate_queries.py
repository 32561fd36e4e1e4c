"""Queries that bring modalities together."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.functions import geometry as G
from tesselon.operators import integrate as I
from tesselon.operators import matrix as M
from tesselon.operators import nearest as N
from tesselon.operators.quantiles import quantiles
from tesselon.plans.matrix_queries import rounded
from tesselon.plans.registry import Registry
from tesselon.plans.spatial_queries import NN, PTS, points
from tesselon.session import materialize, table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

# events stand for transcripts: position from k and the user, gene from the type, count from the value; every third
# diagonal is background, cells are blocks of 5 x 7 pixels
DNB = "dnb AS (SELECT 'chip' AS scope, (props->>'$.k')::BIGINT AS px, user_id AS py, event_type AS gene, ceil(value)::BIGINT AS count FROM events)"
CELL = "CASE WHEN (px + py) % 3 <> 0 THEN (px // 5) * 100000 + py // 7 END"


def _transcripts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.lit("chip").alias("scope"), F.get_json_object("props", "$.k").cast("long").alias("px"), F.col("user_id").alias("py"), F.col("event_type").alias("gene"), F.ceil("value").alias("count"))


def _parts(spark, sf_dir):
    dnb = _transcripts(spark, sf_dir)
    label = (F.floor(F.col("px") / 5) * 100000 + F.floor(F.col("py") / 7)).alias("label")
    mask = dnb.select("scope", "px", "py").distinct().where("(px + py) % 3 <> 0").select("scope", "px", "py", label)
    return I.aggregate_by_mask(dnb, mask)


@R.query(f"WITH {DNB} SELECT {CELL} AS cell, gene, sum(count)::BIGINT AS count FROM dnb WHERE (px + py) % 3 <> 0 GROUP BY ALL")
def triplet_aggregate(spark, sf_dir):
    return _parts(spark, sf_dir)[0].select("cell", "gene", "count")


@R.query(f"WITH {DNB} SELECT gene, sum(count)::BIGINT AS count FROM dnb WHERE (px + py) % 3 = 0 GROUP BY ALL")
def extracellular_residue(spark, sf_dir):
    return _parts(spark, sf_dir)[1].select("gene", "count")


@R.query(f"WITH {DNB}, t AS (SELECT {CELL} AS cell, gene, sum(count)::BIGINT AS count FROM dnb WHERE (px + py) % 3 <> 0 GROUP BY ALL) SELECT cell, sum(count)::BIGINT AS n_transcripts, count(*) FILTER (count > 0) AS n_genes, coalesce(sum(count) FILTER (gene LIKE 'p%'), 0)::BIGINT AS n_taxa FROM t GROUP BY ALL")
def per_cell_totals(spark, sf_dir):
    """Totals of each cell; genes that start with p stand for taxa."""
    return I.cell_totals(_parts(spark, sf_dir)[0], "^p").drop("scope")


_PAIRS = "p AS (SELECT vec_id AS a, vec_id + 1 AS b FROM embeddings WHERE vec_id % 2 = 0 AND vec_id + 1 IN (SELECT vec_id FROM embeddings)), v AS (SELECT vec_id, i, embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) t(i)), j AS (SELECT a, b, x.i, x.value AS x, y.value AS y FROM p JOIN v x ON x.vec_id = a JOIN v y ON y.vec_id = b AND y.i = x.i)"


def _matched(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    long = M.long_matrix(vectors, "vec_id", "embedding")
    even = vectors.where("vec_id % 2 = 0").select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    pairs = even.join(vectors.select(F.col("vec_id").alias("b")), "b", "left_semi")
    return I.matched_correlation(pairs, long, long)


@R.query(f"WITH {_PAIRS} SELECT a, b, count(*) AS n, round(corr(x, y), 6) AS r FROM j GROUP BY ALL")
def pearson_pairs(spark, sf_dir):
    return rounded(_matched(spark, sf_dir)[0], "r").select("a", "b", "n", "r")


@R.query(f"WITH {_PAIRS} SELECT printf('f%02d', i - 1) AS feature, count(*) AS n, round(corr(x, y), 6) AS r FROM j GROUP BY ALL")
def pearson_features(spark, sf_dir):
    return rounded(_matched(spark, sf_dir)[1], "r")


_LAST = "m AS (SELECT sample_id AS scope, matrix FROM qupath_transforms WHERE matrix IS NOT NULL AND modality = 'comet' QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY transform_id DESC) = 1)"


@R.query(f"""WITH {PTS}, {_LAST}, w AS (SELECT scope, x, y, matrix[1][1] * x + matrix[1][2] * y + matrix[1][3] - x AS dx, matrix[2][1] * x + matrix[2][2] * y + matrix[2][3] - y AS dy FROM pts JOIN m USING (scope))
    SELECT scope, round(avg(dx), 4) AS mean_dx, round(avg(dy), 4) AS mean_dy, round(stddev_pop(dx), 4) AS std_dx, round(stddev_pop(dy), 4) AS std_dy, round(avg(sqrt(dx * dx + dy * dy)), 4) AS mean_shift, round(max(sqrt(dx * dx + dy * dy)), 4) AS max_shift FROM w GROUP BY ALL""")
def registration_quality(spark, sf_dir):
    latest = table(spark, sf_dir, "qupath_transforms").where("matrix is not null and modality = 'comet'").groupBy(F.col("sample_id").alias("scope")).agg(F.max_by("matrix", "transform_id").alias("m"))
    wx, wy = G.apply_affine(F.col("m"), F.col("x"), F.col("y"))
    moved = points(spark, sf_dir).join(latest, "scope").select("scope", "x", "y", wx.alias("wx"), wy.alias("wy"))
    out = I.displacement(moved, "scope")
    return rounded(out, *[c for c in out.columns if c != "scope"], digits=4)


@R.query(f"""WITH {NN}, c AS (SELECT scope, count(*) FILTER (id % 2 = 0) AS n_a, count(*) FILTER (id % 2 = 1) AS n_b FROM pts GROUP BY ALL), d AS (SELECT scope, quantile_cont(dist, 0.5) AS median FROM nn GROUP BY ALL)
    SELECT scope, n_a, n_b, round(median, 6) AS median, CASE WHEN 100.0 * abs(n_a - n_b) / greatest(n_a, n_b, 1) < 5 AND median < 10 THEN 'BOTH_EQUIVALENT' WHEN n_a > n_b THEN 'USE_TIF' ELSE 'USE_MLD' END AS advice FROM c JOIN d USING (scope)""")
def source_comparison(spark, sf_dir):
    p = materialize(points(spark, sf_dir))
    even, odd = p.where("id % 2 = 0"), p.where("id % 2 = 1")
    counts = p.groupBy("scope").agg(F.count_if(F.col("id") % 2 == 0).alias("n_a"), F.count_if(F.col("id") % 2 == 1).alias("n_b"))
    found = quantiles(materialize(N.nearest(even, odd).join(even.select(F.col("id").alias("left_id"), "scope"), "left_id")), ["scope"], median=("dist", 0.5))
    return rounded(counts.join(found, "scope").withColumn("advice", I.recommend(F.col("n_a"), F.col("n_b"), F.col("median"))), "median")


@R.query(f"""WITH {PTS}, w AS (SELECT scope, round(x / 600)::BIGINT AS cx, round(y / 600)::BIGINT AS cy, id FROM pts WHERE abs(x - round(x / 600) * 600) <= 200 AND abs(y - round(y / 600) * 600) <= 200),
    n AS (SELECT scope, cx, cy, count(*) FILTER (id % 2 = 0) AS n_one, count(*) FILTER (id % 2 = 1) AS n_two FROM w GROUP BY ALL) SELECT *, least(n_one, n_two) AS weight FROM n WHERE n_one > 20 AND n_two > 20""")
def dual_dense_windows(spark, sf_dir):
    p = points(spark, sf_dir)
    return I.dual_dense_windows(p.where("id % 2 = 0"), p.where("id % 2 = 1"), 200.0)


@R.query("""WITH c AS (SELECT DISTINCT ON (cell_uid) cell_uid, sample_id, protein_cd45::DOUBLE AS v FROM integrated_cells WHERE NOT isnan(protein_cd45)),
    b AS (SELECT sample_id, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.995) AS hi FROM c WHERE v > 0 GROUP BY ALL)
    SELECT cell_uid, round(CASE WHEN hi > lo THEN greatest(0, least(1, (v - lo) / (hi - lo))) ELSE 0 END, 6) AS stretched FROM c JOIN b USING (sample_id)""")
def intensity_stretch(spark, sf_dir):
    cells = table(spark, sf_dir, "integrated_cells").where("protein_cd45 is not null and not isnan(protein_cd45)").select("cell_uid", "sample_id", F.col("protein_cd45").cast("double").alias("v")).dropDuplicates(["cell_uid"])
    return rounded(I.stretch(cells, "v", "sample_id"), "stretched").select("cell_uid", "stretched")


@R.query("SELECT transform_id, modality, CASE lower(modality) WHEN 'msi_glycan' THEN 0.2 WHEN 'msi_metabolite' THEN 0.05 WHEN 'msi_peptide' THEN 0.2 ELSE 0.1 END::DOUBLE AS threshold FROM qupath_transforms")
def modality_thresholds(spark, sf_dir):
    kind = F.concat(F.regexp_replace("modality", "^msi_", ""), F.lit("s"))
    return table(spark, sf_dir, "qupath_transforms").select("transform_id", "modality", I.modality_threshold(kind).alias("threshold"))
