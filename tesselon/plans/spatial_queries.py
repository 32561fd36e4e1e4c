"""Spatial queries: nearest, range and containment joins, autocorrelation, affine geometry, density."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.functions import geometry as G
from tesselon.operators import nearest as N
from tesselon.operators.density import density_bins as bins_of
from tesselon.operators.density import dense_windows as windows_of
from tesselon.operators.stats import adjust, normal_p
from tesselon.plans.matrix_queries import rounded
from tesselon.plans.registry import Registry
from tesselon.session import clean, materialize, table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

PTS = "pts AS (SELECT DISTINCT cell_uid AS id, sample_id AS scope, spatial[1] AS x, spatial[2] AS y FROM integrated_cells WHERE spatial IS NOT NULL AND sample_id IS NOT NULL)"
D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"


def points(spark, sf_dir):
    """Cells with a position, once each."""
    at = F.col("spatial")
    return table(spark, sf_dir, "integrated_cells").select(F.col("cell_uid").alias("id"), F.col("sample_id").alias("scope"), F.get(at, F.lit(0)).alias("x"), F.get(at, F.lit(1)).alias("y")).na.drop().dropDuplicates(["id"])


def _halves(spark, sf_dir):
    """Even and odd cells stand for two segmentations of a sample."""
    p = points(spark, sf_dir)
    return p.where("id % 2 = 0"), p.where("id % 2 = 1")


NN = f"""{PTS}, nn AS (SELECT a.id AS left_id, b.id AS right_id, a.scope, sqrt({D2}) AS dist FROM pts a JOIN pts b ON a.scope = b.scope AND a.id % 2 = 0 AND b.id % 2 = 1
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY {D2}, b.id) = 1)"""


@R.query(f"WITH {NN} SELECT p.id AS left_id, right_id, round(dist, 6) AS dist, coalesce(dist <= 50, false) AS mapped FROM pts p LEFT JOIN nn ON p.id = left_id WHERE p.id % 2 = 0")
def nn_join_cap(spark, sf_dir):
    return rounded(N.map_to_nearest(*_halves(spark, sf_dir), 50.0), "dist")


@R.query(f"""WITH {NN}, back AS (SELECT a.id AS right_id, b.id AS left_id, sqrt({D2}) AS dist FROM pts a JOIN pts b ON a.scope = b.scope AND a.id % 2 = 1 AND b.id % 2 = 0
    QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY {D2}, b.id) = 1),
    l AS (SELECT left_id, right_id FROM nn WHERE dist <= 30), r AS (SELECT left_id, right_id FROM back WHERE dist <= 30), m AS (SELECT l.left_id, l.right_id FROM l JOIN r USING (left_id, right_id))
    SELECT 'left' AS side, id, CASE WHEN id IN (SELECT left_id FROM m) THEN '1to1' WHEN id IN (SELECT left_id FROM l) THEN 'merged' ELSE 'left_only' END AS class FROM pts WHERE id % 2 = 0
    UNION ALL SELECT 'right', id, CASE WHEN id IN (SELECT right_id FROM m) THEN '1to1' WHEN id IN (SELECT right_id FROM r) THEN 'fragmented' ELSE 'right_only' END FROM pts WHERE id % 2 = 1""")
def mutual_match_classes(spark, sf_dir):
    return N.match_classes(*_halves(spark, sf_dir), 30.0)


@R.query(f"""WITH {NN} SELECT scope, count(*) AS n, round(quantile_cont(dist, 0.5), 6) AS median_distance, round(avg(dist), 6) AS mean_distance, round(stddev_pop(dist), 6) AS std_distance,
    round(min(dist), 6) AS min_distance, round(max(dist), 6) AS max_distance, round(100.0 * count(*) FILTER (dist < 30) / count(*), 6) AS pct_within_30px, round(100.0 * count(*) FILTER (dist < 50) / count(*), 6) AS pct_within_50px,
    round(100.0 * count(*) FILTER (dist < 100) / count(*), 6) AS pct_within_100px,
    CASE WHEN quantile_cont(dist, 0.5) < 30 THEN 'EXCELLENT' WHEN quantile_cont(dist, 0.5) < 50 THEN 'GOOD' WHEN quantile_cont(dist, 0.5) < 100 THEN 'ACCEPTABLE' ELSE 'POOR' END AS quality FROM nn GROUP BY scope""")
def alignment_quality(spark, sf_dir):
    names = [f"{s}_distance" for s in ("median", "mean", "std", "min", "max")] + [f"pct_within_{t}px" for t in (30, 50, 100)]
    return rounded(N.alignment_metrics(*_halves(spark, sf_dir)), *names)


KNN = f"{PTS}, knn AS (SELECT a.id AS left_id, b.id AS right_id, a.scope, sqrt({D2}) AS dist, row_number() OVER (PARTITION BY a.id ORDER BY {D2}, b.id) AS rank FROM pts a JOIN pts b ON a.scope = b.scope AND a.id <> b.id QUALIFY rank <= 6)"


@R.query(f"WITH {KNN} SELECT left_id, rank::INT AS rank, right_id, round(dist, 6) AS dist FROM knn")
def knn_edges(spark, sf_dir):
    p = points(spark, sf_dir)
    return rounded(N.nearest(p, p, 6, same=True), "dist")


@R.query(f"WITH {PTS} SELECT a.id AS src, count(*) AS n, round(sum(CASE WHEN {D2} > 0 THEN 1 / sqrt({D2}) END), 6) AS weight FROM pts a JOIN pts b ON a.scope = b.scope AND a.id <> b.id AND {D2} <= 625 GROUP BY ALL")
def distance_band(spark, sf_dir):
    return rounded(N.distance_weights(points(spark, sf_dir), 25.0, binary=False).groupBy("src").agg(F.count("*").alias("n"), F.sum("w").alias("weight")), "weight")


def _measures(spark, sf_dir, measures=("protein_cd45", "protein_cd4", "protein_keratin8", "area_px")):
    cells = table(spark, sf_dir, "integrated_cells").select(F.col("cell_uid").alias("id"), F.col("sample_id").alias("scope"), "spatial", *[clean(c).alias(c) for c in measures]).where("spatial is not null").drop("spatial").dropDuplicates(["id"])
    return cells.unpivot(["id", "scope"], list(measures), "feature", "value")


MORAN = f"""{KNN}, wt AS (SELECT left_id AS src, right_id AS dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY left_id) AS w FROM knn),
    v0 AS (SELECT DISTINCT ON (cell_uid) cell_uid AS id, sample_id AS scope, protein_cd45::DOUBLE AS protein_cd45, protein_cd4::DOUBLE AS protein_cd4, protein_keratin8::DOUBLE AS protein_keratin8, area_px::DOUBLE AS area_px FROM integrated_cells WHERE spatial IS NOT NULL),
    v AS (SELECT id, scope, feature, value FROM (UNPIVOT v0 ON protein_cd45, protein_cd4, protein_keratin8, area_px INTO NAME feature VALUE value) WHERE value IS NOT NULL AND NOT isnan(value)),
    z AS (SELECT id, scope, feature, value - avg(value) OVER (PARTITION BY scope, feature) AS z FROM v), s AS (SELECT scope, feature, count(*) AS n, sum(z * z) AS zz FROM z GROUP BY ALL),
    ew AS (SELECT a.scope, a.feature, wt.src, wt.dst, wt.w, coalesce(r.w, 0) AS back, a.z AS z1, b.z AS z2 FROM wt LEFT JOIN wt r ON r.src = wt.dst AND r.dst = wt.src JOIN z a ON a.id = wt.src JOIN z b ON b.id = wt.dst AND b.feature = a.feature),
    x AS (SELECT scope, feature, sum(w * z1 * z2) AS wzz, sum(w) AS s0, sum(w * (w + back)) AS s1 FROM ew GROUP BY ALL),
    y AS (SELECT scope, feature, sum(w * w) AS s2 FROM (SELECT scope, feature, id, sum(w) AS w FROM (SELECT scope, feature, src AS id, w FROM ew UNION ALL SELECT scope, feature, dst, w FROM ew) GROUP BY ALL) GROUP BY ALL),
    i0 AS (SELECT *, CASE WHEN zz > 1e-12 AND s0 > 0 THEN n / s0 * wzz / zz END AS i, CASE WHEN n > 1 THEN -1.0::DOUBLE / (n - 1) END AS expected_i FROM s LEFT JOIN x USING (scope, feature) LEFT JOIN y USING (scope, feature)),
    i AS (SELECT *, (n::DOUBLE * n * s1 - n * s2 + 3 * s0 * s0) / ((n::DOUBLE * n - 1) * s0 * s0) - expected_i * expected_i AS var FROM i0)"""


@R.query(f"WITH {MORAN} SELECT scope, feature, n, round(i, 6) AS i, round(expected_i, 6) AS expected_i FROM i")
def morans_i(spark, sf_dir):
    return rounded(N.morans_i(_measures(spark, sf_dir), N.knn_weights(points(spark, sf_dir))).drop("z"), "i", "expected_i")


@R.query(f"WITH {MORAN} SELECT scope, feature, round(CASE WHEN var > 1e-15 THEN (i - expected_i) / sqrt(var) END, 5) AS z FROM i")
def morans_z(spark, sf_dir):
    """How far each autocorrelation lies from its expected value, in standard deviations."""
    return rounded(N.morans_i(_measures(spark, sf_dir), N.knn_weights(points(spark, sf_dir))).select("scope", "feature", "z"), "z", digits=5)


@R.query()
def morans_significance(spark, sf_dir):
    """The same with the two-sided p of a normal z and its false discovery rate within each sample."""
    found = N.morans_i(_measures(spark, sf_dir), N.knn_weights(points(spark, sf_dir)))
    return adjust(found.withColumn("p", normal_p(F.col("z"))), "p", "scope")


COHERENT = f"""{MORAN}, k AS (SELECT scope, feature FROM i WHERE i >= 0.05 AND var > 1e-15 AND (i - expected_i) / sqrt(var) > 1.6448536),
    vr AS (SELECT scope, feature, sum(z * z) / count(*) AS v FROM z WHERE scope NOT IN (SELECT scope FROM k) GROUP BY ALL), most AS (SELECT scope, feature FROM vr QUALIFY row_number() OVER (PARTITION BY scope ORDER BY v DESC, feature) = 1)"""


@R.query(f"WITH {COHERENT} SELECT *, 'coherent' AS why FROM k UNION ALL SELECT *, 'variance' FROM most")
def coherent_features(spark, sf_dir):
    """Features of each sample whose autocorrelation reaches a threshold and isn't chance (one-sided p below 0.05); for a
    sample without any the feature of the largest variance."""
    values = materialize(_measures(spark, sf_dir))
    found = N.morans_i(values, N.knn_weights(points(spark, sf_dir)))
    kept = materialize(found.where("i >= 0.05 and z > 1.6448536").select("scope", "feature", F.lit("coherent").alias("why")))
    spread = values.where("value is not null").groupBy("scope", "feature").agg(F.var_pop("value").alias("v")).join(kept.select("scope").distinct(), "scope", "left_anti")
    most = spread.groupBy("scope").agg(F.min_by("feature", F.struct((-F.col("v")).alias("v"), "feature")).alias("feature")).select("scope", "feature", F.lit("variance").alias("why"))
    return kept.unionByName(most)


TR = "t AS (SELECT transform_id, matrix[1][1] AS a, matrix[1][2] AS b, matrix[1][3] AS tx, matrix[2][1] AS c, matrix[2][2] AS d, matrix[2][3] AS ty FROM (SELECT DISTINCT ON (transform_id) * FROM qupath_transforms WHERE matrix IS NOT NULL))"


def _transforms(spark, sf_dir):
    return table(spark, sf_dir, "qupath_transforms").where("matrix is not null").select("transform_id", "sample_id", "modality", "matrix").dropDuplicates(["transform_id"])


def _entries(m):
    return [(F.round(G.coefficient(m, r, c), 6) + F.lit(0.0)).alias(n) for r, c, n in ((0, 0, "a"), (0, 1, "b"), (0, 2, "tx"), (1, 0, "c"), (1, 1, "d"), (1, 2, "ty"))]


@R.query(f"WITH {TR} SELECT transform_id, round(d / det, 6) + 0 AS a, round(-b / det, 6) + 0 AS b, round((b * ty - d * tx) / det, 6) + 0 AS tx, round(-c / det, 6) + 0 AS c, round(a / det, 6) + 0 AS d, round((c * tx - a * ty) / det, 6) + 0 AS ty FROM (SELECT *, a * d - b * c AS det FROM t) WHERE abs(det) >= 1e-12")
def affine_inverse(spark, sf_dir):
    return _transforms(spark, sf_dir).withColumn("inv", G.invert_affine(F.col("matrix"))).where("inv is not null").select("transform_id", *_entries(F.col("inv")))


@R.query(f"""WITH {TR} SELECT transform_id, round(sqrt(a * a + c * c), 6) AS scale_x, round(sqrt(b * b + d * d), 6) AS scale_y, round(degrees(atan2(c, a)), 5) + 0 AS turn, round(sqrt(tx * tx + ty * ty), 6) AS shift,
    a * d - b * c < 0 AS mirrored FROM t""")
def affine_parts(spark, sf_dir):
    """Scales, turn in degrees, length of the shift and handedness of each transform."""
    parts = G.affine_parts(F.col("matrix"))
    return rounded(_transforms(spark, sf_dir).select("transform_id", *[c.alias(n) for n, c in parts.items()]).withColumn("turn", F.round("turn", 5) + F.lit(0.0)), "scale_x", "scale_y", "shift")


@R.query(f"WITH {TR} SELECT transform_id, round(a * a + b * c, 6) + 0 AS a, round(a * b + b * d, 6) + 0 AS b, round(a * tx + b * ty + tx, 6) + 0 AS tx, round(c * a + d * c, 6) + 0 AS c, round(c * b + d * d, 6) + 0 AS d, round(c * tx + d * ty + ty, 6) + 0 AS ty FROM t")
def affine_compose(spark, sf_dir):
    return _transforms(spark, sf_dir).select("transform_id", *_entries(G.compose_affine(F.col("matrix"), F.col("matrix"))))


@R.query(f"""WITH {PTS}, m AS (SELECT sample_id AS scope, modality, matrix FROM qupath_transforms WHERE matrix IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sample_id, modality ORDER BY transform_id DESC) = 1)
    SELECT id, modality, matrix[1][1] * x + matrix[1][2] * y + matrix[1][3] AS wx, matrix[2][1] * x + matrix[2][2] * y + matrix[2][3] AS wy FROM pts JOIN m USING (scope)""")
def affine_apply(spark, sf_dir):
    """Cells in the frame of every modality of their sample, by its last transform."""
    latest = table(spark, sf_dir, "qupath_transforms").where("matrix is not null").groupBy(F.col("sample_id").alias("scope"), "modality").agg(F.max_by("matrix", "transform_id").alias("m"))
    wx, wy = G.apply_affine(F.col("m"), F.col("x"), F.col("y"))
    return points(spark, sf_dir).join(latest, "scope").select("id", "modality", wx.alias("wx"), wy.alias("wy"))


RINGS = """g AS (SELECT region_id, coordinates[1] AS r FROM roi_regions WHERE len(coordinates) > 0 AND len(coordinates[1]) > 2),
    o AS (SELECT region_id, CASE WHEN r[1] = r[-1] THEN r[:-2] ELSE r END AS r FROM g), k AS (SELECT region_id, r, list_append(r, r[1]) AS c FROM o)"""


@R.query(f"""WITH {RINGS} SELECT region_id, len(r) AS n_vertices, round(list_avg(list_transform(r, lambda p: p[1])), 6) AS cx, round(list_avg(list_transform(r, lambda p: p[2])), 6) AS cy,
    round(list_sum(list_transform(range(1, len(c)), lambda i: c[i][1] * c[i + 1][2] - c[i + 1][1] * c[i][2])) / 2, 6) AS area, list_min(list_transform(r, lambda p: p[1])) AS x0, list_max(list_transform(r, lambda p: p[2])) AS y1 FROM k""")
def ring_measures(spark, sf_dir):
    ring = F.get(F.col("coordinates"), F.lit(0))
    rows = table(spark, sf_dir, "roi_regions").where(F.size(ring) > 2).select("region_id", G.open_ring(ring).alias("o"), G.close_ring(ring).alias("c"))
    cx, cy = G.vertex_centroid(F.col("c"))
    x0, _, _, y1 = G.bounding_box(F.col("o"))
    return rows.select("region_id", F.size("o").cast("long").alias("n_vertices"), F.round(cx, 6).alias("cx"), F.round(cy, 6).alias("cy"), F.round(G.signed_area(F.col("c")), 6).alias("area"), x0.alias("x0"), y1.alias("y1"))


BINS = f"b AS (SELECT sample_id AS scope, floor(spatial[1] / 200)::BIGINT AS bx, floor(spatial[2] / 200)::BIGINT AS by, sum(greatest(coalesce(n_transcripts, 0), 0))::DOUBLE AS weight, count(*) AS n FROM (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells WHERE spatial IS NOT NULL) GROUP BY ALL)"


def _weighted(spark, sf_dir):
    return table(spark, sf_dir, "integrated_cells").where("spatial is not null").select("cell_uid", F.col("sample_id").alias("scope"), F.get("spatial", F.lit(0)).alias("x"), F.get("spatial", F.lit(1)).alias("y"), F.greatest(F.coalesce(F.col("n_transcripts"), F.lit(0)), F.lit(0)).cast("double").alias("weight")).dropDuplicates(["cell_uid"])


@R.query(f"WITH {BINS} SELECT * FROM b")
def density_bins(spark, sf_dir):
    return bins_of(_weighted(spark, sf_dir), 200.0)


@R.query()
def dense_windows(spark, sf_dir):
    """Up to four windows of the densest bins of each sample, kept apart from one another."""
    return windows_of(bins_of(_weighted(spark, sf_dir), 200.0), 200.0, 500.0, 4)
