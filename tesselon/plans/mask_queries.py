"""Region queries: containment, rasters, lookups, overlap, phenotype rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.operators import masks as K
from tesselon.operators.proximity import cover_regions, inside_regions
from tesselon.plans.matrix_queries import rounded
from tesselon.plans.registry import Registry
from tesselon.plans.spatial_queries import points
from tesselon.session import clean, materialize, table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

STEP = 1.0

EDGES = """rg AS (SELECT region_id, sample_id AS scope, roi_class, unnest(coordinates) AS r, generate_subscripts(coordinates, 1) AS k FROM roi_regions
      WHERE coordinates IS NOT NULL AND sample_id IS NOT NULL AND len(list_distinct(coordinates[1])) >= 3),
    cl AS (SELECT *, CASE WHEN r[1] = r[-1] THEN r ELSE list_append(r, r[1]) END AS c FROM rg WHERE len(r) > 0),
    ed AS (SELECT region_id, k, c[i][1] AS ax, c[i][2] AS ay, c[i + 1][1] AS qx, c[i + 1][2] AS qy FROM cl, range(1, 500) t(i) WHERE i < len(c))"""


def _inside(candidates: str) -> str:
    """CTE ``ins(region_id, id)`` from a query of region_id, id, x, y."""
    return f"""cand AS ({candidates}),
    tests AS (SELECT region_id, id, k, sum(CASE WHEN (ay > y) <> (qy > y) AND CASE WHEN qy > ay THEN t > 0 ELSE t < 0 END THEN 1 ELSE 0 END) % 2 AS odd,
      bool_or(t = 0 AND x BETWEEN least(ax, qx) AND greatest(ax, qx) AND y BETWEEN least(ay, qy) AND greatest(ay, qy)) AS on_it
      FROM (SELECT *, (qx - ax) * (y - ay) - (qy - ay) * (x - ax) AS t FROM cand JOIN ed USING (region_id)) GROUP BY ALL),
    ins AS (SELECT region_id, id FROM tests GROUP BY ALL HAVING bool_or(k = 1 AND odd = 1 AND NOT on_it) AND NOT bool_or(k > 1 AND (odd = 1 OR on_it)))"""


CELL_IN = _inside("SELECT g.region_id, c.cell_uid AS id, spatial[1] AS x, spatial[2] AS y FROM (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells WHERE spatial IS NOT NULL) c JOIN (SELECT DISTINCT region_id, scope FROM rg) g ON g.scope = c.sample_id")


@R.query(f"""WITH {EDGES}, {CELL_IN} SELECT g.region_id, count(c.cell_uid) AS n_cells, round(coalesce(avg(c.area_px), 0), 6) AS mean_area, round(coalesce(avg(c.n_transcripts), 0), 6) AS mean_transcripts
    FROM (SELECT DISTINCT region_id FROM rg) g LEFT JOIN ins USING (region_id) LEFT JOIN (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells WHERE spatial IS NOT NULL) c ON c.cell_uid = ins.id GROUP BY ALL""")
def region_means(spark, sf_dir):
    """Cells strictly inside each region and their mean measures; 0 for regions without cells."""
    regions = table(spark, sf_dir, "roi_regions")
    inside = inside_regions(points(spark, sf_dir), materialize(cover_regions(regions, "region_id", "sample_id", "coordinates")))
    cells = table(spark, sf_dir, "integrated_cells").select(F.col("cell_uid").alias("id"), clean("area_px").alias("a"), clean("n_transcripts").alias("t")).dropDuplicates(["id"])
    means = inside.join(cells, "id").groupBy("region_id").agg(F.count("*").alias("n_cells"), F.avg("a").alias("mean_area"), F.avg("t").alias("mean_transcripts"))
    out = K.usable_regions(regions, "region_id", "sample_id", "coordinates").select("region_id").distinct().join(means, "region_id", "left")
    return rounded(out.na.fill(0, subset=["n_cells", "mean_area", "mean_transcripts"]), "mean_area", "mean_transcripts")


PIXELS = _inside(f"""SELECT region_id, (px * 4294967296 + (py + 1000000000)) AS id, (px + 0.5) * {STEP} AS x, (py + 0.5) * {STEP} AS y FROM
    (SELECT region_id, unnest(range(floor(list_min(list_transform(r, lambda p: p[1])) / {STEP})::BIGINT, floor(list_max(list_transform(r, lambda p: p[1])) / {STEP})::BIGINT + 1)) AS px FROM rg WHERE k = 1) across
    JOIN (SELECT region_id, unnest(range(floor(list_min(list_transform(r, lambda p: p[2])) / {STEP})::BIGINT, floor(list_max(list_transform(r, lambda p: p[2])) / {STEP})::BIGINT + 1)) AS py FROM rg WHERE k = 1) down USING (region_id)""")
RASTER = f"""{EDGES}, {PIXELS}, mask AS (SELECT scope, floor(id / 4294967296.0)::BIGINT AS px, id - floor(id / 4294967296.0)::BIGINT * 4294967296 - 1000000000 AS py, arg_max(roi_class, (coalesce(list_position(['Other ROI', 'TME ROI', 'Tumor ROI', 'Vessels ROI'], roi_class), 0)::BIGINT << 40) + region_id) AS label
    FROM ins JOIN (SELECT DISTINCT region_id, scope, roi_class FROM rg WHERE roi_class IS NOT NULL) USING (region_id) GROUP BY ALL)"""


def _mask(spark, sf_dir, only: str | None = None):
    regions = table(spark, sf_dir, "roi_regions").where("roi_class is not null")
    if only:
        regions = regions.where(F.col("roi_class") == only)
    return K.rasterize(K.usable_regions(regions, "region_id", "sample_id", "coordinates", "roi_class"), "roi_class", K.roi_priority("roi_class"), STEP)


@R.query(f"""WITH {RASTER}, g AS (SELECT *, px - row_number() OVER (PARTITION BY scope, py, label ORDER BY px) AS run FROM mask)
    SELECT scope, py, min(px)::BIGINT AS start, max(px)::BIGINT + 1 AS stop, label FROM g GROUP BY scope, py, label, run""")
def roi_raster(spark, sf_dir):
    """The mask of all regions at full resolution, as runs of pixels."""
    return _mask(spark, sf_dir).select("scope", "py", "start", "stop", "label")


LOOKUP = f"""{RASTER}, places AS (SELECT cell_uid, sample_id AS scope, greatest(coalesce(n_transcripts, 0), 0) AS t, floor(spatial[1] / {STEP})::BIGINT AS px, floor(spatial[2] / {STEP})::BIGINT AS py
    FROM (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells WHERE spatial IS NOT NULL)), found AS (SELECT places.*, coalesce(label, 'Outside ROI') AS label FROM places LEFT JOIN mask USING (scope, px, py))"""


def _lookup(spark, sf_dir):
    at = F.col("spatial")
    cells = table(spark, sf_dir, "integrated_cells").where("spatial is not null").select("cell_uid", F.col("sample_id").alias("scope"), F.get(at, F.lit(0)).alias("x"), F.get(at, F.lit(1)).alias("y"), F.greatest(F.coalesce(F.col("n_transcripts"), F.lit(0)), F.lit(0)).alias("t")).dropDuplicates(["cell_uid"])
    return K.mask_lookup(cells, _mask(spark, sf_dir), STEP, "Outside ROI")


@R.query(f"WITH {LOOKUP} SELECT cell_uid, label FROM found")
def mask_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir).select("cell_uid", "label")


@R.query(f"WITH {LOOKUP} SELECT scope, label, count(*) AS n_cells, sum(t)::DOUBLE AS transcripts FROM found GROUP BY ALL")
def transcripts_by_roi(spark, sf_dir):
    """Cells and transcripts in each class and outside of all, by sample; together they are the sample's total."""
    return _lookup(spark, sf_dir).groupBy("scope", "label").agg(F.count("*").alias("n_cells"), F.sum("t").cast("double").alias("transcripts"))


@R.query(f"""WITH {RASTER.replace("WHERE roi_class IS NOT NULL", "WHERE roi_class IN ('Tumor ROI', 'TME ROI')")}, m2 AS (SELECT DISTINCT scope, floor(id / 4294967296.0)::BIGINT AS px, id - floor(id / 4294967296.0)::BIGINT * 4294967296 AS py, roi_class FROM ins JOIN (SELECT DISTINCT region_id, scope, roi_class FROM rg) USING (region_id)),
    j AS (SELECT scope, px, py, bool_or(roi_class = 'Tumor ROI') AS a, bool_or(roi_class = 'TME ROI') AS b FROM m2 WHERE roi_class IN ('Tumor ROI', 'TME ROI') GROUP BY ALL)
    SELECT scope, count(*) FILTER (a) AS n_one, count(*) FILTER (b) AS n_two, count(*) FILTER (a AND b) AS n_both, count(*) AS n_any, round(count(*) FILTER (a AND b) / count(*), 6) AS jaccard FROM j GROUP BY ALL""")
def mask_jaccard(spark, sf_dir):
    return rounded(K.mask_overlap(_mask(spark, sf_dir, "Tumor ROI"), _mask(spark, sf_dir, "TME ROI")), "jaccard")


@R.query(f"""WITH {RASTER} SELECT m.scope, m.px, m.py, m.label FROM mask m LEFT JOIN mask l ON l.scope = m.scope AND l.px = m.px - 1 AND l.py = m.py LEFT JOIN mask u ON u.scope = m.scope AND u.px = m.px AND u.py = m.py - 1
    WHERE l.label IS DISTINCT FROM m.label OR u.label IS DISTINCT FROM m.label""")
def mask_edges(spark, sf_dir):
    return K.mask_edges(materialize(_mask(spark, sf_dir)))


MARKERS = {"CD45": "protein_cd45", "CD4": "protein_cd4", "FOXP3": "protein_foxp3", "CD8": "protein_cd8", "CD68": "protein_cd68", "KERATIN8": "protein_keratin8"}
_POS = {m: f"coalesce({c} >= cut_{c}, false)" for m, c in MARKERS.items()}


@R.query(f"""WITH c AS (SELECT DISTINCT ON (cell_uid) cell_uid, sample_id, {", ".join(f"CASE WHEN NOT isnan({c}) THEN {c}::DOUBLE END AS {c}" for c in MARKERS.values())} FROM integrated_cells),
    q AS (SELECT sample_id, {", ".join(f"quantile_cont({c}, 0.75) AS cut_{c}" for c in MARKERS.values())} FROM c GROUP BY ALL)
    SELECT cell_uid, CASE WHEN {_POS["CD45"]} AND {_POS["CD4"]} AND {_POS["FOXP3"]} THEN 'Treg' WHEN {_POS["CD45"]} AND {_POS["CD4"]} AND NOT {_POS["FOXP3"]} THEN 'CD4+ T cell' WHEN {_POS["CD45"]} AND {_POS["CD8"]} THEN 'CD8+ T cell'
      WHEN {_POS["CD45"]} AND {_POS["CD68"]} THEN 'Macrophage' WHEN {_POS["CD45"]} THEN 'Immune (other)' WHEN {_POS["KERATIN8"]} AND NOT {_POS["CD45"]} THEN 'Epithelial' ELSE 'Unclassified' END AS called FROM c JOIN q USING (sample_id)""")
def phenotype_rules(spark, sf_dir):
    cells = table(spark, sf_dir, "integrated_cells").select("cell_uid", "sample_id", *MARKERS.values()).dropDuplicates(["cell_uid"])
    return K.phenotypes(cells, "sample_id", MARKERS).select("cell_uid", "called")
