"""Profiles, selections, annotation, vector aggregation, crops, warps and mask areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.operators import audit as A
from tesselon.functions import geometry as G
from tesselon.operators import integrate as I
from tesselon.operators import learn as L
from tesselon.operators import masks as K
from tesselon.operators import nearest as N
from tesselon.operators import stats as S
from tesselon.operators import tables as T
from tesselon.operators.density import smooth
from tesselon.operators.proximity import cover_regions, inside_regions
from tesselon.plans.mask_queries import CELL_IN, EDGES, RASTER, _mask
from tesselon.plans.matrix_queries import C, expressed, rounded
from tesselon.plans.registry import Registry
from tesselon.plans.spatial_queries import BINS, D2, KNN, PTS, points
from tesselon.plans.spatial_queries import density_bins as binned
from tesselon.session import clean, materialize, table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

CELLS = "(SELECT DISTINCT ON (cell_uid) * FROM integrated_cells)"


def _cells(spark, sf_dir, *columns):
    return table(spark, sf_dir, "integrated_cells").select("cell_uid", *columns).dropDuplicates(["cell_uid"])


PROFILED = ("phenotype", "comet_phenotype", "disease", "roi_class", "within_threshold", "sample_id", "n_genes")


@R.query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", sum(t)::BIGINT AS n, coalesce(sum(t) FILTER (v IS NULL), 0)::BIGINT AS n_null, count(v) AS n_distinct, arg_min(v, (-t, v)) FILTER (v IS NOT NULL) AS top, max(t) FILTER (v IS NOT NULL) AS top_n
    FROM (SELECT {c}::VARCHAR AS v, count(*) AS t FROM integrated_cells GROUP BY ALL)""" for c in PROFILED))
def unique_values(spark, sf_dir):
    """Rows, nulls, different values and the most frequent one of each column."""
    return T.value_profile(table(spark, sf_dir, "integrated_cells"), PROFILED)


@R.query("SELECT disease, min(mapped_at) AS mapped_at, arg_min(mapping_id, (mapped_at, mapping_id)) AS mapping_id FROM sample_mapping WHERE disease IS NOT NULL AND mapped_at IS NOT NULL GROUP BY ALL")
def first_seen_diseases(spark, sf_dir):
    """Diseases in the order they first come up."""
    found = T.first_seen(table(spark, sf_dir, "sample_mapping").where("mapped_at is not null"), "disease", "mapped_at", "mapping_id")
    return found.select("disease", "first.mapped_at", "first.mapping_id")


@R.query("SELECT sample_id, cell_uid FROM (SELECT DISTINCT sample_id, cell_uid FROM integrated_cells WHERE sample_id IS NOT NULL) QUALIFY (row_number() OVER (PARTITION BY sample_id ORDER BY cell_uid) - 1) % 7 = 0")
def every_seventh_cell(spark, sf_dir):
    """Every seventh cell of a sample in order of its id, for drawing."""
    return T.every_nth(table(spark, sf_dir, "integrated_cells"), "sample_id", "cell_uid", 7)


@R.query(f"WITH {C}, v AS (SELECT feature, var_pop(value) AS v FROM c GROUP BY ALL) SELECT feature, round(v / sum(v) OVER (), 6) AS share, round(sum(v) OVER (ORDER BY v DESC, feature) / sum(v) OVER (), 6) AS cumulative FROM v")
def cumulative_variance(spark, sf_dir):
    scores = expressed(spark, sf_dir).groupBy("feature").agg(F.var_pop("value").alias("v"))
    return rounded(T.cumulative_share(scores, "feature", "v"), "share", "cumulative")


@R.query(f"""WITH {C}, w AS (SELECT unnest(['f00', 'f05', 'f31', 'f32', 'f99']) AS feature), n AS (SELECT feature, count(value) AS n FROM c GROUP BY ALL)
    SELECT feature, n IS NOT NULL AS present, coalesce(n, 0) AS n FROM w LEFT JOIN n USING (feature)""")
def feature_subset(spark, sf_dir):
    """Features asked for by hand: which the matrix has, and with how many values."""
    return T.feature_report(expressed(spark, sf_dir), ["f00", "f05", "f31", "f32", "f99"])


@R.query(f"""WITH c AS (SELECT cell_uid, sample_id, CASE WHEN NOT isnan(protein_keratin8) THEN protein_keratin8::DOUBLE END AS v FROM {CELLS} WHERE sample_id IS NOT NULL),
    b AS (SELECT sample_id, min(v) AS lo, max(v) AS hi FROM c GROUP BY ALL)
    SELECT cell_uid, CASE WHEN v IS NOT NULL THEN CASE WHEN hi > lo THEN floor(255 * (v - lo) / (hi - lo)) ELSE 0 END END::INT AS level FROM c JOIN b USING (sample_id)""")
def byte_levels(spark, sf_dir):
    """A protein as 0 to 255 between its extremes in a sample."""
    cells = _cells(spark, sf_dir, "sample_id", clean("protein_keratin8").alias("v")).where("sample_id is not null")
    return T.to_bytes(cells, "v", "sample_id").select("cell_uid", "level")


@R.query(f"""WITH {C}, a AS (SELECT obs FROM c GROUP BY obs HAVING count(*) FILTER (value > 0) >= 12), k AS (SELECT c.* FROM c SEMI JOIN a USING (obs)),
    f AS (SELECT feature FROM k GROUP BY feature HAVING count(*) FILTER (value > 0) >= 5000), s AS (SELECT sample_id FROM k GROUP BY sample_id HAVING count(DISTINCT obs) >= 200)
    SELECT sample_id, count(DISTINCT obs) AS n_cells, count(DISTINCT feature) AS n_features, round(sum(value), 4) AS total FROM k SEMI JOIN f USING (feature) SEMI JOIN s USING (sample_id) GROUP BY ALL""")
def filter_chain(spark, sf_dir):
    """Cells, features and total of each sample that stays after the filters on cells, features and sample size."""
    kept = T.cell_chain(expressed(spark, sf_dir, ("sample_id",)), "sample_id", 12, 5_000, 200)
    return rounded(kept.groupBy("sample_id").agg(F.countDistinct("obs").alias("n_cells"), F.countDistinct("feature").alias("n_features"), F.sum("value").alias("total")), "total", digits=4)


@R.query("""WITH e AS (SELECT sample_id, modality FROM (SELECT DISTINCT sample_id FROM sample_registry WHERE sample_id IS NOT NULL), (SELECT DISTINCT modality FROM qupath_transforms WHERE modality IS NOT NULL)),
    n AS (SELECT sample_id, modality, count(*) AS n FROM qupath_transforms GROUP BY ALL) SELECT sample_id, modality, coalesce(n, 0) AS n_rows, CASE WHEN n > 0 THEN 'present' ELSE 'missing' END AS status FROM e LEFT JOIN n USING (sample_id, modality)""")
def transform_status(spark, sf_dir):
    """For every registered sample and modality whether there is a transform; modalities are those that occur, a few."""
    transforms = table(spark, sf_dir, "qupath_transforms")
    kinds = [r[0] for r in transforms.where("modality is not null").select("modality").distinct().collect()]
    samples = table(spark, sf_dir, "sample_registry").where("sample_id is not null").select("sample_id").distinct()
    expected = samples.withColumn("modality", F.explode(F.array(*[F.lit(k) for k in sorted(kinds)])))
    return T.status_table(expected, transforms, ["sample_id", "modality"])


@R.query(f"""SELECT sample_id, phenotype, count(*) AS n, round(avg(CASE WHEN NOT isnan(protein_cd45) THEN protein_cd45::DOUBLE END), 6) AS mean_protein_cd45, round(avg(CASE WHEN NOT isnan(protein_cd8) THEN protein_cd8::DOUBLE END), 6) AS mean_protein_cd8,
    round(avg(area_px::DOUBLE), 6) AS mean_area_px FROM {CELLS} WHERE sample_id IS NOT NULL AND phenotype IS NOT NULL GROUP BY ALL""")
def label_channel_means(spark, sf_dir):
    """Mean of each channel within a label."""
    columns = ["protein_cd45", "protein_cd8", "area_px"]
    return rounded(T.label_means(_cells(spark, sf_dir, "sample_id", "phenotype", *columns), ["sample_id", "phenotype"], columns), *[f"mean_{c}" for c in columns])


@R.query(f"""WITH {C}, k AS (SELECT phenotype, disease FROM cells WHERE phenotype IS NOT NULL AND disease IS NOT NULL GROUP BY ALL HAVING count(*) >= 50),
    r AS (SELECT phenotype, disease, feature, value FROM c JOIN k USING (phenotype, disease) WHERE value IS NOT NULL AND NOT isnan(value)),
    g AS (SELECT phenotype, disease, feature, count(*)::DOUBLE AS n, avg(value) AS m, var_samp(value) AS v FROM r GROUP BY ALL),
    o AS (SELECT g.phenotype, g.disease, g.feature, count(*)::DOUBLE AS n, avg(r.value) AS m, var_samp(r.value) AS v FROM g JOIN r ON r.phenotype = g.phenotype AND r.feature = g.feature AND r.disease <> g.disease GROUP BY ALL)
    SELECT phenotype, disease, feature, round((g.m - o.m) / sqrt(g.v / g.n + o.v / o.n), 5) AS t FROM g JOIN o USING (phenotype, disease, feature)""")
def stratified_welch_t(spark, sf_dir):
    """Each disease against the others within a phenotype, by feature."""
    long = expressed(spark, sf_dir, ("phenotype", "disease")).where("phenotype is not null and disease is not null")
    return rounded(T.welch_t(long, "phenotype", "disease"), "t", digits=5)


PROTEINS, COUNTS = ["protein_cd45", "protein_cd4", "protein_cd8", "protein_keratin8"], ["n_transcripts", "n_genes", "area_px"]


@R.query("WITH r AS (" + " UNION ALL ".join(f"SELECT '{a}' AS one, '{b}' AS two, {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM {CELLS} WHERE {a} IS NOT NULL AND NOT isnan({a}) AND {b} IS NOT NULL" for a in PROTEINS for b in COUNTS) + """),
    k AS (SELECT one, two, rank() OVER (PARTITION BY one, two ORDER BY x) + (count(*) OVER (PARTITION BY one, two, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY one, two ORDER BY y) + (count(*) OVER (PARTITION BY one, two, y) - 1) / 2.0 AS ry FROM r)
    SELECT one, two, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM k GROUP BY ALL HAVING count(*) >= 10""")
def spearman_map(spark, sf_dir):
    """Rank correlation of every protein with every count."""
    return rounded(S.spearman_map(_cells(spark, sf_dir, *PROTEINS, *COUNTS), PROTEINS, COUNTS, "cell_uid"), "rho")


@R.query(f"""WITH {PTS}, near AS (SELECT a.id AS left_id, b.id AS right_id, {D2} AS d2 FROM pts a JOIN pts b ON a.scope = b.scope AND a.id % 2 = 0 AND b.id % 2 = 1 AND {D2} <= 900 QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY {D2}, b.id) = 1),
    v AS (SELECT cell_uid AS right_id, x FROM {CELLS} WHERE x IS NOT NULL)
    SELECT p.id AS left_id, right_id, coalesce(len(v.x), 32)::INT AS width, round(coalesce(list_sum(v.x::DOUBLE[]), 0), 5) + 0 AS total FROM pts p LEFT JOIN near ON near.left_id = p.id LEFT JOIN v USING (right_id) WHERE p.id % 2 = 0""")
def nearest_expression(spark, sf_dir):
    """For even cells the expression of the nearest odd cell within 30 px, zeros beyond."""
    p = materialize(points(spark, sf_dir))
    vectors = _cells(spark, sf_dir, "x").where("x is not null").select(F.col("cell_uid").alias("id"), F.transform("x", lambda v: v.cast("double")).alias("vector"))
    found = N.nearest_vectors(p.where("id % 2 = 0"), p.where("id % 2 = 1"), vectors, 30.0)
    return found.select("left_id", "right_id", F.size("vector").alias("width"), (F.round(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v), 5) + 0.0).alias("total"))


@R.query(f"""WITH {EDGES}, {CELL_IN}, l AS (SELECT cell_uid AS id, printf('f%02d', i - 1) AS feature, x[i]::DOUBLE AS value FROM {CELLS} WHERE x IS NOT NULL, range(1, 33) t(i))
    SELECT region_id, feature, count(*) AS n_cells, round(avg(value), 6) + 0 AS mean FROM ins JOIN l USING (id) GROUP BY ALL""".replace("FROM (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells) WHERE x IS NOT NULL, range(1, 33) t(i))", "FROM (SELECT DISTINCT ON (cell_uid) * FROM integrated_cells) s, range(1, 33) t(i) WHERE x IS NOT NULL)"))
def region_expression(spark, sf_dir):
    """Mean expression vector of the cells strictly inside each region, in long form."""
    inside = inside_regions(points(spark, sf_dir), materialize(cover_regions(table(spark, sf_dir, "roi_regions"), "region_id", "sample_id", "coordinates")))
    long = expressed(spark, sf_dir).withColumnRenamed("obs", "id")
    means = inside.join(long, "id").groupBy("region_id", "feature").agg(F.count("*").alias("n_cells"), F.avg("value").alias("mean"))
    return means.withColumn("mean", F.round("mean", 6) + 0.0)  # no negative zero


@R.query(f"""WITH c AS (SELECT DISTINCT ON (cell_uid) cell_uid AS id, sample_id AS scope, spatial[1] AS x, spatial[2] AS y, CASE WHEN cell_uid % 5 <> 0 THEN phenotype END AS label FROM integrated_cells WHERE spatial IS NOT NULL AND sample_id IS NOT NULL),
    near AS (SELECT a.id, b.label FROM c a JOIN c b ON a.scope = b.scope AND a.label IS NULL AND b.label IS NOT NULL AND {D2} <= 900 QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY {D2}, b.id) = 1)
    SELECT c.id, coalesce(c.label, near.label) AS label, CASE WHEN c.label IS NOT NULL THEN 'own' WHEN near.label IS NOT NULL THEN 'nearest' END AS source FROM c LEFT JOIN near USING (id)""")
def phenotype_annotation(spark, sf_dir):
    """Every fifth cell counts as not annotated and takes the phenotype of the nearest annotated cell within 30 px."""
    names = _cells(spark, sf_dir, F.when(F.col("cell_uid") % 5 != 0, F.col("phenotype")).alias("label")).withColumnRenamed("cell_uid", "id")
    p = materialize(points(spark, sf_dir).join(names, "id"))
    return N.annotate(p, p, "label", 30.0)


IMMUNE = ("Treg", "CD4+ T cell", "CD8+ T cell", "M2 Macrophage", "Macrophage", "B cell", "NK cell", "DC", "Neutrophil", "Immune (other)")  # fixed values


@R.query(f"""SELECT sample_id, CASE WHEN phenotype IN {IMMUNE} THEN 'immune' WHEN phenotype IS NULL THEN 'unknown' ELSE 'other' END AS compartment, count(*) AS n FROM {CELLS} GROUP BY ALL""")
def immune_compartments(spark, sf_dir):
    """Cells of each sample by immune, other or unknown phenotype."""
    kind = T.pick([(F.col("phenotype").isin(*IMMUNE), "immune"), (F.col("phenotype").isNull(), "unknown")], "other")
    return _cells(spark, sf_dir, "sample_id", "phenotype").groupBy("sample_id", kind.alias("compartment")).agg(F.count("*").alias("n"))


WINDOW = "w AS (SELECT scope, floor(min(x)) + 100 AS x0, floor(min(y)) + 100 AS y0, floor(min(x)) + 700 AS x1, floor(min(y)) + 700 AS y1 FROM pts GROUP BY ALL)"


def _windows(p):
    corner = lambda c: F.floor(F.min(c)).cast("double") + 100
    return p.groupBy("scope").agg(corner("x").alias("x0"), corner("y").alias("y0")).withColumns({"x1": F.col("x0") + 600, "y1": F.col("y0") + 600})


@R.query(f"WITH {PTS}, {WINDOW} SELECT id, scope, round(x - x0, 6) AS x, round(y - y0, 6) AS y FROM pts JOIN w USING (scope) WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1")
def window_points(spark, sf_dir):
    """Cells in one window of each sample, in the window's frame."""
    p = materialize(points(spark, sf_dir))
    return rounded(I.crop_points(p, _windows(p)), "x", "y").select("id", "scope", "x", "y")


@R.query(f"""WITH {PTS}, {WINDOW}, g AS (SELECT region_id, sample_id AS scope, coordinates[1] AS r FROM roi_regions WHERE len(coordinates) > 0 AND len(coordinates[1]) > 2),
    b AS (SELECT *, list_min(list_transform(r, lambda p: p[1])) AS a0, list_min(list_transform(r, lambda p: p[2])) AS b0, list_max(list_transform(r, lambda p: p[1])) AS a1, list_max(list_transform(r, lambda p: p[2])) AS b1 FROM g)
    SELECT region_id, len(r)::INT AS n, round(a0 - x0, 6) AS left_x, round(b0 - y0, 6) AS top_y FROM b JOIN w USING (scope) WHERE a0 < x1 AND a1 >= x0 AND b0 < y1 AND b1 >= y0""")
def window_rings(spark, sf_dir):
    """Outlines that meet the window, in its frame."""
    outline = F.get("coordinates", F.lit(0))
    rings = table(spark, sf_dir, "roi_regions").where(F.size(outline) > 2).select("region_id", F.col("sample_id").alias("scope"), outline.alias("ring"))
    x0, y0, _, _ = G.bounding_box(F.col("ring"))
    return I.crop_rings(rings, _windows(points(spark, sf_dir))).select("region_id", F.size("ring").alias("n"), F.round(x0, 6).alias("left_x"), F.round(y0, 6).alias("top_y"))


@R.query("SELECT region_id, list_transform(coordinates[1], lambda p: p[1]) AS xs, list_transform(coordinates[1], lambda p: p[2]) AS ys FROM roi_regions WHERE len(coordinates) > 0")
def vertex_table(spark, sf_dir):
    """Corners of each outline as one array for each axis."""
    xs, ys = G.vertex_columns(F.get("coordinates", F.lit(0)))
    return table(spark, sf_dir, "roi_regions").where("size(coordinates) > 0").select("region_id", xs.alias("xs"), ys.alias("ys"))


_AREA = "list_sum(list_transform(range(1, len(c)), lambda i: c[i][1] * c[i + 1][2] - c[i + 1][1] * c[i][2])) / 2"
_FIXED = """o AS (SELECT region_id, sample_id, roi_class, list_filter(coordinates[1], lambda p: p IS NOT NULL) AS r FROM roi_regions WHERE len(coordinates) > 0),
    d AS (SELECT region_id, sample_id, roi_class, list_transform(list_filter(range(1, len(r) + 1), lambda i: i = 1 OR r[i] <> r[i - 1]), lambda i: r[i]) AS r FROM o),
    k AS (SELECT region_id, sample_id, roi_class, len(list_distinct(r)) AS corners, CASE WHEN len(r) > 0 AND r[1] <> r[-1] THEN list_append(r, r[1]) ELSE r END AS c FROM d)"""


@R.query(f"WITH {_FIXED} SELECT region_id, len(c)::INT AS n, round(abs({_AREA}), 6) AS area FROM k WHERE corners >= 3 AND {_AREA} <> 0")
def repaired_rings(spark, sf_dir):
    """Outlines that are polygons after repair, with corners and area."""
    rows = table(spark, sf_dir, "roi_regions").select("region_id", G.repaired(F.get("coordinates", F.lit(0))).alias("ring")).where("ring is not null")
    return rows.select("region_id", F.size("ring").alias("n"), F.round(F.abs(G.signed_area(F.col("ring"))), 6).alias("area"))


@R.query(f"WITH {_FIXED} SELECT sample_id, roi_class, count(*) AS n_regions, round(sum(abs({_AREA})), 4) AS area FROM k WHERE corners >= 3 AND {_AREA} <> 0 GROUP BY ALL")
def region_areas(spark, sf_dir):
    """Regions and outlined area of each class in a sample."""
    rows = table(spark, sf_dir, "roi_regions").select("sample_id", "roi_class", G.repaired(F.get("coordinates", F.lit(0))).alias("ring")).where("ring is not null")
    return rounded(rows.groupBy("sample_id", "roi_class").agg(F.count("*").alias("n_regions"), F.sum(F.abs(G.signed_area(F.col("ring")))).alias("area")), "area", digits=4)


LAST = "m AS (SELECT sample_id, modality, matrix FROM qupath_transforms WHERE matrix IS NOT NULL AND modality IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sample_id, modality ORDER BY transform_id DESC) = 1)"


def _last(spark, sf_dir):
    rows = table(spark, sf_dir, "qupath_transforms").where("matrix is not null and modality is not null")
    return rows.groupBy("sample_id", "modality").agg(F.max_by("matrix", "transform_id").alias("matrix"))


@R.query(f"""WITH {_FIXED}, {LAST}, w AS (SELECT region_id, modality, list_transform(c, lambda p: [matrix[1][1] * p[1] + matrix[1][2] * p[2] + matrix[1][3], matrix[2][1] * p[1] + matrix[2][2] * p[2] + matrix[2][3]]) AS c FROM k JOIN m USING (sample_id) WHERE corners >= 3 AND {_AREA} <> 0)
    SELECT region_id, modality, round(list_min(list_transform(c, lambda p: p[1])), 3) + 0 AS x0, round(list_max(list_transform(c, lambda p: p[2])), 3) + 0 AS y1, round(abs({_AREA}) / 1000, 3) AS area_k FROM w""")
def warped_rings(spark, sf_dir):
    """Outlines in the frame of every modality of their sample: bounds and area in thousands."""
    rows = table(spark, sf_dir, "roi_regions").select("region_id", "sample_id", G.repaired(F.get("coordinates", F.lit(0))).alias("ring")).where("ring is not null")
    moved = rows.join(_last(spark, sf_dir), "sample_id").select("region_id", "modality", F.get(G.warp_rings(F.col("matrix"), F.array("ring")), F.lit(0)).alias("ring"))
    x0, _, _, y1 = G.bounding_box(F.col("ring"))
    return moved.select("region_id", "modality", (F.round(x0, 3) + 0.0).alias("x0"), (F.round(y1, 3) + 0.0).alias("y1"), F.round(F.abs(G.signed_area(F.col("ring"))) / 1000, 3).alias("area_k"))


# a raster of 40 px bins of each sample, turned and shrunk within a frame of 60 by 60
TURN = (0.8, -0.3, 6.5, 0.3, 0.8, -2.25)
GRID = "g AS (SELECT scope, floor(x / 40)::BIGINT AS px, floor(y / 40)::BIGINT AS py, count(*)::DOUBLE AS value FROM pts GROUP BY ALL)"


def _grid(spark, sf_dir):
    return points(spark, sf_dir).groupBy("scope", F.floor(F.col("x") / 40).alias("px"), F.floor(F.col("y") / 40).alias("py")).agg(F.count("*").cast("double").alias("value"))


def _warp_sql(step: str) -> str:
    a, b, tx, c, d, ty = TURN
    return f"""WITH {PTS}, {GRID}, f AS (SELECT scope, px, py, ({d} * (px - {tx}) - {b} * (py - ({ty}))) / {a * d - b * c} AS x, (-({c}) * (px - {tx}) + {a} * (py - ({ty}))) / {a * d - b * c} AS y
        FROM (SELECT DISTINCT scope FROM g), (SELECT unnest(range(60)) AS px), (SELECT unnest(range(60)) AS py)), {step}"""


@R.query(_warp_sql("""t AS (SELECT scope, px, py, floor(x)::BIGINT + i AS sx, floor(y)::BIGINT + j AS sy, (CASE WHEN i = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) * (CASE WHEN j = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) AS w FROM f, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j))
    SELECT t.scope, t.px, t.py, round(sum(w * value), 5) AS value FROM t JOIN g ON g.scope = t.scope AND g.px = sx AND g.py = sy WHERE w > 0 GROUP BY ALL"""))
def warped_density(spark, sf_dir):
    """The density of cells as a raster, moved by an affine with bilinear weights."""
    a, b, tx, c, d, ty = TURN
    grid = materialize(_grid(spark, sf_dir))
    turn = grid.select("scope").distinct().withColumn("matrix", G.matrix(*[F.lit(float(v)) for v in (a, b, tx, c, d, ty)]))
    return rounded(I.warp_raster(grid, turn, 60, 60), "value", digits=5)


@R.query(f"""WITH {PTS}, {GRID}, h AS (SELECT scope, floor(x / 40)::BIGINT AS px, floor(y / 40)::BIGINT AS py, count(*)::DOUBLE AS value FROM pts WHERE id % 3 = 0 GROUP BY ALL), b AS (SELECT coalesce(a.scope, b.scope) AS scope, a.value AS x, b.value AS y FROM (SELECT * FROM g WHERE value > 2) a FULL JOIN (SELECT * FROM h WHERE value > 2) b ON a.scope = b.scope AND a.px = b.px AND a.py = b.py)
    SELECT scope, round(100.0 * count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) / count(*), 6) AS overlap_pct, CASE WHEN count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) > 5 THEN round(coalesce(CASE WHEN stddev_pop(x) FILTER (y IS NOT NULL) * stddev_pop(y) FILTER (x IS NOT NULL) > 1e-12 THEN corr(x, y) END, 0), 6) END AS ncc FROM b GROUP BY scope""")
def raster_agreement(spark, sf_dir):
    """Density of all cells against that of every third: overlap and correlation where either is dense."""
    two = points(spark, sf_dir).where("id % 3 = 0").groupBy("scope", F.floor(F.col("x") / 40).alias("px"), F.floor(F.col("y") / 40).alias("py")).agg(F.count("*").cast("double").alias("value"))
    return rounded(I.image_agreement(_grid(spark, sf_dir), two, above=2.0, least=5), "overlap_pct", "ncc")


AREAS = f"""WITH RECURSIVE {RASTER}, g AS (SELECT *, px - row_number() OVER (PARTITION BY scope, py, label ORDER BY px) AS run FROM mask),
    u AS (SELECT scope, py, min(px)::BIGINT AS s, max(px)::BIGINT + 1 AS e, label FROM g GROUP BY scope, py, label, run), n AS (SELECT *, row_number() OVER (ORDER BY scope, py, s) AS id FROM u),
    l AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.scope = b.scope AND b.py = a.py + 1 AND a.label = b.label AND b.s < a.e AND b.e > a.s), v AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    x(id, root) AS (SELECT id, id FROM n UNION SELECT v.b, x.root FROM x JOIN v ON v.a = x.id WHERE v.b > x.root), q AS (SELECT id, min(root) AS root FROM x GROUP BY id),
    k AS (SELECT scope, label, root, sum(e - s)::BIGINT AS n_pixels, min(s) AS x0, min(py)::BIGINT AS y0, max(e) AS x1, max(py)::BIGINT + 1 AS y1 FROM q JOIN n USING (id) GROUP BY ALL)"""


@R.query(f"""{AREAS}
    SELECT scope, label, (row_number() OVER (PARTITION BY scope ORDER BY root))::INT AS component, n_pixels, x0, y0, x1, y1 FROM k""")
def mask_components(spark, sf_dir):
    """Connected areas of the region mask with their pixels and bounds."""
    return K.mask_components(materialize(_mask(spark, sf_dir)))


@R.query(f"{AREAS} SELECT scope, label, n_pixels::DOUBLE AS area, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM k")
def mask_polygons(spark, sf_dir):
    """Connected areas of the region mask as polygons: area less holes, and bounds, from their corners."""
    found = K.mask_polygons(materialize(_mask(spark, sf_dir)))
    x0, y0, x1, y1 = G.bounding_box(F.get("rings", F.lit(0)))
    area = F.aggregate("rings", F.lit(0.0), lambda a, r: a + G.signed_area(r))
    return found.select("scope", "label", area.alias("area"), x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


@R.query("""WITH l AS (SELECT chip_id, unnest([primary_location, alt_location_1]) AS place, unnest([1, 2]) AS p FROM chip_inventory) SELECT chip_id, arg_min(place, (p, place)) AS place FROM l WHERE place IS NOT NULL AND place <> '' GROUP BY ALL""")
def best_location(spark, sf_dir):
    """For each chip the first of its locations that is there."""
    chips = table(spark, sf_dir, "chip_inventory").select("chip_id", F.posexplode(F.array("primary_location", "alt_location_1")).alias("p", "place")).where("place is not null and place <> ''")
    return A.first_hit(chips, "chip_id", "place", F.col("p"))


@R.query("SELECT DISTINCT reference_id, round((10.5 - 2.0) * 3.25, 6) AS x, round((4.0 - 1.5) * 3.25, 6) AS y, round(10.5 * 3.25 + width_px / 2, 6) AS cx, round(height_px / 2 - 1.5 * 3.25, 6) AS cy FROM reference_images")
def stage_positions(spark, sf_dir):
    """A place in millimetres on each image, from the stage's corner and from the image's centre."""
    rows = table(spark, sf_dir, "reference_images")
    width, height, x, y = F.col("width_px"), F.col("height_px"), F.lit(10.5), F.lit(1.5)
    sx, sy = G.mm_to_px(x, y, 3.25, width, height, F.lit(2.0), F.lit(4.0))
    cx, cy = G.mm_to_px(x, y, 3.25, width, height)
    return rounded(rows.select("reference_id", sx.alias("x"), sy.alias("y"), cx.alias("cx"), cy.alias("cy")).distinct(), "x", "y", "cx", "cy")


@R.query(f"""WITH {KNN}, v AS (SELECT DISTINCT ON (cell_uid) cell_uid AS id, x FROM integrated_cells WHERE x IS NOT NULL), l AS (SELECT id, printf('f%02d', i - 1) AS feature, x[i]::DOUBLE AS value FROM v, range(1, 33) t(i)),
    m AS (SELECT id AS obs, feature, value * sqrt(0.2::DOUBLE) AS value FROM l UNION ALL SELECT left_id, feature || '_nbr', avg(value) * sqrt(0.8::DOUBLE) FROM knn JOIN l ON l.id = right_id GROUP BY ALL)
    SELECT feature, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM m GROUP BY ALL""")
def neighbourhood_features(spark, sf_dir):
    """Own and neighbour features mixed, by feature."""
    mixed = L.with_neighbourhood(expressed(spark, sf_dir), N.knn_weights(points(spark, sf_dir)))
    return rounded(mixed.groupBy("feature").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")), "mean", "std")


@R.query("""WITH m AS (SELECT DISTINCT ON (metric_id) * FROM alignment_metrics WHERE registration_method IS NOT NULL AND sample_id IS NOT NULL ORDER BY metric_id, run_at),
    v AS (SELECT sample_id, registration_method, avg(CASE WHEN NOT isnan(median_distance) THEN median_distance END) AS d FROM m GROUP BY ALL), b AS (SELECT sample_id, min(d) AS least FROM v GROUP BY ALL)
    SELECT registration_method, count(d) AS n_samples, round(avg(d), 6) AS mean_distance, round(avg(d - least), 6) AS mean_excess, count(*) FILTER (d = least) AS n_best FROM v JOIN b USING (sample_id) GROUP BY ALL""")
def method_comparison(spark, sf_dir):
    """Registration methods against one another: how far each is from the best of its sample."""
    rows = table(spark, sf_dir, "alignment_metrics").where("registration_method is not null and sample_id is not null").select("metric_id", "sample_id", "registration_method", clean("median_distance").alias("d"), "run_at")
    single = rows.groupBy("metric_id").agg(F.min_by(F.struct("sample_id", "registration_method", "d"), "run_at").alias("r")).select("r.*")
    means = materialize(single.groupBy("sample_id", "registration_method").agg(F.avg("d").alias("d")))
    best = means.groupBy("sample_id").agg(F.min("d").alias("least"))
    out = means.join(best, "sample_id").groupBy("registration_method").agg(F.count("d").alias("n_samples"), F.avg("d").alias("mean_distance"), F.avg(F.col("d") - F.col("least")).alias("mean_excess"), F.count_if(F.col("d") == F.col("least")).alias("n_best"))
    return rounded(out, "mean_distance", "mean_excess")


@R.query(f"""WITH {BINS}, r AS (SELECT d, exp(-d * d / 2.0) AS w FROM (SELECT unnest([-2, -1, 0, 1, 2]) AS d)), k AS (SELECT d, w / (SELECT sum(w) FROM r) AS w FROM r)
    SELECT scope, b.bx + i.d AS bx, b.by + j.d AS by, round(sum(weight * i.w * j.w), 5) AS weight FROM b, k i, k j GROUP BY ALL""")
def smoothed_bins(spark, sf_dir):
    """Density bins under a Gaussian of one bin."""
    return rounded(smooth(binned(spark, sf_dir), 1.0, 2.0), "weight", digits=5)


@R.query(f"""WITH {C}, m AS (SELECT feature, avg(value) AS m FROM c WHERE feature < 'f06' GROUP BY ALL), z AS (SELECT obs, feature, value - m AS z FROM c JOIN m USING (feature))
    SELECT a.feature AS one, b.feature AS two, round(sum(a.z * b.z) / count(*), 6) + 0 AS covariance FROM z a JOIN z b ON a.obs = b.obs AND a.feature <= b.feature GROUP BY ALL""")
def feature_covariance(spark, sf_dir):
    """Covariances of the first six features, what components are made from."""
    rows = table(spark, sf_dir, "integrated_cells").where("x is not null").select("cell_uid", "x").dropDuplicates(["cell_uid"])
    found = L.covariance(rows, "x", 6)
    name = lambda c: F.format_string("f%02d", F.col(c))
    return found.select(name("i").alias("one"), name("j").alias("two"), (F.round("covariance", 6) + 0.0).alias("covariance"))
