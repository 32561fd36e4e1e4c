"""Queries of the general problems 3, 5 and 6 with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselon.operators.proximity import cover_regions, inside_regions, near_and_nearest, nearest_beyond, points_of
from tesselon.operators.references import orphan_references
from tesselon.operators.skew import key_summary, top_k_per_key
from tesselon.plans.mask_queries import CELL_IN, EDGES
from tesselon.session import materialize, table

#: table, reference column, time column, id column, parent table, parent key
REFERENCES = (
    ("sample_mapping", "sample_id", "mapped_at", "mapping_id", "sample_registry", "sample_id"),
    ("sample_mapping", "chip_id", "mapped_at", "mapping_id", "chip_inventory", "chip_id"),
    ("qupath_transforms", "reference", "updated_at", "transform_id", "reference_images", "reference_id"),
)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, column, at, record_id, parent, key in REFERENCES:
        part = orphan_references(table(spark, sf_dir, name), column, at, record_id, table(spark, sf_dir, parent), key, "registered_at", "deleted_at").select(
            F.lit(name).alias("table_name"), F.lit(column).alias("field_name"), "record_id", "kind", F.date_format("at", "yyyy-MM").alias("period_month")
        )
        out = part if out is None else out.unionByName(part)
    return out


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_found(spark, sf_dir).groupBy("table_name", "field_name", "period_month", "kind").agg(F.count("*").alias("n_orphans"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_per_key(table(spark, sf_dir, "integrated_cells"), ["disease", "phenotype"], "n_transcripts", "cell_uid").select("disease", "phenotype", "cell_uid")


def p5_key_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_summary(table(spark, sf_dir, "integrated_cells"), ["disease", "phenotype"], "cell_uid", ["n_transcripts", "area_px"])


NEAR_PX, THRESHOLD_PX = 12.0, 50.0


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_of(table(spark, sf_dir, "integrated_cells"), "cell_uid", "sample_id", "spatial", "within_threshold")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near pairs, wrong within_threshold flags with the nearest cell, and cells strictly inside regions.

    A cell alone in its sample has no nearest cell and so no ``flag`` row.
    """
    points = _cells(spark, sf_dir)
    swept = materialize(near_and_nearest(points, NEAR_PX, THRESHOLD_PX))
    near = swept.where("kind = 0").select(F.lit("near").alias("kind"), "left_id", "right_id")
    nearest = swept.where("kind = 1")
    close = nearest.where("right_id is not null and flag = 0")
    far = nearest.where("right_id is null and flag = 1").select(F.col("left_id").alias("id"))
    lonely = materialize(points.join(far, "id", "left_semi").distinct())
    beyond = nearest_beyond(lonely, points, THRESHOLD_PX)
    flag = close.select("left_id", "right_id").unionByName(beyond.select("left_id", "right_id")).select(F.lit("flag").alias("kind"), "left_id", "right_id")
    cover = materialize(cover_regions(table(spark, sf_dir, "roi_regions"), "region_id", "sample_id", "coordinates"))
    inside = inside_regions(points, cover).select(F.lit("inside").alias("kind"), F.col("id").alias("left_id"), F.col("region_id").alias("right_id"))
    return near.unionByName(flag).unionByName(inside)


def p6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cell with the number of other cells at most 12 px away and the distance to the closest of them."""
    swept = near_and_nearest(_cells(spark, sf_dir), NEAR_PX, NEAR_PX).where("kind = 0")
    ends = swept.select(F.explode(F.array("left_id", "right_id")).alias("cell_uid"), "dist")
    return ends.groupBy("cell_uid").agg(F.count("*").alias("n_near"), F.min("dist").alias("closest"))


def _p3_sql() -> str:
    norm = "nullif(replace(upper(trim({})), 'O', '0'), '')"
    parts = []
    for name, column, at, record_id, parent, key in REFERENCES:
        parts.append(f"""
        SELECT '{name}' AS table_name, '{column}' AS field_name, r.id AS record_id,
          CASE WHEN count(p.k) = 0 THEN 'missing' WHEN coalesce(bool_and(p.since > r.t), true) THEN 'late' ELSE 'deleted' END AS kind,
          strftime(any_value(r.t), '%Y-%m') AS period_month
        FROM (SELECT {record_id} AS id, row_number() OVER () AS n, {norm.format(column)} AS k, {at} AS t FROM {name}) r
        LEFT JOIN (SELECT {norm.format(key)} AS k, registered_at AS since, deleted_at AS until FROM {parent}) p ON p.k = r.k
        WHERE r.k IS NOT NULL AND r.t IS NOT NULL
        GROUP BY r.id, r.n
        HAVING NOT coalesce(bool_or(p.since <= r.t AND (p.until IS NULL OR p.until > r.t)), false)""")
    return " UNION ALL ".join(parts)


def queries() -> dict:
    return {"p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found, "p5_key_summary": p5_key_summary, "p6_found": p6_found, "p6_near": p6_near}


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": _p3_sql(),
        "p3_report": f"SELECT table_name, field_name, period_month, kind, count(*) AS n_orphans FROM ({_p3_sql()}) GROUP BY ALL",
        "p5_found": """
            SELECT disease, phenotype, cell_uid FROM (
              SELECT *, row_number() OVER (PARTITION BY disease, phenotype ORDER BY n_transcripts DESC, cell_uid) AS rn
              FROM (SELECT DISTINCT disease, phenotype, cell_uid, n_transcripts FROM integrated_cells
                    WHERE disease IS NOT NULL AND phenotype IS NOT NULL AND n_transcripts IS NOT NULL)) WHERE rn <= 3""",
        "p5_key_summary": """
            SELECT disease, phenotype, count(*) AS n_records,
              count(t) AS n_n_transcripts, sum(t) AS sum_n_transcripts, avg(t) AS avg_n_transcripts, min(t) AS min_n_transcripts, max(t) AS max_n_transcripts,
              count(a) AS n_area_px, sum(a) AS sum_area_px, avg(a) AS avg_area_px, min(a) AS min_area_px, max(a) AS max_area_px
            FROM (SELECT disease, phenotype, cell_uid, max(n_transcripts::DOUBLE) AS t, max(area_px::DOUBLE) AS a FROM integrated_cells
                  WHERE disease IS NOT NULL AND phenotype IS NOT NULL GROUP BY ALL) GROUP BY ALL""",
        "p6_found": f"""
            WITH {EDGES}, {CELL_IN}, pt AS (SELECT DISTINCT cell_uid AS id, sample_id AS s, spatial[1] AS x, spatial[2] AS y, within_threshold AS w FROM integrated_cells WHERE spatial IS NOT NULL AND sample_id IS NOT NULL),
            pr AS (SELECT a.id AS i, b.id AS j, a.w, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM pt a JOIN pt b ON a.s = b.s AND a.id <> b.id),
            nn AS (SELECT i, any_value(w) AS w, min(d2) AS d2, arg_min(j, (d2, j)) AS j FROM pr WHERE w IS NOT NULL GROUP BY i)
            SELECT 'near' AS kind, i AS left_id, j AS right_id FROM pr WHERE d2 <= 144 AND i < j
            UNION ALL SELECT 'flag', i, j FROM nn WHERE w <> (d2 <= 2500)
            UNION ALL SELECT 'inside', id, region_id FROM ins""",
        "p6_near": """
            WITH c AS (SELECT DISTINCT cell_uid, sample_id, spatial[1] AS x, spatial[2] AS y FROM integrated_cells WHERE spatial IS NOT NULL),
            p AS (SELECT a.cell_uid AS a, b.cell_uid AS b, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) AS d
                  FROM c a JOIN c b ON a.sample_id = b.sample_id AND a.cell_uid < b.cell_uid AND abs(a.x-b.x) <= 12 AND abs(a.y-b.y) <= 12)
            SELECT cell_uid, count(*) AS n_near, min(d) AS closest FROM
              (SELECT a AS cell_uid, d FROM p WHERE d <= 12 UNION ALL SELECT b, d FROM p WHERE d <= 12) GROUP BY ALL""",
    }
