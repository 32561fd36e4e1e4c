"""Inventory queries: readiness, completeness, fingerprints, gates, names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.operators import audit as A
from tesselon.operators.references import normalize_key
from tesselon.plans.registry import Registry
from tesselon.session import small, table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

LATEST = "(SELECT * FROM sample_registry QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY registered_at DESC, coalesce(notes, ''), coalesce(deleted_at, TIMESTAMP '1900-01-01') DESC) = 1)"
MAPPED = "(SELECT replace(upper(trim(sample_id)), 'O', '0') AS sample_id, count(*) AS n FROM sample_mapping WHERE aligned GROUP BY ALL)"


def _latest(spark, sf_dir):
    order = F.struct(F.col("registered_at"), F.coalesce(F.col("deleted_at").cast("timestamp_ntz"), F.lit("1900-01-01").cast("timestamp_ntz")))
    rows = table(spark, sf_dir, "sample_registry")
    return rows.groupBy("sample_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "sample_id"]), order).alias("r")).select("sample_id", "r.*")


@R.query(f"""SELECT r.sample_id, CASE WHEN m.n > 60 THEN 'DONE' WHEN chip_id_primary IS NOT NULL AND geojson_available = 'Yes' AND coalesce(primary_location, '') <> '' THEN 'READY_FULL'
    WHEN chip_id_primary IS NOT NULL AND geojson_available = 'Yes' AND msi_available = 'Yes' AND coalesce(m.n, 0) > 0 THEN 'READY_CELLBIN' WHEN chip_id_primary IS NOT NULL AND geojson_available = 'Yes' THEN 'READY_NO_IMAGE'
    WHEN msi_available = 'Yes' AND coalesce(m.n, 0) > 0 THEN 'CELLBIN_ONLY' WHEN msi_available = 'Yes' THEN 'NEED_IMAGES' ELSE 'NEED_DATA' END AS readiness
    FROM {LATEST} r LEFT JOIN {MAPPED} m USING (sample_id) LEFT JOIN (SELECT chip_id, max(primary_location) AS primary_location FROM chip_inventory GROUP BY ALL) c ON c.chip_id = r.chip_id_primary""")
def readiness_waterfall(spark, sf_dir):
    mapped = table(spark, sf_dir, "sample_mapping").where("aligned").groupBy(normalize_key(F.col("sample_id")).alias("sample_id")).agg(F.count("*").alias("n"))
    chips = table(spark, sf_dir, "chip_inventory").groupBy(F.col("chip_id").alias("chip_id_primary")).agg(F.max("primary_location").alias("place"))
    rows = _latest(spark, sf_dir).join(small(mapped), "sample_id", "left").join(small(chips), "chip_id_primary", "left")
    state = A.readiness(F.col("n") > 60, F.col("chip_id_primary").isNotNull(), F.col("geojson_available") == "Yes", F.col("place") != "", F.lit(False), F.col("msi_available") == "Yes", F.col("n") > 0)
    return rows.select("sample_id", state.alias("readiness"))


@R.query("""SELECT coalesce(disease, 'none') AS disease, count(*) AS n, count(*) FILTER (aligned) AS aligned, count(*) FILTER (sample_id IS NOT NULL AND trim(sample_id) <> '') AS with_sample,
    count(*) FILTER (chip_id IS NOT NULL AND trim(chip_id) <> '') AS with_chip, count(mapped_at) AS with_time FROM sample_mapping GROUP BY ALL""")
def completeness_counts(spark, sf_dir):
    there = lambda c: F.count_if(F.col(c).isNotNull() & (F.trim(c) != ""))
    rows = table(spark, sf_dir, "sample_mapping").groupBy(F.coalesce("disease", F.lit("none")).alias("disease"))
    return rows.agg(F.count("*").alias("n"), F.count_if("aligned").alias("aligned"), there("sample_id").alias("with_sample"), there("chip_id").alias("with_chip"), F.count("mapped_at").alias("with_time"))


@R.query("SELECT doc_id, CASE WHEN text IS NULL THEN 'MISSING' ELSE sha256(text)[1:16] END AS fingerprint FROM documents")
def fingerprint_sha256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", A.fingerprint(F.encode("text", "UTF-8")).alias("fingerprint"))


@R.query("""WITH f AS (SELECT item_id AS sample_id, doc_id, sha256(text)[1:16] AS hash, loaded_at > review_date + INTERVAL 20 DAY AS late FROM documents WHERE text IS NOT NULL AND item_id IS NOT NULL),
    s AS (SELECT i.item_id AS sample_id, CASE WHEN i.item_id % 3 = 0 THEN 'pending' ELSE 'approved' END AS status, bool_or(coalesce(late, false)) AS changed, count(f.doc_id) AS n FROM review_items i LEFT JOIN f ON f.sample_id = i.item_id GROUP BY ALL)
    SELECT sample_id, CASE WHEN n = 0 THEN 'no_manifest' WHEN status <> 'approved' THEN 'not_approved' WHEN changed THEN 'files_changed' ELSE 'approved' END AS decision FROM s""")
def approval_gate(spark, sf_dir):
    """Items stand for samples and their reviews for files; a review loaded long after it was written counts as edited."""
    docs = table(spark, sf_dir, "documents").where("text is not null and item_id is not null")
    hash_ = A.fingerprint(F.encode("text", "UTF-8"))
    edited = F.coalesce(F.col("loaded_at") > F.col("review_date") + F.expr("interval 20 days"), F.lit(False))
    manifest = docs.select(F.col("item_id").alias("sample_id"), F.lit("review").alias("role"), F.col("doc_id").alias("path"), hash_.alias("hash"))
    current = docs.select(F.col("doc_id").alias("path"), F.when(edited, F.concat(hash_, F.lit("x"))).otherwise(hash_).alias("hash"))
    status = table(spark, sf_dir, "review_items").select(F.col("item_id").alias("sample_id"), F.when(F.col("item_id") % 3 == 0, "pending").otherwise("approved").alias("status"))
    return A.approval(status, A.verify_manifest(manifest, current))


@R.query("SELECT mapping_id, nullif(replace(upper(trim(sample_id)), 'O', '0'), '') AS sample_key, coalesce(TRY_CAST(nullif(regexp_extract(sample_id, '(\\d{1,18})', 1), '') AS BIGINT), 0) AS number, regexp_replace(chip_id, '[^\\p{L}\\p{N}_-]', '_', 'g') AS safe FROM sample_mapping")
def name_normalization(spark, sf_dir):
    return table(spark, sf_dir, "sample_mapping").select("mapping_id", normalize_key(F.col("sample_id")).alias("sample_key"), A.numeric_part(F.col("sample_id")).alias("number"), A.safe_name(F.col("chip_id")).alias("safe"))


@R.query("""SELECT sample_id, count(*) AS runs, arg_min(registration_method, (median_distance, metric_id)) AS best_method, round(min(median_distance), 6) AS best_median FROM (SELECT DISTINCT sample_id, metric_id, registration_method, median_distance FROM alignment_metrics)
    WHERE registration_method IS NOT NULL AND median_distance IS NOT NULL AND NOT isnan(median_distance) AND median_distance >= 0 GROUP BY ALL""")
def best_registration(spark, sf_dir):
    """For each sample the method of the run with the lowest median distance."""
    rows = table(spark, sf_dir, "alignment_metrics").select("sample_id", "metric_id", "registration_method", "median_distance").distinct()
    rows = rows.where("registration_method is not null and median_distance >= 0 and not isnan(median_distance)")
    return rows.groupBy("sample_id").agg(F.count("*").alias("runs"), F.min_by("registration_method", F.struct("median_distance", "metric_id")).alias("best_method"), F.round(F.min("median_distance"), 6).alias("best_median"))
