"""Queries of the problems tagged llm, with their SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesselon.llm import bpe, components, density, packing, percentiles, subjects
from tesselon.session import materialize, table

#: Bijective code of the comet side: below every stomics index, in the order of the indices.
COMET = -(2**63)

MEASURES = (("integrated_cells", "n_transcripts", 0.5), ("integrated_cells", "area_px", 0.9), ("cell_mapping", "distance", 0.5), ("alignment_metrics", "median_distance", 0.75))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "cell_mapping").where("mapped and comet_idx >= 0 and stomics_idx >= 0")
    labels = components.group_pairs(pairs.select("sample_id", (F.col("comet_idx") + F.lit(COMET)).alias("u"), F.col("stomics_idx").alias("v")), "sample_id", "u", "v")
    side = F.when(F.col("vertex") < 0, "comet").otherwise("stomics")
    idx = F.when(F.col("vertex") < 0, F.col("vertex") - F.lit(COMET)).otherwise(F.col("vertex"))
    # every pair has a comet record, so the smallest code of a group is one
    return labels.select(F.col("scope").alias("sample_id"), side.alias("side"), idx.alias("idx"), (F.col("label") - F.lit(COMET)).alias("group_idx"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _groups(spark, sf_dir)
    sizes = groups.groupBy("sample_id", "group_idx").count().where("count >= 3").drop("count")
    return groups.join(sizes, ["sample_id", "group_idx"], "left_semi").select("sample_id", "side", "idx", "group_idx")


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group with its number of records on either side."""
    return _groups(spark, sf_dir).groupBy("sample_id", "group_idx").agg(F.count_if(F.col("side") == "comet").alias("n_comet"), F.count_if(F.col("side") == "stomics").alias("n_stomics"))


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, field, _ in MEASURES:
        part = percentiles.measure_keys(table(spark, sf_dir, name), "sample_id", field)
        out = part if out is None else out.unionByName(part)
    return out


def p2_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _percentiles(spark, sf_dir).select("field_name", "sample_id", *[F.round(c, 6).alias(c) for c in ("p50", "p75", "p90")])


def _percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = percentiles.exact_percentiles(_keys(spark, sf_dir), [0.5, 0.75, 0.9])
    by = lambda q: F.max(F.when(F.col("q") == q, F.col("value")))
    return found.groupBy("field_name", F.col("grp").alias("sample_id")).agg(by(0.5).alias("p50"), by(0.75).alias("p75"), by(0.9).alias("p90"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _percentiles(spark, sf_dir)  # unrounded
    case = {"n_transcripts": F.col("p50") < 120, "area_px": F.col("p90") > 1500, "distance": F.col("p50") > 25, "median_distance": F.col("p75") > 60}
    hit = F.lit(False)
    for name, condition in case.items():
        hit = hit | ((F.col("field_name") == name) & condition)
    return p.where(hit).select("field_name", "sample_id")


def p2_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of the percentiles of n_transcripts from one histogram for each month of ``acquired_at``, added up.

    Rows without a time form a part of their own.
    """
    cells = table(spark, sf_dir, "integrated_cells").select("sample_id", "n_transcripts", F.coalesce(F.date_format("acquired_at", "yyyy-MM"), F.lit("none")).alias("part"))
    keys = percentiles.measure_keys(cells.withColumn("sample_id", F.to_json(F.struct("sample_id", "part"))).where("sample_id is not null"), "sample_id", "n_transcripts")
    parts = materialize(percentiles.digit_histogram(keys, 20))
    merged = percentiles.merge_histograms([parts.withColumn("grp", F.get_json_object("grp", "$.sample_id"))]).where("grp is not null")
    return percentiles.bounded_percentiles(merged, 20, [0.5, 0.9]).select("field_name", F.col("grp").alias("sample_id"), "q", "low", "high")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = density.neighbour_graph(table(spark, sf_dir, "integrated_cells"), "cell_uid", "x", 0.95)
    # candidates are the roots of the hierarchy; whether all of their records are similar is decided exactly
    return density.similar_sets(graph, density.hierarchy(graph)).select(F.col("id").alias("cell_uid"), F.col("cluster").alias("cluster_uid"))


def p4_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cluster of the condensed hierarchy with its size, stability and three most typical cells."""
    graph = density.neighbour_graph(table(spark, sf_dir, "integrated_cells"), "cell_uid", "x", 0.95)
    return density.clusters(graph)[1].withColumnRenamed("cluster", "cluster_uid")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text, or piece of a text above the largest capacity, with its container."""
    sizes = bpe.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "n_tokens").withColumnsRenamed({"id": "doc_id", "size": "n_tokens"})


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By capacity: containers, tokens in them and the share of their room that is filled."""
    bins = p8_pack(spark, sf_dir).groupBy("container_id", "capacity").agg(F.sum("n_tokens").alias("used"))
    return bins.groupBy("capacity").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), (F.sum("used") / F.sum("capacity")).alias("fill"))


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.assign_subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subject_labels"), "doc_id", "text", "area")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subjects(spark, sf_dir).select("doc_id", F.explode("areas").alias("area"))


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each area and their share of all that have one; a document on two areas counts half for each."""
    each = _subjects(spark, sf_dir).select(F.explode("areas").alias("area"), (1 / F.size("areas")).alias("part")).groupBy("area").agg(F.count("*").alias("documents"), F.sum("part").alias("weight"))
    whole = Window.partitionBy(F.lit(0))  # over one row for each area
    return each.select("area", "documents", "weight", (F.col("weight") / F.sum("weight").over(whole)).alias("share"))


def queries() -> dict:
    return {"p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p2_percentiles": p2_percentiles, "p2_merged": p2_merged, "p4_found": p4_found, "p4_clusters": p4_clusters, "p7_ids": p7_ids, "p8_pack": p8_pack, "p8_fill": p8_fill, "p9_found": p9_found, "p9_composition": p9_composition}


_GROUPS_SQL = """
    WITH RECURSIVE e AS (SELECT DISTINCT sample_id AS s, comet_idx AS c, stomics_idx AS t FROM cell_mapping
        WHERE mapped AND comet_idx >= 0 AND stomics_idx >= 0 AND sample_id IS NOT NULL),
    r(s, origin, c) AS (SELECT s, c, c FROM e UNION
        SELECT r.s, r.origin, b.c FROM r JOIN e a ON a.s = r.s AND a.c = r.c JOIN e b ON b.s = a.s AND b.t = a.t),
    l AS (SELECT s, origin AS c, min(c) AS g FROM r GROUP BY ALL),
    m AS (SELECT s AS sample_id, 'comet' AS side, c AS idx, g AS group_idx FROM l
        UNION SELECT e.s, 'stomics', e.t, l.g FROM e JOIN l ON l.s = e.s AND l.c = e.c)
"""
_PERCENTILES_SQL = "SELECT field_name, sample_id, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, quantile_cont(v, 0.9) AS p90 FROM (" + " UNION ALL ".join(
    f"SELECT '{field}' AS field_name, sample_id, {field}::DOUBLE AS v FROM {name}" for name, field, _ in MEASURES
) + ") WHERE v IS NOT NULL AND NOT isnan(v) AND sample_id IS NOT NULL GROUP BY ALL"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _GROUPS_SQL + "SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY sample_id, group_idx) >= 3",
        "p1_groups": _GROUPS_SQL + "SELECT sample_id, group_idx, count(*) FILTER (side = 'comet') AS n_comet, count(*) FILTER (side = 'stomics') AS n_stomics FROM m GROUP BY ALL",
        "p2_percentiles": f"SELECT field_name, sample_id, round(p50, 6) AS p50, round(p75, 6) AS p75, round(p90, 6) AS p90 FROM ({_PERCENTILES_SQL})",
        "p2_found": f"SELECT field_name, sample_id FROM ({_PERCENTILES_SQL}) WHERE CASE field_name WHEN 'n_transcripts' THEN p50 < 120 WHEN 'area_px' THEN p90 > 1500 WHEN 'distance' THEN p50 > 25 ELSE p75 > 60 END",
    }
