"""Queries on components, neighbourhoods, communities, cluster quality and streamed ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesselon.functions import geometry as G
from tesselon.operators import learn as L
from tesselon.operators import nearest as N
from tesselon.plans.matrix_queries import expressed, rounded
from tesselon.plans.registry import Registry
from tesselon.plans.spatial_queries import KNN, points
from tesselon.session import table
from tesselon.streaming.ingest import ingest_available

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql


@R.query()
def pca_variance_ratio(spark, sf_dir):
    return L.principal_components(table(spark, sf_dir, "integrated_cells").dropDuplicates(["cell_uid"]), "cell_uid", "x", 10)[1]


@R.query()
def pca_loadings(spark, sf_dir):
    """How much each feature counts in the first five components."""
    cells = table(spark, sf_dir, "integrated_cells").select("cell_uid", "x").dropDuplicates(["cell_uid"])
    return L.component_loadings(cells, "cell_uid", "x", 5)


@R.query()
def pca_composite(spark, sf_dir):
    """One value for each cell: its first components, weighted by their share of the variance."""
    cells = table(spark, sf_dir, "integrated_cells").select("cell_uid", "x").dropDuplicates(["cell_uid"])
    return L.component_scores(cells, "cell_uid", "x", 3)


@R.query(f"""WITH {KNN}, v AS (SELECT DISTINCT ON (cell_uid) cell_uid AS id, sample_id, x FROM integrated_cells WHERE x IS NOT NULL),
    l AS (SELECT id, sample_id, printf('f%02d', i - 1) AS feature, x[i]::DOUBLE AS value FROM v, range(1, 33) t(i)),
    a AS (SELECT left_id AS id, feature, avg(value) AS around FROM knn JOIN l ON l.id = right_id GROUP BY ALL)
    SELECT sample_id, feature, count(*) AS n, round(avg(abs(value - around)), 6) AS mean_gap FROM l JOIN a USING (id, feature) GROUP BY ALL""")
def neighbourhood_gap(spark, sf_dir):
    """How far cells lie from the mean of their six neighbours, by sample and feature."""
    long = expressed(spark, sf_dir, ("sample_id",))
    around = L.neighbour_means(long, N.knn_weights(points(spark, sf_dir)))
    gap = F.avg(F.abs(F.col("value") - F.col("around")))
    return rounded(long.join(around, ["obs", "feature"]).groupBy("sample_id", "feature").agg(F.count("*").alias("n"), gap.alias("mean_gap")), "mean_gap")


@R.query()
def spatial_communities(spark, sf_dir):
    """Communities of the six-neighbour graph of all samples with their sizes."""
    found = L.communities(N.knn_weights(points(spark, sf_dir)))
    return found.groupBy("community").agg(F.count("*").alias("size"))


@R.query("""WITH s AS (SELECT label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY ALL) SELECT count(*) AS n_clusters, sum(n)::BIGINT AS n_records, min(n) AS min_size, max(n) AS max_size FROM s""")
def cluster_sizes(spark, sf_dir):
    return L.cluster_sizes(table(spark, sf_dir, "embeddings"), "label")


@R.query()
def simplified_rings(spark, sf_dir):
    """Vertices and area of each ring of a region, outline and holes, before and after simplification."""
    rows = table(spark, sf_dir, "roi_regions").select("region_id", F.posexplode("coordinates").alias("ring_no", "raw")).where("size(raw) > 2").select("region_id", "ring_no", G.close_ring(F.col("raw")).alias("ring"))
    rows = rows.withColumn("simple", L.simplify_ring(F.col("ring"), 1.5))
    return rows.select("region_id", "ring_no", F.size("ring").alias("n_before"), F.size("simple").alias("n_after"), F.abs(G.signed_area(F.col("ring"))).alias("area_before"), F.abs(G.signed_area(F.col("simple"))).alias("area_after"))


@R.query("SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def streamed_daily_totals(spark, sf_dir):
    """Events taken in as a stream of what is available, then summed by type and day."""
    landed = ingest_available(spark, f"{sf_dir}/events.parquet", ["event_type", "ts", "value"])
    return rounded(landed.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"), F.sum("value").alias("total")), "total")
