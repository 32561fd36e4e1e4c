"""Pixel tables, matrix bundles, polygons and transforms as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesselon.operators.audit import safe_name
from tesselon.functions.geometry import invert_affine
from tesselon.operators.matrix import merge_channels
from tesselon.session import materialize, small
from tesselon.sources.files import matching
from tesselon.sources.geojson import RANGE_BYTES, GeojsonFeatures


def detect_layout(spark: SparkSession, folder: str, sample: str) -> str:
    """``single`` (folder/sample.parquet), ``channels`` (folder/sample/*.parquet) or ``unknown``."""
    path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    there = lambda p: path(p).getFileSystem(conf).globStatus(path(p))
    if len(there(f"{folder}/{sample}.parquet") or []):
        return "single"
    return "channels" if len(there(f"{folder}/{sample}/*.parquet") or []) else "unknown"


def read_channels(spark: SparkSession, folder: str) -> DataFrame:
    """``x, y, channel, value`` of one Parquet per channel, named by the file; the value is the column besides x, y."""
    rows = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(folder)
    values = [c for c in rows.columns if c not in ("x", "y", "channel")]
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet(/[^/]*)?$", 1)
    channel = F.coalesce(F.col("channel"), name) if "channel" in rows.columns else name
    return rows.select("x", "y", channel.alias("channel"), F.coalesce(*[F.col(f"`{c}`").cast("double") for c in values]).alias("value"))


def read_pixels(spark: SparkSession, folder: str, sample: str, fill: float = 0.0, how: str = "outer") -> DataFrame:
    """The wide pixel table of a sample in either layout; an unknown one is an error."""
    layout = detect_layout(spark, folder, sample)
    if layout == "single":
        return spark.read.parquet(f"{folder}/{sample}.parquet").na.fill(fill)
    if layout == "channels":
        long = read_channels(spark, f"{folder}/{sample}")
        names = sorted(r[0] for r in long.select("channel").distinct().collect())  # a sample's channels, a few dozen
        return merge_channels(long, names, how, fill)
    raise ValueError(f"no pixel table of {sample} in {folder}")


def write_channels(long: DataFrame, folder: str) -> None:
    """``sample_id, channel, x, y, value`` partitioned by sample and channel, names made safe; large channels are split
    over tasks and files, small ones share them."""
    out = long.withColumns({"sample_id": safe_name(F.col("sample_id")), "channel": safe_name(F.col("channel"))})
    out.hint("rebalance", "sample_id", "channel").write.mode("overwrite").partitionBy("sample_id", "channel").parquet(folder)


def write_bundle(folder: str, obs: DataFrame, var: DataFrame, values: DataFrame) -> None:
    """An annotated matrix: observations, features and the long values beside one another."""
    for name, part in (("obs", obs), ("var", var), ("x", values)):
        part.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")


def read_bundle(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{folder}/{name}") for name in ("obs", "var", "x"))


FEATURE = "struct<type:string, id:string, geometry:struct<type:string, coordinates:string>, properties:struct<label:bigint, area_px:bigint, object_index:bigint, object_type:int, classification:struct<name:string>>>"


def read_geojson(spark: SparkSession, path: str, whole: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row for each polygon: ``feature_id, label, class, rings``; a MultiPolygon gives one row for each part.

    The label is that of the properties or else the object index + 1 or the place in the file + 1. Other geometries are
    left out. Files are read in ranges of bytes; with ``whole`` (for features that don't start with their type) each in
    one task.
    """
    if whole:
        rows = spark.read.schema(f"type string, features array<{FEATURE}>").option("multiLine", "true").json(path).select(F.posexplode("features").alias("place", "f"))
    else:
        spark.dataSource.register(GeojsonFeatures)
        texts = spark.read.format("geojson_features").option("rangeBytes", range_bytes).load(path)
        sizes = texts.groupBy("path", "part").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("path").orderBy("part")) - F.col("n")  # over one row for each range
        starts = materialize(sizes.select("path", "part", before.alias("before")))
        rows = texts.join(small(starts), ["path", "part"]).select((F.col("before") + F.col("place")).alias("place"), F.from_json("feature", FEATURE).alias("f"))
    props = F.col("f.properties")
    polygon, multi = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json("f.geometry.coordinates", polygon))).when(F.col("f.geometry.type") == "MultiPolygon", F.from_json("f.geometry.coordinates", multi))
    label = F.coalesce(props["label"], props["object_index"] + 1, F.col("place") + 1)
    return rows.select(F.coalesce("f.id", F.col("place").cast("string")).alias("feature_id"), label.alias("label"), props["classification"]["name"].alias("class"), F.explode(parts).alias("rings"))


def write_geojson(polygons: DataFrame, folder: str) -> None:
    """Each of ``feature_id, label, class, rings`` as one Feature a line."""
    geometry = F.struct(F.lit("Polygon").alias("type"), F.col("rings").alias("coordinates"))
    props = F.struct("label", F.struct(F.col("class").alias("name")).alias("classification"))
    polygons.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("feature_id").alias("id"), geometry.alias("geometry"), props.alias("properties"))).alias("value")).write.mode("overwrite").text(folder)


def read_metadata(spark: SparkSession, pattern: str) -> DataFrame:
    """The first CSV by name that matches, with its header, all as text; none is an error."""
    found = matching(pattern)
    if not found:
        raise ValueError(f"no file matches {pattern}")
    return spark.read.csv(found[0][0], header=True, multiLine=True, escape='"')


def read_transforms(spark: SparkSession, path: str) -> DataFrame:
    """``sample_id, modality, matrix, invert, effective``: the transforms of a JSON map of samples, entries starting
    with _ left out; ``effective`` is the inverse unless ``invert`` is false. Matrices that aren't 2x3 are null."""
    inner = "map<string, struct<matrix:array<array<double>>, invert:boolean, ecc_warp_mode:string, notes:string>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, string>").alias("m")).select(F.explode("m").alias("sample_id", "body")).where(~F.col("sample_id").startswith("_"))
    each = whole.select("sample_id", F.explode(F.from_json(F.get_json_object("body", "$.transforms"), inner)).alias("modality", "t")).where(~F.col("modality").startswith("_"))
    good = (F.size("t.matrix") == 2) & F.forall("t.matrix", lambda r: F.size(r) == 3)
    m = F.when(good, F.col("t.matrix"))
    invert = F.coalesce("t.invert", F.lit(True))
    return each.select("sample_id", "modality", m.alias("matrix"), invert.alias("invert"), F.when(invert, invert_affine(m)).otherwise(m).alias("effective"))
