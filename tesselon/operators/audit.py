"""Inventories, readiness, fingerprints, manifests and approval gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIB = 1024 * 1024


def readiness(cellbin: Column, fastq: Column, mask: Column, image_record: Column, image_archive: Column, expression: Column, tiles: Column) -> Column:
    """First state that holds; a null flag counts as false."""
    c, q, m, r, a, e, t = (F.coalesce(x, F.lit(False)) for x in (cellbin, fastq, mask, image_record, image_archive, expression, tiles))
    return (
        F.when(c, "DONE").when(q & m & (r | a), "READY_FULL").when(q & m & e & t, "READY_CELLBIN").when(q & m, "READY_NO_IMAGE")
        .when(e & t, "CELLBIN_ONLY").when(e, "NEED_IMAGES").otherwise("NEED_DATA")
    )


def fingerprint(content: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the content; of contents above 2 MiB only the first and last MiB and the
    decimal size are hashed; MISSING for null."""
    size = F.octet_length(content)
    ends = F.concat(F.substring(content, 1, MIB), F.substring(content, -MIB, MIB), F.encode(size.cast("string"), "UTF-8"))
    return F.coalesce(F.substring(F.sha2(F.when(size > 2 * MIB, ends).otherwise(content), 256), 1, 16), F.lit("MISSING"))


def file_listing(spark, path: str, pattern: str = "*", hashed: bool = False) -> DataFrame:
    """``path, name, stem, size`` of the files below a folder that match the pattern, without reading them; with
    ``hashed`` also their ``hash``, for which each is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    wanted = ["path", name.alias("name"), F.regexp_replace(name, r"(\.ome)?\.[^.]+$", "").alias("stem"), F.col("length").alias("size")]
    return files.select(*wanted, *([fingerprint(F.col("content")).alias("hash")] if hashed else []))


def build_manifest(files: DataFrame, listing: DataFrame) -> DataFrame:
    """``sample_id, role, path`` with what a hashed ``file_listing`` says of each: ``present``, ``hash`` (MISSING where
    there is no file) and ``size`` (null there). Repeated rows count once."""
    there = listing.select("path", "hash", "size").dropDuplicates(["path"])
    out = files.select("sample_id", "role", "path").distinct().join(there, "path", "left")
    return out.select("sample_id", "role", "path", F.col("hash").isNotNull().alias("present"), F.coalesce("hash", F.lit("MISSING")).alias("hash"), "size")


def verify_manifest(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """Adds ``ok`` to ``sample_id, role, path, hash``: the file is there and its hash is the recorded one."""
    now = current.select("path", F.col("hash").alias("hash_now"))
    return manifest.join(now, "path", "left").withColumn("ok", F.coalesce(F.col("hash_now") == F.col("hash"), F.lit(False)))


def approval(status: DataFrame, checked: DataFrame) -> DataFrame:
    """``sample_id, decision`` for samples of ``status`` (sample_id, status): approved only if the status is and every
    file still matches; else not_approved, no_manifest or files_changed."""
    files = checked.groupBy("sample_id").agg(F.bool_and("ok").alias("all_ok"))
    decision = F.when(F.col("all_ok").isNull(), "no_manifest").when(F.coalesce(F.col("status"), F.lit("")) != "approved", "not_approved").when(~F.col("all_ok"), "files_changed").otherwise("approved")
    return status.join(files, "sample_id", "left").select("sample_id", decision.alias("decision"))


def first_hit(listing: DataFrame, key: str, path: str, priority: Column) -> DataFrame:
    """For each key the path of the lowest priority number, ties by path."""
    return listing.groupBy(key).agg(F.min_by(path, F.struct(priority.alias("p"), F.col(path).alias("q"))).alias(path))


def numeric_part(column: Column) -> Column:
    """The first run of digits as a number, 0 without one; for ordering ids."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(column, r"(\d{1,18})", 1), F.lit("")), F.lit("999999999999999999")).cast("long"), F.lit(0).cast("long"))


def safe_name(column: Column) -> Column:
    """Everything but letters, digits, _ and - replaced by _."""
    return F.regexp_replace(column, r"[^\p{L}\p{N}_-]", "_")


def sample_and_chip(column: Column) -> tuple[Column, Column]:
    parts = F.split(column, "_", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
