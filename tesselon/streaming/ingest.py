"""Incremental ingestion: what has landed since the last run, once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselon.session import shared_folder


def ingest_available(spark: SparkSession, source: str, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """Reads the Parquet files at ``source`` that this ``target`` hasn't taken in yet, as a stream that ends when none
    is left, and gives the whole target. Progress lies beside the target, so a second run adds new files alone and a
    broken one resumes. Without a target a new one is made in the shared folder."""
    target = target or f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"
    schema = spark.read.parquet(source).schema
    # as a pattern, the source may be a folder or a single file
    pattern = source if set(source) & set("*?[{") else f"{source[:-1]}[{source[-1]}]"
    rows = spark.readStream.schema(schema).parquet(pattern).select(*columns)
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{target}/_progress").option("path", f"{target}/rows").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{target}/rows")


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Streaming count by key and tumbling window; rows later than ``late`` behind the newest are dropped by the
    watermark, and a window is given out once it can't change any more."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("since"), key, "n")
