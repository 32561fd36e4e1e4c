"""Session, table access and the few helpers every operator shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it was counted and has at most this many rows ...
BROADCAST_ROWS = 200_000
#: ... and rows times columns stay under this many values.
BROADCAST_VALUES = 1_000_000
#: ... and its estimated size (of the files read, compressed) this many bytes.
BROADCAST_BYTES = 24_000_000


def get_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and bench runs; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tesselon")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate tables; a temporary one only where none is set on a local master (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"tesselon-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/tesselon-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, *partition_by: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The table outlives any executor, so a lost executor costs a re-read and no recomputation. It runs while a query is
    being built; ``discard`` deletes a table that nothing reads any more, ``clear`` all of the application's.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/t-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``materialize`` once whatever was built on them has been written."""
    for t in tables:
        own = shared_folder(t.sparkSession).split(":")[-1]
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles() if own in f}:
            _delete(t.sparkSession, folder)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of the application; results that were not written before are lost."""
    _delete(spark, shared_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows and its size are under the bounds, else without one.

    What isn't a plain scan is written first, so that it is computed once and not again for the join; pass ``rows``
    when the count is known. Without a hint the join shuffles, and adaptive execution splits partitions that are
    skewed on the other side.
    """
    if rows is None:
        df = df if _is_scan(df) else materialize(df)
        rows = df.limit(BROADCAST_ROWS + 1).count()
    if rows > BROADCAST_ROWS or rows * len(df.columns) > BROADCAST_VALUES:
        return df
    plain = all(f.dataType.typeName() in PLAIN for f in df.schema.fields)
    return F.broadcast(df) if plain or df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= BROADCAST_BYTES else df  # noqa: SLF001


#: Types of a fixed size, for which the number of values bounds the bytes.
PLAIN = {"long", "integer", "short", "byte", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz"}


def _is_scan(df: DataFrame) -> bool:
    """Whether ``df`` only reads and filters a table."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    return all(re.match(r"\W*(Project|Filter|Relation|LogicalRelation|LocalRelation)\b", line) for line in plan.splitlines() if line.strip())


def clean(column: Column | str) -> Column:
    """A double with NaN turned into null, so that aggregates and comparisons skip it."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(c), c)
