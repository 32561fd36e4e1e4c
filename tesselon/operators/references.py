"""References to records that do not exist (problem 3).

Method: parent keys are split into a stem and an integer, sorted and compressed into contiguous runs; a reference is
matched as-of to the run that starts at or before it and is reported as missing if it lies beyond that run's end.
References that fall into a run are then held against the life of that one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.session import materialize, small

#: Width of the key ranges that one window group may cover.
RANGE = 4096


def normalize_key(column: Column) -> Column:
    """Trimmed of blanks, upper case, the letter O read as the digit 0; null for null and blank."""
    c = F.translate(F.upper(F.regexp_replace(column.cast("string"), r"^\s+|\s+$", "")), "O", "0")
    return F.when(c != "", c)


def split_key(column: Column) -> list[Column]:
    """``stem, width, num``: the key without its longest digit run, the length of that run, its value.

    One to one with the key. Of several runs of that length the one largest as text is taken, of more than 18 digits
    the first 18; a key without digits has width 0.
    """
    runs = F.transform(F.regexp_extract_all(column, F.lit(r"[0-9]+"), 0), lambda d: F.struct(F.length(d), d.alias("d")))
    digits = F.coalesce(F.substring(F.array_max(runs)["d"], 1, 18), F.lit(""))
    start = F.instr(column, digits)
    head = F.substring(column, F.lit(1), start - 1)
    tail = F.substring(column, start + F.length(digits), F.length(column))
    return [
        F.concat(head, F.lit("\u0001"), tail).alias("stem"),
        F.length(digits).alias("width"),
        F.when(digits != "", digits.cast("long")).otherwise(F.lit(0).cast("long")).alias("num"),
    ]


def key_runs(keys: DataFrame) -> DataFrame:
    """``stem, width, block, run_start, run_end``: contiguous runs of the integer keys of ``stem, width, num``.

    Runs are cut at multiples of ``RANGE``, so that sorting needs no more than ``RANGE`` keys in one group however many
    keys share a stem.
    """
    order = Window.partitionBy("stem", "width", "block").orderBy("num")
    return (
        keys.select("stem", "width", "num", F.floor(F.col("num") / RANGE).alias("block"))
        .distinct()
        .withColumn("island", F.col("num") - F.row_number().over(order))
        .groupBy("stem", "width", "block", "island")
        .agg(F.min("num").alias("run_start"), F.max("num").alias("run_end"))
        .drop("island")
    )


def match_runs(references: DataFrame, runs: DataFrame) -> DataFrame:
    """Distinct ``stem, width, num`` with ``in_run``: whether the run starting at or before ``num`` reaches it.

    As-of match: references and run starts are sorted together in their range of keys and the last run's end is carried
    forward. Only distinct keys take part, so a reference that a third of all rows make is one row here.
    """
    wanted = references.select("stem", "width", "num").distinct().select("stem", "width", F.floor(F.col("num") / RANGE).alias("block"), "num", F.lit(None).cast("long").alias("run_end"), F.lit(1).alias("is_ref"))
    starts = runs.select("stem", "width", "block", F.col("run_start").alias("num"), "run_end", F.lit(0).alias("is_ref"))
    order = Window.partitionBy("stem", "width", "block").orderBy("num", "is_ref").rowsBetween(Window.unboundedPreceding, 0)
    return (
        wanted.unionByName(starts)
        .withColumn("end", F.last("run_end", ignorenulls=True).over(order))
        .where("is_ref = 1")
        .select("stem", "width", "num", F.coalesce(F.col("num") <= F.col("end"), F.lit(False)).alias("in_run"))
    )


def orphan_references(
    references: DataFrame, reference: str, at: str, record_id: str, parents: DataFrame, parent_key: str, registered: str, deleted: str
) -> DataFrame:
    """``record_id, kind, at`` of each row of ``references`` whose key isn't alive at its time.

    ``kind`` is ``missing`` (no parent row has the key), ``late`` (all its rows are registered after that time) or
    ``deleted``. Keys are compared by ``normalize_key``. Null or blank references and null times are no cases; parent
    rows with a null key don't exist; a parent row never registered (null) is never alive and counts as late. Repeated
    reference rows are reported as often as they come. An empty parent table makes every reference ``missing``.
    """
    refs = references.select(F.col(f"`{record_id}`").alias("record_id"), F.col(f"`{at}`").alias("at"), normalize_key(F.col(f"`{reference}`")).alias("key")).where("key is not null and at is not null")
    life = (
        parents.select(normalize_key(F.col(f"`{parent_key}`")).alias("key"), F.col(f"`{registered}`").alias("since"), F.col(f"`{deleted}`").alias("until"))
        .where("key is not null")
        .groupBy("key")
        .agg(F.collect_set(F.struct("since", "until")).alias("lives"))
    )
    split = split_key(F.col("key"))
    runs = key_runs(life.select(*split))
    status = match_runs(refs.select("key").distinct().select(*split), runs)
    known = materialize(status.join(life.select(*split, "lives"), ["stem", "width", "num"], "left"))
    found = refs.select("record_id", "at", *split).join(small(known), ["stem", "width", "num"], "left")
    alive = F.exists("lives", lambda x: (x.since <= F.col("at")) & (x.until.isNull() | (x.until > F.col("at"))))
    begun = F.exists("lives", lambda x: x.since <= F.col("at"))
    kind = F.when(~F.col("in_run"), "missing").when(~F.coalesce(begun, F.lit(False)), "late").when(~F.coalesce(alive, F.lit(False)), "deleted")
    return found.select("record_id", kind.alias("kind"), "at").where("kind is not null")
