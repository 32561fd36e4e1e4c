import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesselon.operators.references import key_runs, match_runs, normalize_key, orphan_references, split_key

DAY = [dt.datetime(2024, 1, d) for d in range(1, 29)]


def test_normalize(spark):
    rows = [(" tkO1 ",), ("TK01",), ("  ",), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "k string").select(normalize_key(F.col("k"))).collect()]
    assert got == ["TK01", "TK01", None, None, None]


@settings(max_examples=5, deadline=None)
@given(keys=st.lists(st.text("AB0189/", min_size=1, max_size=24), min_size=1, max_size=40, unique=True))
def test_split_is_one_to_one(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert df.select(*split_key(F.col("k"))).distinct().count() == len(keys)


def test_runs_and_match(spark):
    nums = [1, 2, 3, 7, 8, 4094, 4095, 4096, 4097, 9000]
    parents = spark.createDataFrame([("s", 4, n) for n in nums] * 2, "stem string, width int, num long")
    runs = key_runs(parents)
    assert {(r.run_start, r.run_end) for r in runs.collect()} == {(1, 3), (7, 8), (4094, 4095), (4096, 4097), (9000, 9000)}
    refs = spark.createDataFrame([("s", 4, n) for n in range(0, 9100)] + [("t", 4, 1), ("s", 3, 1)], "stem string, width int, num long")
    got = {(r.stem, r.width, r.num) for r in match_runs(refs, runs).where("in_run").collect()}
    assert got == {("s", 4, n) for n in nums}


@pytest.fixture(scope="module")
def parents(spark):
    rows = [("TK1", DAY[5], None), ("tk2 ", DAY[5], DAY[10]), ("TK2", DAY[15], None), ("TK3", DAY[20], None), (None, DAY[0], None), ("X", None, None)]
    return spark.createDataFrame(rows, "key string, since timestamp_ntz, until timestamp_ntz")


def test_kinds(spark, parents):
    rows = [
        (1, "TK1", DAY[6]), (2, "TK1", DAY[4]), (3, "TK2", DAY[10]), (4, "TK2", DAY[12]), (5, "TK2", DAY[15]), (6, "TK9", DAY[1]),
        (7, None, DAY[1]), (8, "  ", DAY[1]), (9, "TK1", None), (10, "TK3", DAY[19]), (11, "x", DAY[19]), (12, "TK1", DAY[5]), (6, "TK9", DAY[1]),
    ]
    df = spark.createDataFrame([(*r, "noise") for r in rows], "id long, ref string, t timestamp_ntz, kind string")
    got = sorted((r.record_id, r.kind) for r in orphan_references(df, "ref", "t", "id", parents, "key", "since", "until").collect())
    assert got == [(2, "late"), (3, "deleted"), (4, "deleted"), (6, "missing"), (6, "missing"), (10, "late"), (11, "late")]


def test_empty(spark, parents):
    df = spark.createDataFrame([(1, "TK1", DAY[6])], "id long, ref string, t timestamp_ntz")
    assert orphan_references(df.limit(0), "ref", "t", "id", parents, "key", "since", "until").count() == 0
    assert [r.kind for r in orphan_references(df, "ref", "t", "id", parents.limit(0), "key", "since", "until").collect()] == ["missing"]
