import random

from tesselon.operators.skew import key_summary, top_k_per_key

SCHEMA = "disease string, phenotype string, n long, id long, _m string, rank string, `odd name` int"


def brute(rows, k):
    by = {}
    for d, p, n, i, *_ in rows:
        if None not in (d, p, n, i):
            by.setdefault((d, p), set()).add((-n, i))
    return {(*key, i) for key, found in by.items() for _, i in sorted(found)[:k]}


def test_top_k_against_brute_force(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(3000):
        d = "big" if rnd.random() < 0.8 else rnd.choice(["a", "b", None])
        rows.append((d, rnd.choice(["x", "x", "x", "y", None]), rnd.choice([None, *range(15)]), rnd.choice([i, i, 7, None]), "z", None, 1))
    fixed = {}
    for r in rows:  # one measure and key for each record
        fixed.setdefault(r[3], r)
    rows = [fixed[r[3]] if r[3] is not None else r for r in rows] * 2
    got = top_k_per_key(spark.createDataFrame(rows, SCHEMA), ["disease", "phenotype"], "n", "id", 3)
    assert {(r.disease, r.phenotype, r.id) for r in got.collect()} == brute(rows, 3)


def test_top_k_all_tied(spark):
    rows = [("d", "p", 5, i, None, None, None) for i in range(500)]
    got = top_k_per_key(spark.createDataFrame(rows, SCHEMA), ["disease", "phenotype"], "n", "id", 3).orderBy("rank").collect()
    assert [(r.id, r.rank) for r in got] == [(0, 1), (1, 2), (2, 3)]


def test_top_k_empty_and_nan(spark):
    assert top_k_per_key(spark.createDataFrame([], SCHEMA), ["disease", "phenotype"], "n", "id").count() == 0
    df = spark.createDataFrame([("a", float("nan"), 1), ("a", 1.0, 2), ("a", None, 3)], "k string, v double, id long")
    assert [r.id for r in top_k_per_key(df, ["k"], "v", "id").collect()] == [2]


def test_summary_counts_a_record_once(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 2.0), ("a", 2, None), ("a", 3, float("nan")), (None, 4, 1.0), ("b", None, 1.0)], "k string, id long, v double")
    got = key_summary(df, ["k"], "id", ["v"]).collect()
    assert [(r.k, r.n_records, r.n_v, r.sum_v, r.avg_v) for r in got] == [("a", 3, 1, 2.0, 2.0)]
    assert key_summary(df.limit(0), ["k"], "id", ["v"]).count() == 0
