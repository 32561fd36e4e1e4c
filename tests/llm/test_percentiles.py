import random

import numpy as np
import pytest

from tesselon.llm import percentiles as P

QS = [0.0, 0.1, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    values = [lambda: rnd.gauss(0, 1e3), lambda: rnd.choice([0.0, -0.0, 1.0]), lambda: rnd.choice([1e-310, -1e300, 5e-324, 1e300]), lambda: float(rnd.randrange(5))]
    out = [(f"g{k}", f()) for k, f in enumerate(values) for _ in range(400)]
    out += [("g0", None), ("g0", float("nan")), (None, 1.0), ("single", 3.5), ("nothing", None), ("inf", float("inf")), ("inf", 1.0), ("inf", 2.0)]
    return out


def keys(spark, rows):
    df = spark.createDataFrame([(g, v, 1, "z") for g, v in rows], "grp string, value double, key int, field_name string")
    return P.measure_keys(df, "grp", "value")


def expected(rows):
    by = {}
    for g, v in rows:
        if g is not None and v is not None and v == v:
            by.setdefault(g, []).append(v)
    return {(g, q): float(np.quantile(v, q)) for g, v in by.items() for q in QS if not (g == "inf" and q == 0.99)}


def test_exact(spark, rows):
    got = {(r.grp, r.q): r.value for r in P.exact_percentiles(keys(spark, rows), QS).collect()}
    want = expected(rows)
    assert {g for g, _ in got} == {g for g, _ in want}
    for k, v in want.items():
        if np.isfinite(v):
            assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-300)


def test_bounds_from_merged_parts(spark, rows):
    parts = [P.digit_histogram(keys(spark, rows[k::3]), 20) for k in range(3)]
    got = {(r.grp, r.q): (r.low, r.high) for r in P.bounded_percentiles(P.merge_histograms(parts), 20, QS).collect()}
    for k, v in expected(rows).items():
        if np.isfinite(v) and k[0] in ("g0", "g3", "single"):
            low, high = got[k]
            assert low <= v <= high
            if k[0] == "single":
                assert high - low <= abs(v) * 2**-8


def test_empty(spark):
    assert P.exact_percentiles(keys(spark, []), [0.5]).count() == 0
    assert P.bounded_percentiles(P.digit_histogram(keys(spark, [])), 16, [0.5]).count() == 0
