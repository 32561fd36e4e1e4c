import math
import random

import pytest
from pyspark.sql import functions as F

from tesselon.operators.proximity import cover_regions, inside_regions, near_and_nearest, nearest_beyond, points_of, strictly_inside

POINT = "id long, scope string, spatial array<double>, flag boolean, x string, tx int"


def make(spark, rows):
    return points_of(spark.createDataFrame([(*r, "noise", 0) for r in rows], POINT), "id", "scope", "spatial", "flag")


def brute(rows, near, reach):
    seen = {i: (s, p, f) for i, s, p, f in rows if None not in (i, s, p) and len(p) > 1 and all(v is not None and math.isfinite(v) for v in p)}
    pairs, nearest = set(), {}
    for i, (s, p, f) in seen.items():
        best = None
        for j, (t, q, _) in seen.items():
            if s == t and i != j:
                d = (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
                if d <= near * near and i < j:
                    pairs.add((i, j))
                if best is None or (d, j) < best:
                    best = (d, j)
        if f is not None:
            nearest[i] = best
    return pairs, {i: b and (b[1] if b[0] <= reach * reach else None) for i, b in nearest.items()}, {i: b[1] for i, b in nearest.items() if b}


@pytest.mark.parametrize("hot", [250_000, 30])
def test_near_and_nearest(spark, hot):
    from tesselon.operators.proximity import sweep, with_tiles

    rnd = random.Random(3)
    rows = [(i, rnd.choice("ab"), [rnd.randrange(-400, 400) / 2, rnd.randrange(-400, 400) / 2], rnd.choice([True, False, None])) for i in range(600)]
    rows += [(1000 + i, "a", [50.0 + rnd.random() * 8, 50.0], True) for i in range(60)]
    rows += [(2000, "a", None, True), (2001, "a", [1.0], True), (2002, "a", [float("nan"), 1.0], True), (2003, None, [1.0, 1.0], True), (2004, "c", [0.0, 0.0], True), (2005, "a", [3000.0, 0.0], True)]
    rows = rows + rows[:200]
    points = make(spark, rows)
    pairs, within, overall = brute(rows, 5, 12)
    got = sweep(with_tiles(points, 12.0, hot), 5.0, 12.0).collect()
    near = [(r.left_id, r.right_id) for r in got if r.kind == 0]
    assert len(near) == len(set(near)) and set(near) == pairs
    assert {r.left_id: r.right_id for r in got if r.kind == 1} == within
    lonely = points.where(F.col("id").isin([i for i, j in within.items() if j is None])).distinct()
    beyond = {r.left_id: r.right_id for r in nearest_beyond(lonely, points, 12.0).collect()}
    assert beyond == {i: overall[i] for i, j in within.items() if j is None and i in overall}


def test_empty_points(spark):
    points = make(spark, [])
    assert near_and_nearest(points, 5.0, 12.0).count() == 0
    assert nearest_beyond(points, points, 12.0).count() == 0


RINGS = [
    (1, "a", [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]], [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]]),
    (2, "a", [[[0.0, 0.0], [0.0, 300.0], [150.0, 40.0], [300.0, 300.0], [300.0, 0.0], [0.0, 0.0]]]),
    (3, "a", [[[0.0, 0.0], [5.0, 5.0]]]),
    (4, "a", None),
    (5, "b", [[[-5.0, -5.0], [5.0, -5.0], None, [0.0, 5.0]]]),
    (6, "a", []),
    (7, None, [[[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]]]),
]


def inside(ring, x, y):
    ring = [p for p in ring if p is not None]
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        t = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if t == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return None
        if (ay > y) != (by > y) and (t > 0) == (by > ay):
            odd = not odd
    return odd


def test_inside_regions(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "a", "b"]), [rnd.randrange(-10, 320) * 1.0, rnd.randrange(-10, 320) * 1.0], None) for i in range(1500)]
    rows += [(5000 + k, "a", [x * 0.5, y * 0.5], None) for k, (x, y) in enumerate((x, y) for x in range(-1, 22) for y in range(-1, 22))]
    points = make(spark, rows + rows[:50])
    cover = cover_regions(spark.createDataFrame([(*r, 9.0) for r in RINGS], "region_id long, scope string, rings array<array<array<double>>>, side double"), "region_id", "scope", "rings")
    got = [(r.id, r.region_id) for r in inside_regions(points, cover).collect()]
    want = set()
    for i, s, (x, y), _ in rows:
        for rid, scope, rings in RINGS:
            if scope == s and rings and len({tuple(p) for p in rings[0] if p}) > 2 and inside(rings[0], x, y) and all(inside(h, x, y) is False for h in rings[1:]):
                want.add((i, rid))
    assert len(got) == len(set(got)) and set(got) == want
    assert cover.where("inner").count() > 0


def test_inside_nothing(spark):
    cover = cover_regions(spark.createDataFrame([], "region_id long, scope string, rings array<array<array<double>>>"), "region_id", "scope", "rings")
    assert inside_regions(make(spark, [(1, "a", [0.0, 0.0], None)]), cover).count() == 0


def test_strictly_inside_border(spark):
    df = spark.createDataFrame([(5.0, 5.0), (0.0, 5.0), (10.0, 10.0), (5.0, 0.0), (4.0, 5.0), (1.0, 1.0)], "x double, y double")
    rings = F.lit([[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]], [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]])
    assert [r[0] for r in df.select(strictly_inside(rings, F.col("x"), F.col("y"))).collect()] == [False, False, False, False, False, True]


def test_outlier_and_pile_stay_in_small_groups(spark):
    """A far outlier, a pile of equal places and a dense field: exact, and no more than a few cells reach an outlier."""
    rnd = random.Random(9)
    rows = [(i, "a", [rnd.random() * 2_000, rnd.random() * 2_000], True) for i in range(4_000)]
    rows += [(10_000 + i, "a", [9_000.0, 9_000.0], True) for i in range(500)] + [(20_000, "a", [-60_000.0, 3.0], True), (20_001, "a", [9_400.0, 9_000.0], True), (20_002, "b", [0.0, 0.0], True)]
    points = make(spark, rows + rows[-3:])
    lonely = points.where("id >= 20000").distinct()
    _, _, overall = brute([r for r in rows if r[0] < 10_000 or r[0] >= 20_000] + [rows[4_000]], 1, 12)
    got = {r.left_id: r.right_id for r in nearest_beyond(lonely, points, 12.0).collect()}
    assert got == {i: overall[i] for i in (20_000, 20_001)}


def test_border_cells_carry_their_own_edges(spark):
    """A ring of many corners and holes that overlap: cells are cut until few edges are left in each."""
    n = 400
    star = [[500 + (480 - 60 * (k % 2)) * math.cos(2 * math.pi * k / n), 500 + (480 - 60 * (k % 2)) * math.sin(2 * math.pi * k / n)] for k in range(n)]
    holes = [[[300.0, 300.0], [500.0, 300.0], [500.0, 500.0], [300.0, 500.0]], [[400.0, 400.0], [600.0, 400.0], [600.0, 600.0], [400.0, 600.0]], [[900.0, 900.0], [1200.0, 900.0], [1200.0, 1200.0], [900.0, 1200.0]]]
    cover = cover_regions(spark.createDataFrame([(1, "a", [star, *holes])], "region_id long, scope string, rings array<array<array<double>>>"), "region_id", "scope", "rings").cache()
    most = cover.where("not inner").select(F.max(F.size(F.flatten(F.transform("rings", lambda r: r["edges"]))))).first()[0]
    assert most <= 8
    rnd = random.Random(4)
    rows = [(i, "a", [rnd.random() * 1_000, rnd.random() * 1_000], None) for i in range(2_000)] + [(5_000 + k, "a", [100.0 * (k % 10), 100.0 * (k // 10)], None) for k in range(100)]
    got = {r.id for r in inside_regions(make(spark, rows), cover).collect()}
    assert got == {i for i, _, (x, y), _ in rows if inside(star, x, y) and all(inside(h, x, y) is False for h in holes)}
