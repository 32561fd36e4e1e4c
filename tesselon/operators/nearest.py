"""Nearest-neighbour and range joins between two point sets, neighbour weights, spatial autocorrelation.

Points are ``id, scope, x, y``; only points of one scope meet. All joins are equi-joins on grid cells of the search
radius: one side has one copy of a point, the other nine. Points with null fields are left out.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.operators.quantiles import quantiles
from tesselon.session import materialize, small


def range_join(left: DataFrame, right: DataFrame, radius: float | Column) -> DataFrame:
    """``left_id, right_id, dist`` of all pairs at most ``radius`` apart (ids may be equal).

    The radius is a number or a column that both sides have and that depends on nothing but the scope.
    """
    r = F.lit(float(radius)) if isinstance(radius, (int, float)) else radius
    cell = lambda c: F.floor(F.col(c) / r)
    around = lambda c: F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1))
    one = right.select(F.col("id").alias("right_id"), "scope", F.col("x").alias("rx"), F.col("y").alias("ry"), cell("x").alias("cx"), cell("y").alias("cy")).na.drop()
    nine = left.select(F.col("id").alias("left_id"), "scope", "x", "y", cell("x").alias("cx"), cell("y").alias("cy"), (r * r).alias("r2")).na.drop().withColumn("cx", around("cx")).withColumn("cy", around("cy"))
    d2 = (F.col("x") - F.col("rx")) * (F.col("x") - F.col("rx")) + (F.col("y") - F.col("ry")) * (F.col("y") - F.col("ry"))
    return nine.join(one, ["scope", "cx", "cy"]).withColumn("d2", d2).where(F.col("d2") <= F.col("r2")).select("left_id", "right_id", F.sqrt("d2").alias("dist"))


def first_radii(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """``scope, edge, radius``: the extent of each scope that has right points, and a radius within which a typical
    right point has a few more than ``k`` others.

    The radius follows from the mean density, less where points crowd: a grid of that radius is counted, and if the
    cell of an average point holds more than intended, the radius shrinks to match. So the pairs that a join of this
    radius tests stay within a small multiple of the points, however uneven the density is.
    """
    wanted = k + 2.0 * math.sqrt(k) + 1.0
    both = right.select("scope", "x", "y", F.lit(1).alias("own"))
    if left is not right:
        both = both.unionByName(left.select("scope", "x", "y", F.lit(0).alias("own")))
    span = lambda c: F.max(c) - F.min(c)
    of_right = lambda c: span(F.when(F.col("own") == 1, F.col(c)))
    extent = both.groupBy("scope").agg(F.greatest(span("x"), span("y")).alias("edge"), of_right("x").alias("w"), of_right("y").alias("h"), F.sum("own").alias("n")).where("n > 0")
    even = F.greatest(F.sqrt(F.col("w") * F.col("h") * wanted / (math.pi * F.col("n"))), F.greatest("w", "h") * wanted / (2 * F.col("n")))
    mean = extent.select("scope", "edge", F.greatest(even, F.col("edge") * 1e-6, F.lit(1e-9)).alias("even"))
    cells = right.join(small(mean), "scope").groupBy("scope", "edge", "even", F.floor(F.col("x") / F.col("even")).alias("cx"), F.floor(F.col("y") / F.col("even")).alias("cy")).agg(F.count("*").alias("c"))
    crowd = cells.groupBy("scope", "edge", "even").agg((F.sum(F.col("c").cast("double") * F.col("c")) / F.sum("c")).alias("crowd"))
    usual = wanted / math.pi + 1.0
    shrunk = F.col("even") * F.least(F.lit(1.0), F.sqrt(2 * usual / F.col("crowd")))
    return crowd.select("scope", "edge", F.greatest(shrunk, F.col("edge") * 1e-6, F.lit(1e-9)).alias("radius"))


def nearest(left: DataFrame, right: DataFrame, k: int = 1, radius: float | None = None, growth: float = 3.0, same: bool = False) -> DataFrame:
    """``left_id, rank, right_id, dist``: the ``k`` nearest of ``right`` for each left point, ties to the smaller id.

    With ``same`` both are one set and a point isn't its own neighbour. A point is done when at least ``k`` lie within
    the radius, since then no other can be nearer; for the rest the radius grows until it spans their scope, where a
    point keeps what there is. Exact, whatever the first radius, which each scope has of its own (``first_radii``)
    unless one is given.
    """
    empty = left.sparkSession.createDataFrame([], "left_id long, rank int, right_id long, dist double")
    right = materialize(right.select("id", "scope", "x", "y").na.drop())
    left = right if same else materialize(left.select("id", "scope", "x", "y").na.drop())
    radii = first_radii(left, right, k)
    radii = small(radii if radius is None else radii.withColumn("radius", F.lit(float(radius))))
    there, todo = right.join(radii, "scope"), left.join(radii, "scope")
    out: list[DataFrame] = []
    times = 1.0
    while True:
        r = F.col("radius") * times
        pairs = range_join(todo, there, r)
        if same:
            pairs = pairs.where("left_id <> right_id")
        order = Window.partitionBy("left_id").orderBy("dist", "right_id")
        ranked = materialize(pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("left_id", "rank", "right_id", "dist"))
        full = ranked.where(F.col("rank") == k).select(F.col("left_id").alias("id"))
        todo = materialize(todo.where(r <= 1.5 * F.col("edge")).join(full, "id", "left_anti"))
        done = todo.isEmpty()
        out.append(ranked if done else ranked.join(todo.select(F.col("id").alias("left_id")), "left_id", "left_anti"))
        if done:
            break
        times, growth = times * growth, 4.0
    return reduce(DataFrame.unionByName, out, empty)


def map_to_nearest(left: DataFrame, right: DataFrame, cap: float = 50.0) -> DataFrame:
    """Every left point with its nearest right one, the distance and whether that is at most ``cap``."""
    found = nearest(left, right)
    return left.select(F.col("id").alias("left_id")).join(found.drop("rank"), "left_id", "left").withColumn("mapped", F.coalesce(F.col("dist") <= cap, F.lit(False)))


def match_classes(left: DataFrame, right: DataFrame, cap: float = 30.0) -> DataFrame:
    """``side, id, class``: 1to1 where two points are each other's nearest within ``cap``; other left points with a
    near right one are merged, other right ones with a near left one fragmented; the rest left_only or right_only."""
    pairs = materialize(range_join(left, right, cap))

    def closest(own: str, other: str) -> DataFrame:
        order = Window.partitionBy(own).orderBy("dist", other)
        return materialize(pairs.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("left_id", "right_id"))

    to_right, to_left = closest("left_id", "right_id"), closest("right_id", "left_id")
    mutual = materialize(to_right.join(to_left, ["left_id", "right_id"]))

    def side(points: DataFrame, own: str, found: DataFrame, name: str, loose: str, alone: str) -> DataFrame:
        state = found.select(F.col(own).alias("id"), F.lit(1).alias("near")).join(mutual.select(F.col(own).alias("id"), F.lit(1).alias("both")), "id", "left")
        kind = F.when(F.col("both") == 1, "1to1").when(F.col("near") == 1, loose).otherwise(alone)
        return points.select("id").join(state, "id", "left").select(F.lit(name).alias("side"), "id", kind.alias("class"))

    return side(left, "left_id", to_right, "left", "merged", "left_only").unionByName(side(right, "right_id", to_left, "right", "fragmented", "right_only"))


def quality_class(median: Column) -> Column:
    return F.when(median < 30, "EXCELLENT").when(median < 50, "GOOD").when(median < 100, "ACCEPTABLE").otherwise("POOR")


def alignment_metrics(left: DataFrame, right: DataFrame) -> DataFrame:
    """By scope: statistics of the distance from each left point to its nearest right one, shares strictly within 30,
    50 and 100, and the quality class."""
    found = nearest(left, right).join(left.select(F.col("id").alias("left_id"), "scope"), "left_id")
    d = F.col("dist")
    share = lambda t: (100 * F.count_if(d < t) / F.count("*")).alias(f"pct_within_{t}px")
    found = materialize(found)
    median = small(quantiles(found, ["scope"], median_distance=("dist", 0.5)))
    m = found.groupBy("scope").agg(F.count("*").alias("n"), F.avg(d).alias("mean_distance"), F.stddev_pop(d).alias("std_distance"), F.min(d).alias("min_distance"), F.max(d).alias("max_distance"), share(30), share(50), share(100))
    return m.join(median, "scope").withColumn("quality", quality_class(F.col("median_distance")))


def knn_weights(points: DataFrame, k: int = 6) -> DataFrame:
    """``src, dst, w``: the k nearest others of each point, weights of a point summing to 1."""
    edges = nearest(points, points, k, same=True)
    return edges.select(F.col("left_id").alias("src"), F.col("right_id").alias("dst"), (F.lit(1.0) / F.count("*").over(Window.partitionBy("left_id"))).alias("w"))


def distance_weights(points: DataFrame, threshold: float, binary: bool = True) -> DataFrame:
    """``src, dst, w``: all pairs of points within the threshold, in both directions; w is 1 or 1 / distance."""
    edges = range_join(points, points, threshold).where("left_id <> right_id")
    return edges.select(F.col("left_id").alias("src"), F.col("right_id").alias("dst"), F.lit(1.0).alias("w") if binary else F.try_divide(F.lit(1.0), "dist").alias("w"))


def morans_i(values: DataFrame, weights: DataFrame) -> DataFrame:
    """``scope, feature, n, i, expected_i, z`` from ``id, scope, feature, value`` and ``src, dst, w``.

    ``z`` is the distance from the expected value in standard deviations under normality, from the sums S0, S1 and S2
    of the weights between points that have the feature. A constant feature, or one without weights, has a null ``i``.
    Missing values leave their point out.
    """
    rows = values.where("value is not null")
    stats = rows.groupBy("scope", "feature").agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    z = rows.join(small(stats.select("scope", "feature", "m")), ["scope", "feature"]).select("id", "scope", "feature", (F.col("value") - F.col("m")).alias("z"))
    z = materialize(z)
    squares = z.groupBy("scope", "feature").agg(F.sum(F.col("z") * F.col("z")).alias("zz"))
    there = z.select(F.col("id").alias("dst"), "feature", F.col("z").alias("z2"))
    back = weights.select(F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("w").alias("back"))
    both = weights.join(back, ["src", "dst"], "left").select("src", "dst", "w", F.coalesce("back", F.lit(0.0)).alias("back"))
    edges = both.join(z.withColumnRenamed("id", "src"), "src").join(there, ["dst", "feature"])
    out = edges.groupBy("scope", "feature", F.col("src").alias("id")).agg(F.sum(F.col("w") * F.col("z") * F.col("z2")).alias("wzz"), F.sum("w").alias("w"), F.sum(F.col("w") * (F.col("w") + F.col("back"))).alias("s1"))
    into = edges.groupBy("scope", "feature", F.col("dst").alias("id")).agg(F.lit(0.0).alias("wzz"), F.sum("w").alias("w"), F.lit(0.0).alias("s1"))
    ends = out.withColumn("s0", F.col("w")).unionByName(into.withColumn("s0", F.lit(0.0))).groupBy("scope", "feature", "id").agg(F.sum("wzz").alias("wzz"), F.sum("w").alias("w"), F.sum("s1").alias("s1"), F.sum("s0").alias("s0"))
    sums = ends.groupBy("scope", "feature").agg(F.sum("wzz").alias("wzz"), F.sum("s0").alias("s0"), F.sum("s1").alias("s1"), F.sum(F.col("w") * F.col("w")).alias("s2"))
    n = F.col("n").cast("double")
    i = F.when((F.col("zz") > 1e-12) & (F.col("s0") > 0), n / F.col("s0") * F.col("wzz") / F.col("zz"))
    expected = F.when(n > 1, -1 / (n - 1))
    variance = F.try_divide(n * n * F.col("s1") - n * F.col("s2") + 3 * F.col("s0") * F.col("s0"), (n * n - 1) * F.col("s0") * F.col("s0")) - expected * expected
    found = stats.join(squares, ["scope", "feature"]).join(sums, ["scope", "feature"], "left")
    return found.select("scope", "feature", "n", i.alias("i"), expected.alias("expected_i"), F.when(variance > 1e-15, (i - expected) / F.sqrt(variance)).alias("z"))


def permuted_p(values: DataFrame, weights: DataFrame, permutations: int = 99, seed: int = 0) -> DataFrame:
    """``scope, feature, p_sim``: share of random rearrangements of the values with an I at least as far out.

    A rearrangement gives each point the value at its place in a hash order of the same scope and feature, so all of
    them are one job and repeatable: (extreme + 1) / (permutations + 1), one-sided towards the observed side.
    """
    rows = values.where("value is not null")
    fixed = Window.partitionBy("scope", "feature").orderBy("id")
    placed = rows.withColumn("k", F.row_number().over(fixed))
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
    order = Window.partitionBy("scope", "feature", "run").orderBy(F.xxhash64("id", "run", F.lit(seed)), "id")
    drawn = runs.select("scope", "feature", "run", "value", F.row_number().over(order).alias("k"))
    moved = drawn.join(placed.select("scope", "feature", "k", "id"), ["scope", "feature", "k"]).select("id", "scope", F.to_json(F.struct("feature", "run")).alias("feature"), "value")
    found = morans_i(moved, weights).select("scope", F.get_json_object("feature", "$.feature").alias("feature"), F.col("i").alias("drawn"))
    real = morans_i(rows, weights).select("scope", "feature", "i", "expected_i")
    out = F.when(F.col("i") >= F.col("expected_i"), F.col("drawn") >= F.col("i")).otherwise(F.col("drawn") <= F.col("i"))
    return found.join(real, ["scope", "feature"]).groupBy("scope", "feature").agg(((F.count_if(out) + 1) / (F.count("*") + 1)).alias("p_sim"))


def nearest_vectors(left: DataFrame, right: DataFrame, vectors: DataFrame, cap: float) -> DataFrame:
    """``left_id, right_id, vector``: the vector (``id, vector``) of the nearest right point at most ``cap`` away.

    Farther ones, and points with none, have a null ``right_id`` and a vector of zeros as long as the longest there is.
    """
    pairs = range_join(left, right, cap)
    closest = pairs.groupBy("left_id").agg(F.min(F.struct("dist", "right_id")).alias("c")).select("left_id", F.col("c.right_id").alias("right_id"))
    width = vectors.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("d"))
    found = left.select(F.col("id").alias("left_id")).join(closest, "left_id", "left").join(vectors.select(F.col("id").alias("right_id"), "vector"), "right_id", "left")
    zeros = F.transform(F.sequence(F.lit(1), F.greatest(F.col("d"), F.lit(1))), lambda _: F.lit(0.0))
    return found.join(F.broadcast(width)).select("left_id", "right_id", F.coalesce("vector", F.when(F.col("d") > 0, zeros)).alias("vector"))  # one row


def annotate(points: DataFrame, labelled: DataFrame, label: str, cap: float = 30.0) -> DataFrame:
    """``id, label, source``: a point's own label, else that of the nearest labelled point at most ``cap`` away, else null.

    ``points`` have ``id, scope, x, y`` and the label, null where unknown; ties go to the smaller id.
    """
    known = points.where(F.col(label).isNotNull()).select("id", F.col(label).alias("label"), F.lit("own").alias("source"))
    open_ = points.where(F.col(label).isNull())
    pairs = range_join(open_, labelled.where(F.col(label).isNotNull()), cap)
    closest = pairs.groupBy("left_id").agg(F.min(F.struct("dist", "right_id")).alias("c")).select(F.col("left_id").alias("id"), F.col("c.right_id").alias("right_id"))
    names = labelled.select(F.col("id").alias("right_id"), F.col(label).alias("label"))
    near = open_.select("id").join(closest, "id", "left").join(names, "right_id", "left")
    return known.unionByName(near.select("id", "label", F.when(F.col("label").isNotNull(), "nearest").alias("source")))
