"""Components, neighbourhood features, communities, cluster quality, ring simplification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselon.session import materialize, small


def _components(df: DataFrame, record_id: str, vector: str, k: int):
    """The centred vectors and the fitted model. The covariance is one distributed aggregate; only its features by
    features matrix reaches the driver."""
    zeroed = F.transform(F.col(f"`{vector}`"), lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)))
    rows = df.where(F.col(f"`{vector}`").isNotNull()).select(F.col(f"`{record_id}`").alias("id"), zeroed.alias("v"))
    widths = rows.select(F.size("v").alias("d")).distinct().limit(2).collect()
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths in {vector}")
    d = widths[0][0] if widths else 0
    means = rows.agg(*[F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(d)]).first() if d else []
    centred = rows.select("id", array_to_vector(F.transform("v", lambda x, i: x - F.get(F.array(*[F.lit(float(m)) for m in means]), i))).alias("features"))
    return centred, PCA(k=min(k, max(d, 1)), inputCol="features", outputCol="scores").fit(centred)


def principal_components(df: DataFrame, record_id: str, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """``id, scores`` of centred vectors, and ``component, ratio`` of explained variance.

    Null vectors are left out, null and NaN entries count as 0; all vectors must be of one length.
    """
    centred, model = _components(df, record_id, vector, k)
    ratios = [(i + 1, float(r)) for i, r in enumerate(model.explainedVariance)]
    return model.transform(centred).select("id", vector_to_array("scores").alias("scores")), df.sparkSession.createDataFrame(ratios, "component int, ratio double")


def component_loadings(df: DataFrame, record_id: str, vector: str, k: int) -> DataFrame:
    """``component, position, loading``: how much each position of the vector counts in each component; the sign is such
    that a component's largest loading is positive. As many rows as components times positions."""
    loads = _components(df, record_id, vector, k)[1].pc.toArray()
    loads = loads * np.sign(loads[np.abs(loads).argmax(0), np.arange(loads.shape[1])])
    return df.sparkSession.createDataFrame([(c + 1, p, float(v)) for (p, c), v in np.ndenumerate(loads)], "component int, position int, loading double")


def covariance(df: DataFrame, vector: str, width: int) -> DataFrame:
    """``i, j, covariance`` (population) of the first ``width`` positions, i <= j; one aggregate over the rows, no pairs of
    features as rows. Rows without a value at a position don't count for its pairs; null vectors count for none."""
    at = lambda k: F.nullif(F.get(F.col(f"`{vector}`"), F.lit(k)).cast("double"), F.lit(float("nan")))
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    wide = df.agg(*[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"c{i}_{j}").alias("covariance")) for i, j in pairs])).alias("p")).select("p.*")


def component_scores(df: DataFrame, record_id: str, vector: str, top: int = 10) -> DataFrame:
    """``id, score``: one value for each record, its ``top`` components weighted by their share of the variance."""
    scores, ratios = principal_components(df, record_id, vector, top)
    share = [r["ratio"] for r in ratios.orderBy("component").collect()]
    weights = F.array(*[F.lit(w / (sum(share) or 1.0)) for w in share])
    return scores.select("id", F.aggregate(F.zip_with("scores", weights, lambda s, w: s * w), F.lit(0.0), lambda a, x: a + x).alias("score"))


def neighbour_means(long: DataFrame, weights: DataFrame) -> DataFrame:
    """``obs, feature, around``: each feature's weighted mean over an observation's neighbours (src, dst, w)."""
    moved = weights.join(long.select(F.col("obs").alias("dst"), "feature", "value"), "dst").where("value is not null")
    return moved.groupBy(F.col("src").alias("obs"), "feature").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("around"))


def with_neighbourhood(long: DataFrame, weights: DataFrame, mix: float = 0.8) -> DataFrame:
    """Own features scaled by sqrt(1 - mix) and neighbour means, named ``<feature>_nbr``, by sqrt(mix), in long form."""
    own = long.select("obs", "feature", (F.col("value") * float(np.sqrt(1 - mix))).alias("value"))
    near = neighbour_means(long, weights).select("obs", F.concat("feature", F.lit("_nbr")).alias("feature"), (F.col("around") * float(np.sqrt(mix))).alias("value"))
    return own.unionByName(near)


def connected(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each node of ``a, b`` reaches.

    Each round a node takes the smallest label around it, then the label of its label, until none changes: rounds follow
    the logarithm of the widest component's extent for most graphs. Minima are combined on the map side.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = materialize(labels.join(around, "node").select("node", "label", F.least("label", "near").alias("next")))
        jumped = stepped.join(stepped.select(F.col("node").alias("next"), F.col("next").alias("far")), "next", "left")
        after = materialize(jumped.select("node", "label", F.least("next", F.coalesce("far", F.col("next"))).alias("new")))
        labels = after.select("node", F.col("new").alias("label"))
        if after.where("new <> label").isEmpty():
            return labels


def communities(edges: DataFrame, together: int = 8) -> DataFrame:
    """``node, community`` by weighted label propagation on ``src, dst, w`` taken in both directions, until no node gains.

    In the first ``together`` rounds all nodes move at once to the label of the largest weight around them, ties to the
    smaller label; the own label counts with the node's mean weight, which keeps pairs from swapping. After that only
    nodes that gain by moving do, and of neighbours that would the one with the larger hash. Each such round adds to the
    weight within communities, so the rounds come to an end; only nodes next to a change are looked at. A table is
    written in each round, so that a lost executor costs one round at most.
    """
    both = edges.select("src", "dst", "w").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    own = both.groupBy("src").agg(F.avg("w").alias("w")).select("src", F.col("src").alias("dst"), "w")
    plain = materialize(both.where("src <> dst"))
    looped = materialize(plain.unionByName(own))
    labels = materialize(looped.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node")))
    better = F.max_by("community", F.struct("w", (-F.col("community")).alias("c")))
    for _ in range(together):
        votes = looped.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy("src", "community").agg(F.round(F.sum("w"), 9).alias("w"))
        labels = materialize(votes.groupBy(F.col("src").alias("node")).agg(better.alias("community")))
    look: DataFrame | None = None
    turn = 0
    while True:
        asked = plain if look is None else plain.join(small(look), "src", "left_semi")
        votes = asked.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy("src", "community").agg(F.round(F.sum("w"), 9).alias("w"))
        now = labels.select(F.col("node").alias("src"), F.col("community").alias("now"))
        best = votes.join(now, "src").groupBy("src", "now").agg(better.alias("new"), F.max("w").alias("most"), F.coalesce(F.max(F.when(F.col("community") == F.col("now"), F.col("w"))), F.lit(0.0)).alias("has"))
        wish = materialize(best.where("most > has").select("src", "new", F.xxhash64("src", F.lit(turn)).alias("key")))
        if wish.isEmpty():
            return labels
        mine, theirs = small(wish.select("src", "key")), small(wish.select(F.col("src").alias("dst"), F.col("key").alias("key_2")))
        beaten = plain.join(mine, "src").join(theirs, "dst").where("key_2 > key or (key_2 = key and dst > src)").select("src").distinct()
        moved = materialize(wish.join(beaten, "src", "left_anti").select("src", "new"))
        labels = materialize(labels.join(small(moved.withColumnRenamed("src", "node")), "node", "left").select("node", F.coalesce("new", "community").alias("community")))
        look = materialize(plain.join(small(moved.select(F.col("src").alias("dst"))), "dst", "left_semi").select("src").unionByName(wish.select("src")).distinct())
        turn += 1


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row: Newman's modularity of the labels on the undirected weighted edges."""
    one = lambda c: small(labels.select(F.col("node").alias(c), F.col("community").alias(f"c_{c}")))
    e = edges.join(one("src"), "src").join(one("dst"), "dst")
    inside = e.agg(F.sum(F.when(F.col("c_src") == F.col("c_dst"), F.col("w")).otherwise(0.0)).alias("inside"), F.sum("w").alias("m"))
    ends = e.select(F.col("c_src").alias("c"), "w").unionByName(e.select(F.col("c_dst").alias("c"), "w")).groupBy("c").agg(F.sum("w").alias("d"))
    squares = ends.agg(F.sum(F.col("d") * F.col("d")).alias("dd"))
    return inside.join(F.broadcast(squares)).select((F.col("inside") / F.col("m") - resolution * F.col("dd") / (4 * F.col("m") * F.col("m"))).alias("modularity"))  # one row each


def cluster_sizes(labels: DataFrame, column: str) -> DataFrame:
    """One row: number of clusters, records, smallest and largest size; null labels are left out."""
    sizes = labels.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("n_clusters"), F.sum("n").alias("n_records"), F.min("n").alias("min_size"), F.max("n").alias("max_size"))


def silhouette(df: DataFrame, vector: str, label: str) -> float:
    """Mean simplified silhouette with squared Euclidean distances (linear in the rows). Labels are integers."""
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"), F.col(label).cast("int").alias("prediction")).na.drop()
    return ClusteringEvaluator().evaluate(rows)


def simplify_ring(ring: Column, tolerance: float) -> Column:
    """Douglas-Peucker on a ring, closed in the result; rings that would keep fewer than four points stay as they are."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(rings: pd.Series) -> pd.Series:
        return rings.map(lambda r: None if r is None else _simplify(np.array([list(p) for p in r], float).reshape(-1, 2), tolerance))

    return run(ring)


def _simplify(points: np.ndarray, tolerance: float) -> list[list[float]]:
    if len(points) and (points[0] != points[-1]).any():
        points = np.vstack([points, points[:1]])
    if len(points) < 5:
        return points.tolist()
    # a closed ring is cut at its farthest vertex, so that both halves have different ends
    far = int(((points - points[0]) ** 2).sum(1).argmax())
    keep = np.zeros(len(points), bool)
    keep[[0, far, len(points) - 1]] = True
    stack = [(0, far), (far, len(points) - 1)]
    while stack:
        i, j = stack.pop()
        if j <= i + 1:
            continue
        a, d = points[i], points[j] - points[i]
        between = points[i + 1 : j] - a
        length = np.hypot(*d)
        off = np.abs(d[0] * between[:, 1] - d[1] * between[:, 0]) / length if length else np.hypot(between[:, 0], between[:, 1])
        k = int(off.argmax())
        if off[k] > tolerance:
            keep[i + 1 + k] = True
            stack += [(i, i + 1 + k), (i + 1 + k, j)]
    return (points[keep] if keep.sum() >= 4 else points).tolist()
