"""Two-dimensional density: weighted bins and windows of high density kept apart."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def density_bins(points: DataFrame, size: float) -> DataFrame:
    """``scope, bx, by, weight, n`` of points ``scope, x, y, weight``, combined before the shuffle."""
    return points.groupBy("scope", F.floor(F.col("x") / size).alias("bx"), F.floor(F.col("y") / size).alias("by")).agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))


def dense_windows(bins: DataFrame, size: float, window: float, n: int, candidates: int = 500) -> DataFrame:
    """``scope, rank, x, y, weight``: greedy choice of the heaviest bins whose centres are more than ``window`` apart
    along an axis from all chosen before. A window can rule out at most (2 * window / size + 1) ** 2 bins, so the
    first ``n`` times that many are candidates enough, and never more than that reach one group."""
    enough = max(candidates, n * int(2 * window / size + 2) ** 2)
    order = Window.partitionBy("scope").orderBy(F.desc("weight"), "bx", "by")
    top = bins.withColumn("place", F.row_number().over(order)).where(F.col("place") <= enough)
    top = top.select("scope", "place", ((F.col("bx") + 0.5) * size).alias("x"), ((F.col("by") + 0.5) * size).alias("y"), "weight")

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple] = []
        for r in frame.sort_values("place").itertuples():
            if all(abs(r.x - k[2]) > window or abs(r.y - k[3]) > window for k in kept):
                kept.append((r.scope, len(kept) + 1, r.x, r.y, r.weight))
                if len(kept) == n:
                    break
        return pd.DataFrame(kept, columns=["scope", "rank", "x", "y", "weight"])

    return top.groupBy("scope").applyInPandas(pick, "scope string, rank int, x double, y double, weight double")


def smooth(bins: DataFrame, sigma: float = 3.0, truncate: float = 4.0) -> DataFrame:
    """Gaussian smoothing of bins: each spreads over a kernel of bounded width, then one sum by bin."""
    reach = int(truncate * sigma + 0.5)
    weights = [(d, pow(2.718281828459045, -d * d / (2 * sigma * sigma))) for d in range(-reach, reach + 1)]
    total = sum(w for _, w in weights)
    kernel = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(w / total).alias("w")) for d, w in weights])
    x = bins.withColumn("k", F.explode(kernel)).groupBy("scope", (F.col("bx") + F.col("k.d")).alias("bx"), "by").agg(F.sum(F.col("weight") * F.col("k.w")).alias("weight"))
    return x.withColumn("k", F.explode(kernel)).groupBy("scope", "bx", (F.col("by") + F.col("k.d")).alias("by")).agg(F.sum(F.col("weight") * F.col("k.w")).alias("weight"))
