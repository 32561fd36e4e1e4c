"""Bringing modalities together: transcripts by mask, matched pairs, displacement, raster warps, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesselon.functions.geometry import apply_affine, bounding_box, invert_affine
from tesselon.operators.quantiles import quantiles
from tesselon.operators.stats import pearson
from tesselon.session import small

# Prefixes of mitochondrial features and of taxa; spatial autocorrelation thresholds by modality.
MITOCHONDRIAL, TAXA = r"^(MT-|mt-)", r"^[gsfocp]__"
MODALITY_THRESHOLDS = {"glycans": 0.2, "metabolites": 0.05, "peptides": 0.2}


def aggregate_by_mask(transcripts: DataFrame, mask: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transcripts ``scope, px, py, gene, count`` on cells ``scope, px, py, label``: the sums by cell and gene, and by
    gene of what lies in no cell. Together they are all transcripts; null counts count as 0. One equi-join, after
    counts of a pixel and gene are combined on the map side."""
    counts = transcripts.groupBy("scope", "px", "py", "gene").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))
    placed = counts.join(mask.select("scope", "px", "py", "label"), ["scope", "px", "py"], "left")
    inside = placed.where(F.col("label").isNotNull()).groupBy("scope", F.col("label").alias("cell"), "gene").agg(F.sum("count").alias("count"))
    outside = placed.where(F.col("label").isNull()).groupBy("scope", "gene").agg(F.sum("count").alias("count"))
    return inside, outside


def cell_totals(triplets: DataFrame, taxa: str = TAXA) -> DataFrame:
    """By cell: transcripts, features, and transcripts of features with the prefix of a taxon."""
    return triplets.groupBy("scope", "cell").agg(F.sum("count").alias("n_transcripts"), F.count_if(F.col("count") > 0).alias("n_genes"), F.coalesce(F.sum(F.when(F.col("gene").rlike(taxa), F.col("count"))), F.lit(0)).alias("n_taxa"))


def matched_correlation(pairs: DataFrame, one: DataFrame, two: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pearson's r for each pair ``a, b`` over the features that both tables ``obs, feature, value`` have, and for each
    feature over the pairs; 0 where either side is constant. A feature that a record lacks counts as 0 if the other
    record of its pair has it."""
    common = one.select("feature").distinct().join(two.select("feature").distinct(), "feature")
    left = pairs.join(one.withColumnRenamed("obs", "a"), "a").join(common, "feature", "left_semi").select("a", "b", "feature", F.col("value").alias("x"))
    right = pairs.join(two.withColumnRenamed("obs", "b"), "b").join(common, "feature", "left_semi").select("a", "b", "feature", F.col("value").alias("y"))
    both = left.join(right, ["a", "b", "feature"], "full").na.fill(0.0, subset=["x", "y"])
    r = pearson(F.col("x"), F.col("y"))
    return both.groupBy("a", "b").agg(F.count("*").alias("n"), r.alias("r")), both.groupBy("feature").agg(F.count("*").alias("n"), r.alias("r"))


def displacement(moved: DataFrame, by: str) -> DataFrame:
    """From ``x, y, wx, wy``: mean and std of the shift along each axis, mean and largest length, by a column."""
    dx, dy = F.col("wx") - F.col("x"), F.col("wy") - F.col("y")
    return moved.groupBy(by).agg(F.avg(dx).alias("mean_dx"), F.avg(dy).alias("mean_dy"), F.stddev_pop(dx).alias("std_dx"), F.stddev_pop(dy).alias("std_dy"), F.avg(F.hypot(dx, dy)).alias("mean_shift"), F.max(F.hypot(dx, dy)).alias("max_shift"))


def warp_raster(pixels: DataFrame, transforms: DataFrame, width: int, height: int, bilinear: bool = True) -> DataFrame:
    """``scope, px, py, value`` of rasters moved by the affine of their scope (``scope, matrix``), in a frame of the given
    size: every target pixel looks up its source by the inverse, so there are neither holes nor doubles.

    Bilinear: the four pixels around the source place, weighted by nearness; a pixel that isn't there counts as 0, a
    target with none has no row. Else the nearest pixel. Targets are spread over the cluster by scope and line, the
    lookup is one equi-join. A singular matrix raises an error, a null one leaves its scope out.
    """
    scopes = pixels.select("scope").distinct().join(transforms.where(F.col("matrix").isNotNull()).select("scope", "matrix"), "scope")
    lines = scopes.withColumn("py", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(height - 1).cast("long")))).repartition("scope", "py")
    frame = lines.withColumn("px", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))))
    sx, sy = apply_affine(invert_affine(F.col("matrix"), strict=True), F.col("px").cast("double"), F.col("py").cast("double"))
    placed = frame.select("scope", "px", "py", sx.alias("x"), sy.alias("y"))
    source = pixels.select("scope", F.col("px").alias("sx"), F.col("py").alias("sy"), "value")
    if not bilinear:
        asked = placed.select("scope", "px", "py", F.rint("x").cast("long").alias("sx"), F.rint("y").cast("long").alias("sy"))
        return asked.join(source, ["scope", "sx", "sy"]).select("scope", "px", "py", "value")
    fx, fy = F.col("x") - F.floor("x"), F.col("y") - F.floor("y")
    taps = F.array(*[F.struct((F.floor("x") + i).alias("sx"), (F.floor("y") + j).alias("sy"), ((fx if i else 1 - fx) * (fy if j else 1 - fy)).alias("w")) for i in (0, 1) for j in (0, 1)])
    asked = placed.select("scope", "px", "py", F.explode(F.filter(taps, lambda t: t["w"] > 0)).alias("t")).select("scope", "px", "py", "t.*")
    return asked.join(source, ["scope", "sx", "sy"]).groupBy("scope", "px", "py").agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def image_agreement(one: DataFrame, two: DataFrame, above: float = 10.0, least: int = 100) -> DataFrame:
    """By scope: overlap of what exceeds ``above`` in two rasters ``scope, px, py, value``, and their correlation there
    if more than ``least`` pixels are common."""
    a = one.where(F.col("value") > above).select("scope", "px", "py", F.col("value").cast("double").alias("x"))
    b = two.where(F.col("value") > above).select("scope", "px", "py", F.col("value").cast("double").alias("y"))
    common = F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull())
    return a.join(b, ["scope", "px", "py"], "full").groupBy("scope").agg((100 * common / F.count("*")).alias("overlap_pct"), F.when(common > least, pearson(F.col("x"), F.col("y"))).alias("ncc"))


def stretch(df: DataFrame, column: str, by: str, low: float = 0.01, high: float = 0.995) -> DataFrame:
    """Adds ``stretched``: the column between two quantiles of its values above 0, cut to 0 .. 1; 0 without a range."""
    v = F.when(F.col(column) > 0, F.col(column).cast("double"))
    bounds = quantiles(df, [by], _lo=(v, low), _hi=(v, high))
    scaled = F.when(F.col("_hi") > F.col("_lo"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))))).otherwise(0.0)
    return df.join(small(bounds), by).withColumn("stretched", scaled).drop("_lo", "_hi")


def border_ring(x: Column, y: Column, offsets: Column) -> Column:
    """Ring of a cell from its centre and vertex offsets ``array<struct<dx, dy>>``."""
    return F.transform(offsets, lambda o: F.array((x + o["dx"]).cast("double"), (y + o["dy"]).cast("double")))


def rectangle_ring(x: Column, y: Column, width: Column, height: Column) -> Column:
    """Closed ring of a rectangle; null for a box beyond 1e10, the mark of an empty one."""
    corners = F.array(F.array(x, y), F.array(x + width, y), F.array(x + width, y + height), F.array(x, y + height), F.array(x, y))
    return F.when((F.abs(x) < 1e10) & (F.abs(y) < 1e10) & (width < 1e10) & (height < 1e10), corners)


def volcano(log2_fc: Column, p_adjusted: Column) -> tuple[Column, Column]:
    """Significant (below .05 and more than twofold), and -log10 of p."""
    return (p_adjusted < 0.05) & (F.abs(log2_fc) > 1), -F.log10(p_adjusted + 1e-300)


def modality_threshold(modality: Column) -> Column:
    """The modality's autocorrelation threshold, whatever its case; 0.1 for others."""
    known = F.create_map(*[F.lit(v) for kv in MODALITY_THRESHOLDS.items() for v in kv])
    return F.coalesce(F.try_element_at(known, F.lower(modality)), F.lit(0.1))


def recommend(n_a: Column, n_b: Column, median: Column) -> Column:
    """Which of two polygon sources to use, by their counts and the median distance between them."""
    difference = 100 * F.abs(n_a - n_b) / F.greatest(n_a, n_b, F.lit(1))
    return F.when((difference < 5) & (median < 10), "BOTH_EQUIVALENT").when(n_a > n_b, "USE_TIF").otherwise("USE_MLD")


def dual_dense_windows(one: DataFrame, two: DataFrame, window: float, least: int = 20) -> DataFrame:
    """``scope, cx, cy, n_one, n_two, weight``: square windows on a grid of three window widths in which both point
    sets have more than ``least`` points; the weight is the smaller count. Feed it to ``dense_windows`` for a choice."""
    step = 3 * window

    def counts(points: DataFrame, name: str) -> DataFrame:
        cell = lambda c: F.round(F.col(c) / step)
        near = (F.abs(F.col("x") - cell("x") * step) <= window) & (F.abs(F.col("y") - cell("y") * step) <= window)
        return points.where(near).groupBy("scope", cell("x").cast("long").alias("cx"), cell("y").cast("long").alias("cy")).agg(F.count("*").alias(name))

    both = counts(one, "n_one").join(counts(two, "n_two"), ["scope", "cx", "cy"]).where((F.col("n_one") > least) & (F.col("n_two") > least))
    return both.withColumn("weight", F.least("n_one", "n_two"))


def pair_files(one: DataFrame, two: DataFrame) -> DataFrame:
    """``stem, path_one, path_two`` of two listings (stem, path); an orphan has a null on the other side."""
    return one.select("stem", F.col("path").alias("path_one")).join(two.select("stem", F.col("path").alias("path_two")), "stem", "full")


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What still has to run: the rows whose key isn't among the finished ones."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def crop_points(points: DataFrame, windows: DataFrame) -> DataFrame:
    """Points inside the window ``x0, y0, x1, y1`` of their scope, its upper ends not included, moved to its corner."""
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))
    return points.join(small(windows), "scope").where(inside).withColumns({"x": F.col("x") - F.col("x0"), "y": F.col("y") - F.col("y0")}).drop("x0", "y0", "x1", "y1")


def crop_rings(rings: DataFrame, windows: DataFrame) -> DataFrame:
    """Rings ``scope, ring`` whose bounding box meets the window of their scope, moved to its corner."""
    x0, y0, x1, y1 = bounding_box(F.col("ring"))
    met = rings.join(small(windows), "scope").where((x0 < F.col("x1")) & (x1 >= F.col("x0")) & (y0 < F.col("y1")) & (y1 >= F.col("y0")))
    moved = F.transform("ring", lambda p: F.array(F.get(p, F.lit(0)) - F.col("x0"), F.get(p, F.lit(1)) - F.col("y0")))
    return met.withColumn("ring", moved).drop("x0", "y0", "x1", "y1")
