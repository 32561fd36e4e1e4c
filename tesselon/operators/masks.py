"""Polygons to pixels, pixel lookups, mask comparison; ordered classification rules.

A mask is kept as runs: ``scope, py, start, stop, label`` says that pixels ``start`` to ``stop`` - 1 of line ``py`` have a
label. Runs of a line don't overlap and equal neighbours are one, so work and storage follow the outlines and not the
areas. What a line holds meets on ``scope, py`` by equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselon.functions.geometry import close_ring
from tesselon.operators.learn import connected
from tesselon.operators.quantiles import quantiles
from tesselon.session import clean, materialize, small

#: Region classes from the lowest to the highest priority.
ROI_ORDER = ("Other ROI", "TME ROI", "Tumor ROI", "Vessels ROI")


def usable_regions(regions: DataFrame, region_id: str, scope: str, rings: str, *keep: str) -> DataFrame:
    """``region_id, scope, rings`` closed, of regions whose outline has three different corners."""
    outline = F.get(F.col(rings), F.lit(0))
    rows = regions.where(F.col(scope).isNotNull() & (F.size(F.array_distinct(outline)) >= 3))
    return rows.select(F.col(region_id).alias("region_id"), F.col(scope).alias("scope"), F.transform(F.filter(rings, lambda r: F.size(r) > 0), close_ring).alias("rings"), *keep)


def rasterize(regions: DataFrame, label: str, priority: Column, step: float = 1.0) -> DataFrame:
    """The mask of pixels of side ``step`` whose centre lies strictly inside a region and in or on no hole.

    Of several regions the one of the highest ``priority`` wins, ties to the larger region_id. Each region is cut into
    its runs line by line; lines are then cut at all ends of runs and every piece goes to its best region. Background
    isn't stored.
    """
    rows = regions.select("region_id", "scope", "rings", F.col(label).alias("label"), priority.cast("long").alias("priority"))
    runs = rows.mapInPandas(_scan_lines(step), "scope string, py long, start long, stop long, region_id long, label string, priority long")
    line = Window.partitionBy("scope", "py").orderBy("at")
    ends = runs.select("scope", "py", F.explode(F.array("start", "stop")).alias("at")).distinct()
    pieces = ends.withColumn("until", F.lead("at").over(line)).where("until is not null")
    met = pieces.join(runs, ["scope", "py"]).where("start <= at and stop >= until")
    best = met.groupBy("scope", "py", "at", "until").agg(F.max_by("label", F.struct("priority", "region_id")).alias("label"))
    return _joined(best.select("scope", "py", F.col("at").alias("start"), F.col("until").alias("stop"), "label"))


def _joined(runs: DataFrame) -> DataFrame:
    """Neighbouring runs of one label as one."""
    line = Window.partitionBy("scope", "py").orderBy("start")
    new = ~(F.lag("stop").over(line).eqNullSafe(F.col("start")) & F.lag("label").over(line).eqNullSafe(F.col("label")))
    numbered = runs.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(line))
    return numbered.groupBy("scope", "py", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.first("label").alias("label")).drop("_run")


def _scan_lines(step: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for region, scope, rings, label, priority in frame[["region_id", "scope", "rings", "label", "priority"]].itertuples(index=False):
                for py, start, stop in region_runs([np.array([list(p) for p in r], float).reshape(-1, 2) / step for r in rings]):
                    out.append((scope, py, start, stop, region, label, priority))
            yield pd.DataFrame(out, columns=["scope", "py", "start", "stop", "region_id", "label", "priority"])

    return run


def region_runs(rings: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """``line, start, stop`` of the pixels of side 1 whose centres lie strictly inside the first closed ring and neither
    in nor on another."""
    low, high = np.floor(rings[0][:, 1].min() - 0.5), np.ceil(rings[0][:, 1].max() - 0.5)
    for line in range(int(low), int(high) + 1):
        y = line + 0.5
        inside: list[tuple[int, int]] = []
        off: list[tuple[int, int]] = []
        for k, ring in enumerate(rings):
            a, b = ring[:-1], ring[1:]
            up = (a[:, 1] > y) != (b[:, 1] > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = np.sort((a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]))[up])
            spans = list(zip(at[::2].tolist(), at[1::2].tolist()))
            flat = (a[:, 1] == y) & (b[:, 1] == y)
            touch = [(min(p, q), max(p, q)) for p, q in zip(a[flat, 0].tolist(), b[flat, 0].tolist())]
            points = [(x, x) for x in a[a[:, 1] == y, 0].tolist()]
            if k == 0:  # centres strictly between two crossings
                inside = [(int(np.floor(p - 0.5)) + 1, int(np.ceil(q - 0.5))) for p, q in spans]
                spans = []
            off += [(int(np.ceil(p - 0.5)), int(np.floor(q - 0.5)) + 1) for p, q in spans + touch + points]
        for start, stop in inside:
            for x, z in sorted(o for o in off if o[1] > o[0]):
                if x > start and x < stop:
                    yield line, start, x
                start = max(start, z) if x < stop else start
            if start < stop:
                yield line, start, stop


def pixels_of(mask: DataFrame) -> DataFrame:
    """``scope, px, py, label``: one row a pixel."""
    return mask.select("scope", F.explode(F.sequence("start", F.col("stop") - 1)).alias("px"), "py", "label")


def roi_priority(column: str) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(c) for c in ROI_ORDER]), F.col(column)), F.lit(0))


def mask_lookup(points: DataFrame, mask: DataFrame, step: float = 1.0, default: str | None = None) -> DataFrame:
    """Points ``scope, x, y, ...`` with the ``label`` of their pixel, ``default`` where there is none: an equi-join on the
    line, the run by its ends."""
    keyed = points.withColumns({"px": F.floor(F.col("x") / step), "py": F.floor(F.col("y") / step)}).alias("p")
    on = (F.col("p.scope") == F.col("m.scope")) & (F.col("p.py") == F.col("m.py")) & (F.col("p.px") >= F.col("m.start")) & (F.col("p.px") < F.col("m.stop"))
    found = keyed.join(mask.alias("m"), on, "left").select("p.*", F.col("m.label").alias("label"))
    return found.withColumn("label", F.coalesce("label", F.lit(default))) if default is not None else found


def mask_overlap(one: DataFrame, two: DataFrame) -> DataFrame:
    """By scope: pixels of each mask, of both and of either, Jaccard index (0 without any)."""
    size = (F.col("stop") - F.col("start")).alias("size")
    zero = F.lit(0).cast("long")
    a = one.select("scope", size.alias("a"), zero.alias("b"), zero.alias("c"))
    b = two.select("scope", zero.alias("a"), size.alias("b"), zero.alias("c"))
    other = two.select("scope", "py", F.col("start").alias("start_2"), F.col("stop").alias("stop_2"))
    shared = F.least("stop", "stop_2") - F.greatest("start", "start_2")
    both = one.join(other, ["scope", "py"]).select("scope", zero.alias("a"), zero.alias("b"), shared.alias("c")).where("c > 0")
    counts = a.unionByName(b).unionByName(both).groupBy("scope").agg(F.sum("a").alias("n_one"), F.sum("b").alias("n_two"), F.sum("c").alias("n_both"))
    counts = counts.withColumn("n_any", F.col("n_one") + F.col("n_two") - F.col("n_both"))
    return counts.withColumn("jaccard", F.coalesce(F.try_divide("n_both", "n_any"), F.lit(0.0)))


def mask_edges(mask: DataFrame) -> DataFrame:
    """Foreground pixels whose upper or left neighbour has another label or none: ``scope, px, py, label``.

    These are the first pixel of each run and what the runs of its label in the line above leave uncovered.
    """
    above = mask.select("scope", (F.col("py") + 1).alias("py"), F.col("label").alias("l"), F.col("start").alias("s"), F.col("stop").alias("e"))
    m, u = mask.alias("m"), above.alias("u")
    on = (F.col("m.scope") == F.col("u.scope")) & (F.col("m.py") == F.col("u.py")) & (F.col("m.label") == F.col("u.l")) & (F.col("u.s") < F.col("m.stop")) & (F.col("u.e") > F.col("m.start"))
    covered = m.join(u, on, "left").groupBy("m.scope", "m.py", "m.start", "m.stop", "m.label").agg(F.array_sort(F.collect_list(F.when(F.col("u.s").isNotNull(), F.struct("u.s", "u.e")))).alias("c"))
    # gaps between what is covered; equal runs above don't overlap
    starts = F.concat(F.array("start"), F.transform("c", lambda x: x.e))
    stops = F.concat(F.transform("c", lambda x: x.s), F.array("stop"))
    gaps = F.filter(F.arrays_zip(starts.alias("s"), stops.alias("e")), lambda g: g["e"] > g["s"])
    px = F.flatten(F.transform(gaps, lambda g: F.sequence(g["s"], g["e"] - 1)))
    return covered.select("scope", F.explode(F.array_union(F.array("start"), px)).alias("px"), "py", "label")


#: Lines of a mask that are linked within one task.
BAND = 128


def mask_components(mask: DataFrame) -> DataFrame:
    """``scope, label, component, n_pixels, x0, y0, x1, y1``: connected areas of one label (pixels that share a side) with
    their bounding box. Runs are linked within bands of ``BAND`` lines; only what meets between bands goes through joins.
    ``component`` numbers follow the first run in order of line and start within the scope."""
    whole = linked_runs(mask)
    found = whole.groupBy("scope", "label", "root").agg(
        F.sum(F.col("stop") - F.col("start")).alias("n_pixels"), F.min("start").alias("x0"), F.min("py").alias("y0"), F.max("stop").alias("x1"), (F.max("py") + 1).alias("y1"), F.min(F.struct("py", "start")).alias("first")
    )
    order = Window.partitionBy("scope").orderBy("first")  # areas of a sample
    return found.select("scope", "label", F.row_number().over(order).alias("component"), "n_pixels", "x0", "y0", "x1", "y1")


def linked_runs(mask: DataFrame) -> DataFrame:
    """The mask's runs with ``root``, one name for each connected area."""
    rows = mask.select("scope", "py", "start", "stop", "label", F.floor(F.col("py") / BAND).alias("band"))
    runs = materialize(rows.groupBy("scope", "band").applyInPandas(_linked, "scope string, py long, start long, stop long, label string, part string"))
    below = runs.where(F.pmod("py", F.lit(BAND)) == 0).select(F.col("part").alias("b"), "scope", (F.col("py") - 1).alias("py"), "label", F.col("start").alias("s"), F.col("stop").alias("e"))
    edges = runs.join(below, ["scope", "py", "label"]).where("s < stop and e > start").select(F.col("part").alias("a"), "b").distinct()
    linked = connected(edges).select(F.col("node").alias("part"), F.col("label").alias("root"))
    return runs.join(linked, "part", "left").select("scope", "label", "py", "start", "stop", F.coalesce("root", "part").alias("root"))


def mask_polygons(mask: DataFrame) -> DataFrame:
    """``scope, label, root, rings``: each connected area as a polygon along the sides of its pixels, the outline first,
    holes after it in order of their first corner. Rings are closed and keep corners only; the outline turns with a
    positive signed area (y down), holes against it. Where pixels of the area meet at a corner alone, a
    ring goes on with its own pixel. An empty mask gives no rows.

    Sides are found by joins of neighbouring lines, so full lines of pixels never come together; the corners of one
    polygon, which is one row in any case, are strung together in one group.
    """
    runs = materialize(linked_runs(mask))
    key = ["scope", "label", "root"]
    upright = runs.select(*key, F.explode(F.array(F.struct(F.col("start").alias("x"), F.lit(-1).alias("d")), F.struct(F.col("stop").alias("x"), F.lit(1).alias("d")))).alias("s"), "py")
    upright = upright.select(*key, F.col("s.x").alias("x0"), F.when(F.col("s.d") > 0, F.col("py")).otherwise(F.col("py") + 1).alias("y0"), F.col("s.x").alias("x1"), F.when(F.col("s.d") > 0, F.col("py") + 1).otherwise(F.col("py")).alias("y1"))
    # along y = py a side lies where one of the lines py - 1 and py is covered and the other isn't
    ends = lambda shift, w: runs.select(*key, (F.col("py") + shift).alias("y"), F.explode(F.array(F.struct(F.col("start").alias("x"), F.lit(w).alias("w")), F.struct(F.col("stop").alias("x"), F.lit(-w).alias("w")))).alias("s"))
    steps = ends(0, 1).unionByName(ends(1, -1)).groupBy(*key, "y", F.col("s.x").alias("x")).agg(F.sum("s.w").alias("w")).where("w <> 0")
    line = Window.partitionBy(*key, "y").orderBy("x")
    level = steps.select(*key, "y", "x", F.sum("w").over(line).alias("side"), F.lead("x").over(line).alias("to")).where("side <> 0")
    flat = level.select(*key, F.when(F.col("side") > 0, F.col("x")).otherwise(F.col("to")).alias("x0"), F.col("y").alias("y0"), F.when(F.col("side") > 0, F.col("to")).otherwise(F.col("x")).alias("x1"), F.col("y").alias("y1"))
    return upright.unionByName(flat).groupBy(*key).applyInPandas(_traced, "scope string, label string, root string, rings array<array<array<double>>>")


def _traced(sides: pd.DataFrame) -> pd.DataFrame:
    """Rings from directed sides with the area on their right (y down); at a corner met twice the ring turns towards its
    own pixel, so that it never crosses itself."""
    after: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x0, y0, x1, y1 in sides[["x0", "y0", "x1", "y1"]].sort_values(["y0", "x0", "y1", "x1"]).itertuples(index=False):
        after.setdefault((x0, y0), []).append((x1, y1))
    rings: list[list[tuple[int, int]]] = []
    for start in list(after):
        while after.get(start):
            ring, here = [start], after[start].pop()
            while here != start:
                ring.append(here)
                choice = after[here]
                if len(choice) > 1:
                    px, py = ring[-2]
                    dx, dy = here[0] - px, here[1] - py
                    choice.sort(key=lambda t: dx * (t[1] - here[1]) - dy * (t[0] - here[0]))
                here = choice.pop()
            n = len(ring)
            turns = [ring[k] for k in range(n) if (ring[k - 1][0] == ring[k][0]) != (ring[k][0] == ring[(k + 1) % n][0])]
            rings.append(turns + turns[:1])
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:]))
    rings.sort(key=lambda r: (area(r) < 0, r[0][1], r[0][0]))
    row = sides.iloc[0]
    return pd.DataFrame({"scope": [row["scope"]], "label": [row["label"]], "root": [row["root"]], "rings": [[[[float(x), float(y)] for x, y in r] for r in rings]]})


def _linked(band: pd.DataFrame) -> pd.DataFrame:
    """Adds ``part``: the same name for runs of a band that hang together."""
    band = band.sort_values(["py", "start"], ignore_index=True)
    py, start, stop = (band[c].to_numpy() for c in ("py", "start", "stop"))
    label = pd.factorize(band["label"])[0]
    parent = list(range(len(band)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lines = np.r_[np.flatnonzero(np.r_[True, py[1:] != py[:-1]]), len(py)]
    for lo, mid, hi in zip(lines[:-2], lines[1:-1], lines[2:]):
        if py[mid] != py[lo] + 1:
            continue
        first = lo + np.searchsorted(stop[lo:mid], start[mid:hi], side="right")
        last = lo + np.searchsorted(start[lo:mid], stop[mid:hi], side="left")
        for x in range(mid, hi):
            for y in range(first[x - mid], last[x - mid]):
                if label[x] == label[y]:
                    p, q = find(x), find(y)
                    parent[max(p, q)] = min(p, q)
    roots = [find(x) for x in range(len(band))]
    band["part"] = [f"{s}/{py[r]}/{start[r]}" for s, r in zip(band["scope"], roots)]
    return band.drop(columns="band")


# Phenotype, markers that must be positive, markers that must not be; the first match wins.
PHENOTYPE_RULES = (
    ("Treg", ("CD45", "CD4", "FOXP3"), ()),
    ("CD4+ T cell", ("CD45", "CD4"), ("FOXP3",)),
    ("CD8+ T cell", ("CD45", "CD8"), ()),
    ("M2 Macrophage", ("CD45", "CD163"), ()),
    ("Macrophage", ("CD45", "CD68"), ()),
    ("B cell", ("CD45", "CD20"), ()),
    ("NK cell", ("CD45", "CD56"), ()),
    ("DC", ("CD45", "CD11C"), ()),
    ("Neutrophil", ("CD45", "CD66B"), ()),
    ("Immune (other)", ("CD45",), ()),
    ("Epithelial", ("KERATIN8",), ("CD45",)),
    ("Fibroblast", ("COL1A1",), ("CD45",)),
    ("Endothelial", ("CD31",), ("CD45",)),
)


def classify(positive: dict[str, Column], rules: Sequence = PHENOTYPE_RULES, other: str = "Unclassified") -> Column:
    """First rule that holds. ``positive`` tells for each marker there is whether it is positive; a missing value is
    never positive and never blocks. A rule with a missing positive marker is skipped, a missing negative one ignored."""
    out = None
    for label, wanted, barred in rules:
        if any(m not in positive for m in wanted):
            continue
        holds = F.lit(True)
        for m in wanted:
            holds = holds & F.coalesce(positive[m], F.lit(False))
        for m in barred:
            if m in positive:
                holds = holds & ~F.coalesce(positive[m], F.lit(False))
        out = F.when(holds, label) if out is None else out.when(holds, label)
    return F.lit(other) if out is None else out.otherwise(other)


def phenotypes(cells: DataFrame, scope: str, markers: dict[str, str], q: float = 0.75) -> DataFrame:
    """Adds ``called``: the phenotype by ``classify``, a marker being positive from the scope's q-quantile on.

    ``markers`` maps marker names to columns; the thresholds are one row for each scope.
    """
    cuts = quantiles(cells, [scope], **{f"cut_{c}": (clean(F.col(c)), q) for c in markers.values()})
    positive = {m: clean(F.col(c)) >= F.col(f"cut_{c}") for m, c in markers.items()}
    return cells.join(small(cuts), scope).withColumn("called", classify(positive)).drop(*[f"cut_{c}" for c in markers.values()])
