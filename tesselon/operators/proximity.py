"""Points near other points or regions (problem 6).

Points are cut into square tiles with a halo, so that one shuffle of little more than one copy of each point brings
together all that may be near one another; a tile is then swept along x in a stream of bounded memory. Tiles that hold
very many points are cut further. The nearest point of those far from all others is found by descending a pyramid of
occupied cells. Regions are covered by cells that lie fully inside or touch the boundary: a point in an inner cell is
accepted by the equi-join alone, only points in boundary cells are tested, against the edges that touch the cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselon.session import materialize, small

#: Tile side in units of the search radius, and points beyond which a tile is cut further.
TILE, HOT = 16, 250_000

FOUND = "kind byte, left_id long, right_id long, dist double, flag byte"


def points_of(df: DataFrame, record_id: str, scope: str, position: str, flag: str | None = None) -> DataFrame:
    """``id, scope, x, y, flag`` of the rows with a usable position; flag is 1, 0 or -1 for null.

    Left out: null ids and scopes, positions that are null, shorter than two, not finite or beyond 1e15, where a double
    no longer tells pixels apart.
    """
    at = F.col(f"`{position}`")
    big = F.lit(1e15)
    wanted = F.lit(-1) if flag is None else F.coalesce(F.col(f"`{flag}`").cast("int"), F.lit(-1))
    return df.select(
        F.col(f"`{record_id}`").cast("long").alias("id"), F.col(f"`{scope}`").alias("scope"), F.get(at, F.lit(0)).alias("x"), F.get(at, F.lit(1)).alias("y"), wanted.cast("byte").alias("flag")
    ).where((F.abs("x") < big) & (F.abs("y") < big) & F.col("id").isNotNull() & F.col("scope").isNotNull())


def with_tiles(points: DataFrame, reach: float, hot: int = HOT) -> DataFrame:
    """One row of a point for each tile whose surroundings of ``reach`` hold it; ``home`` in the one that contains it.

    A tile has ``TILE * reach`` on a side; one with more than ``hot`` points is cut into up to (TILE / 2) ** 2 parts.
    """
    side = float(TILE * reach)
    cell = lambda c: F.floor(F.col(c) / side)
    counts = points.groupBy("scope", cell("x").alias("tx"), cell("y").alias("ty")).count().where(F.col("count") > hot)
    crowded = materialize(counts.select("scope", "tx", "ty", F.least(F.lit(TILE // 2), F.ceil(F.sqrt(F.col("count") / hot)) * 2).cast("int").alias("parts")))
    span = lambda c: F.sequence(F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side))
    tiled = points.withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y"))).withColumn("home", (cell("x") == F.col("tx")) & (cell("y") == F.col("ty")))
    n = crowded.count()
    if n == 0:
        return tiled.withColumns({"sx": F.lit(0).cast("long"), "sy": F.lit(0).cast("long")})
    tiled = tiled.join(small(crowded, n), ["scope", "tx", "ty"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    step = F.lit(side) / F.col("parts")
    at = lambda c, t, d: F.floor((F.col(c) + d - F.col(t) * side) / step)
    clip = lambda c: F.greatest(F.lit(0).cast("long"), F.least(F.col("parts") - 1, c))
    sub = lambda c, t: F.sequence(clip(at(c, t, -reach)), clip(at(c, t, reach)))
    return (
        tiled.withColumn("sx", F.explode(sub("x", "tx")))
        .withColumn("sy", F.explode(sub("y", "ty")))
        .withColumn("home", F.col("home") & (F.col("sx") == clip(at("x", "tx", 0.0))) & (F.col("sy") == clip(at("y", "ty", 0.0))))
        .drop("parts")
    )


def sweep(tiled: DataFrame, near: float, reach: float) -> DataFrame:
    """Runs ``_sweep`` over tiles: kind 0 rows are pairs at most ``near`` apart (smaller id left), kind 1 rows give each
    home point with a flag its nearest other point within ``reach`` (null if none; ties to the smaller id)."""
    keys = ["scope", "tx", "ty", "sx", "sy"]
    laid = tiled.select(*keys, "x", "y", "id", "home", "flag").repartition(*keys).sortWithinPartitions(*keys, "x", "id", F.desc("home"))
    return laid.mapInArrow(lambda batches: _sweep(batches, near, reach), FOUND)


def _sweep(batches: Iterator[pa.RecordBatch], near: float, reach: float) -> Iterator[pa.RecordBatch]:
    kept: pa.Table | None = None
    n_done = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        if kept is not None:
            rows = pa.concat_tables([kept, rows])
        found, kept, n_done = _step(rows, n_done, near, reach, last=False)
        yield from found
    if kept is not None:
        yield from _step(kept, n_done, near, reach, last=True)[0]


def _step(rows: pa.Table, n_done: int, near: float, reach: float, last: bool) -> tuple[list[pa.RecordBatch], pa.Table, int]:
    """One chunk in order of tile and x. Its first ``n_done`` rows are reported already and only serve as neighbours.

    Rows are reported as soon as everything within ``reach`` behind them in x has come; those and what lies up to twice
    ``reach`` back are kept for the next chunk.
    """
    scope = rows["scope"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    key = np.stack([scope, *(rows[c].to_numpy() for c in ("tx", "ty", "sx", "sy"))])
    x, y, ids = (rows[c].to_numpy() for c in ("x", "y", "id"))
    home, flag = rows["home"].to_numpy(), rows["flag"].to_numpy()
    new = np.ones(len(x), bool)
    new[1:] = (key[:, 1:] != key[:, :-1]).any(0)
    group = np.cumsum(new)
    again = np.zeros(len(x), bool)
    again[1:] = ~new[1:] & (x[1:] == x[:-1]) & (ids[1:] == ids[:-1])
    ready = np.ones(len(x), bool) if last else (group < group[-1]) | (x <= x[-1] - reach)
    report = ready.copy()
    report[:n_done] = False
    first = int(np.searchsorted(group, group[-1]))
    keep_from = len(x) if last else first + int(np.searchsorted(x[first:], x[-1] - 2 * reach, side="right"))
    left_over = rows.slice(keep_from)
    done_next = int(ready[keep_from:].sum())
    if again.any():
        u = ~again
        x, y, ids, home, flag, group, report = x[u], y[u], ids[u], home[u], flag[u], group[u], report[u]
    out: list[pa.RecordBatch] = []
    best, who = np.full(len(x), np.inf), np.full(len(x), -1, np.int64)

    def closer(i: np.ndarray, j: np.ndarray, d2: np.ndarray) -> None:
        better = (d2 < best[i]) | (d2 == best[i]) & (ids[j] < who[i])
        i, j, d2 = i[better], j[better], d2[better]
        best[i], who[i] = d2, ids[j]

    if near > 0:
        i, k = np.arange(len(x) - 1), 1
        while len(i):
            j = i + k
            inside = (group[j] == group[i]) & (x[j] - x[i] <= near)
            i, j = i[inside], j[inside]
            d2 = (x[j] - x[i]) ** 2 + (y[j] - y[i]) ** 2
            hit = (d2 <= near * near) & (ids[i] != ids[j])
            a, b, d = i[hit], j[hit], d2[hit]
            closer(a, b, d)
            closer(b, a, d)
            mine = report[a] & np.where(ids[a] < ids[b], home[a], home[b])
            if mine.any():
                p, q = ids[a[mine]], ids[b[mine]]
                out.append(_found(0, np.minimum(p, q), np.maximum(p, q), np.sqrt(d[mine]), np.full(len(p), -1)))
            k += 1
            i = i[i + k < len(x)]
    asked = np.flatnonzero(report & home & (flag >= 0))
    for way in (1, -1):
        i, k = asked[best[asked] > near * near] if near > 0 else asked, way
        while True:
            i = i[(i + k >= 0) & (i + k < len(x))]
            j = i + k
            dx = np.abs(x[j] - x[i])
            inside = (group[j] == group[i]) & (dx <= reach) & (dx * dx <= best[i])
            i, j = i[inside], j[inside]
            if not len(i):
                break
            d2 = (x[j] - x[i]) ** 2 + (y[j] - y[i]) ** 2
            hit = (d2 <= reach * reach) & (ids[i] != ids[j])
            closer(i[hit], j[hit], d2[hit])
            k += way
    if len(asked):
        none = ~np.isfinite(best[asked])
        out.append(_found(1, ids[asked], pa.array(who[asked], mask=none), pa.array(np.sqrt(best[asked]), mask=none), flag[asked]))
    return out, left_over, done_next


def _found(kind: int, left, right, dist, flag) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(left), kind, np.int8)), pa.array(left, pa.int64()), right if isinstance(right, pa.Array) else pa.array(right, pa.int64()), dist if isinstance(dist, pa.Array) else pa.array(dist), pa.array(np.asarray(flag, np.int8))]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "left_id", "right_id", "dist", "flag"])


def near_and_nearest(points: DataFrame, near: float, reach: float) -> DataFrame:
    """One pass for pairs at most ``near`` apart and for the nearest point within ``reach`` (see ``sweep``).

    ``points`` are those of ``points_of``; rows repeated with id and position count once. Distances are inclusive.
    Points at one place are 0 apart, so all of them pair; that is the result's own size, not the method's. An empty
    table gives an empty result.
    """
    return sweep(with_tiles(points, max(near, reach)), near, reach)


#: Sides of neighbouring levels of the pyramid are in this ratio.
STEP = 4


def nearest_beyond(lonely: DataFrame, points: DataFrame, reach: float) -> DataFrame:
    """``left_id, right_id, dist, flag``: the nearest other point of the points ``lonely`` that have none within ``reach``.

    The occupied cells of side ``reach`` are aggregated once and summed up to coarser and coarser levels, until a scope
    is a few cells wide. From there each lonely point descends: of the cells that hold another point those are kept
    whose near side is not beyond the nearest far side, and only the points of the last few cells are compared. No tile
    or scope is read as a whole, however far an outlier lies. Ties go to the smaller id; a point alone in its scope has
    no row.
    """
    asked = materialize(lonely.select("id", "scope", "x", "y", "flag"))
    cell = lambda c: F.floor(F.col(c) / reach)
    there = points.join(small(asked.select("scope").distinct()), "scope", "left_semi")
    base = materialize(there.groupBy("scope", cell("x").alias("cx"), cell("y").alias("cy")).agg(F.min("id").alias("low"), F.max("id").alias("high")))
    wide = base.groupBy("scope").agg(F.greatest(F.max("cx") - F.min("cx"), F.max("cy") - F.min("cy")).alias("w")).agg(F.max("w")).first()[0]
    if wide is None:
        return lonely.sparkSession.createDataFrame([], "left_id long, right_id long, dist double, flag byte")
    levels = [base]
    while STEP ** (len(levels) - 1) <= wide:
        up = lambda c: F.floor(F.col(c) / STEP).alias(c)
        levels.append(materialize(levels[-1].groupBy("scope", up("cx"), up("cy")).agg(F.min("low").alias("low"), F.max("high").alias("high"))))
    kept = asked.join(small(levels[-1]), "scope")
    for level in range(len(levels) - 1, -1, -1):
        side = F.lit(reach * float(STEP) ** level)
        off = lambda c, k: (F.col(k) * side - F.col(c), F.col(c) - (F.col(k) + 1) * side)  # noqa: E731, B023
        near = [F.greatest(F.lit(0.0), *off(c, k)) for c, k in (("x", "cx"), ("y", "cy"))]
        far = [side + F.greatest(*off(c, k)) for c, k in (("x", "cx"), ("y", "cy"))]
        others = kept.where("low <> id or high <> id")
        ranged = others.select("id", "scope", "x", "y", "flag", "cx", "cy", (near[0] * near[0] + near[1] * near[1]).alias("near"), (far[0] * far[0] + far[1] * far[1]).alias("far"))
        ranged = materialize(ranged)
        bound = ranged.groupBy("id", "x", "y").agg(F.min("far").alias("bound"))
        kept = ranged.join(small(bound), ["id", "x", "y"]).where(F.col("near") <= F.col("bound") * (1 + 1e-9)).select("id", "scope", "x", "y", "flag", "cx", "cy")
        if level:
            child = lambda c: F.explode(F.sequence(F.col(c) * STEP, F.col(c) * STEP + STEP - 1))
            kept = kept.withColumn("cx", child("cx")).withColumn("cy", child("cy")).join(levels[level - 1], ["scope", "cx", "cy"])
    last = small(materialize(kept).withColumnsRenamed({"x": "px", "y": "py", "id": "left_id"}))
    d2 = (F.col("x") - F.col("px")) * (F.col("x") - F.col("px")) + (F.col("y") - F.col("py")) * (F.col("y") - F.col("py"))
    met = there.select("scope", cell("x").alias("cx"), cell("y").alias("cy"), "id", "x", "y").join(last, ["scope", "cx", "cy"]).where("id <> left_id")
    best = met.groupBy("left_id", "px", "py").agg(F.min(F.struct(d2.alias("d2"), F.col("id").alias("right_id"), "flag")).alias("b"))
    return best.groupBy("left_id").agg(F.min("b").alias("b")).select("left_id", "b.right_id", F.sqrt("b.d2").alias("dist"), "b.flag")


#: Edges that a border cell may have before it is cut, and how often it is cut at most.
EDGES, CUTS = 8, 6

#: Cells of regions; a border cell has, for each ring that matters in it, whether the point ``at`` is inside the ring, and
#: the ring's edges ``[ax, ay, bx, by]`` that touch the cell.
COVER = "scope string, side double, cx long, cy long, inner boolean, region_id long, at array<double>, rings array<struct<inside: boolean, edges: array<array<double>>>>"


def cover_regions(regions: DataFrame, region_id: str, scope: str, rings: str) -> DataFrame:
    """Adaptive cover of each region by square cells: ``inner`` ones lie strictly within it, the others touch a border.

    Cells have powers of four as their side; the first are such that two to eight span the region's longer edge, those
    on the border are cut once more, and again while more than ``EDGES`` edges touch them. A border cell carries only
    these edges and on which side of the rings one of its points lies, so the cover grows with the outline and not with
    cells times corners. Null regions, ids or scopes and outlines of fewer than three different corners have no cells;
    null or non-finite corners are left out of a ring.
    """
    rows = regions.select(F.col(f"`{scope}`").alias("scope"), F.col(f"`{region_id}`").cast("long").alias("region_id"), F.col(f"`{rings}`").alias("rings")).where("scope is not null and region_id is not null and rings is not null")
    return rows.mapInArrow(_covers, COVER)


def _covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[tuple] = []
        owner: list[np.ndarray] = []
        for row, raw in enumerate(batch.column("rings").to_pylist()):
            rings = [r for r in (_ring(x) for x in raw) if r is not None] if len(raw) and _ring(raw[0]) is not None else []
            if rings and len(np.unique(rings[0], axis=0)) >= 3:
                for part in _cells(rings):
                    found.append(part)
                    owner.append(np.full(len(part[0]), row))
        if found:
            side, cx, cy, inner, at, n_rings, inside, n_edges, edges = (np.concatenate(x) for x in zip(*found))
            offsets = lambda n: pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
            pairs = lambda v, k: pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, k, dtype=np.int32)), pa.array(v.ravel()))
            of_ring = pa.ListArray.from_arrays(offsets(n_edges), pairs(edges, 4))
            parts = pa.StructArray.from_arrays([pa.array(inside), of_ring], names=["inside", "edges"])
            own = pa.array(np.concatenate(owner))
            columns = [batch.column("scope").take(own), pa.array(side), pa.array(cx), pa.array(cy), pa.array(inner), batch.column("region_id").take(own), pairs(at, 2), pa.ListArray.from_arrays(offsets(n_rings), parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["scope", "side", "cx", "cy", "inner", "region_id", "at", "rings"])


def _ring(raw) -> np.ndarray | None:
    """Corners of a ring, closed; None without any usable corner."""
    if raw is None:
        return None
    corners = [(p[0], p[1]) for p in raw if p is not None and len(p) >= 2]
    ring = np.array(corners, float).reshape(-1, 2)
    ring = ring[np.isfinite(ring).all(1)]
    if not len(ring):
        return None
    return ring if (ring[0] == ring[-1]).all() and len(ring) > 1 else np.vstack([ring, ring[:1]])


def _cells(rings: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells of a region, some at a time: ``side, cx, cy, inner, at``, the number of rings each has, and of these rings, in
    order, ``inside`` and the number of edges, and the edges."""
    low, high = rings[0].min(0), rings[0].max(0)
    side = 4.0 ** np.ceil(np.log(max((high - low).max(), 1e-6) / 8) / np.log(4))
    a = np.vstack([r[:-1] for r in rings])
    b = np.vstack([r[1:] for r in rings])
    ring = np.repeat(np.arange(len(rings)), [len(r) - 1 for r in rings])
    lo, hi = np.floor(low / side).astype(np.int64), np.floor(high / side).astype(np.int64)
    gx, gy = (g.ravel() for g in np.meshgrid(np.arange(lo[0], hi[0] + 1), np.arange(lo[1], hi[1] + 1)))
    off = np.arange(4)
    ox, oy = (o.ravel() for o in np.meshgrid(off, off))
    for level in range(CUTS + 1):
        if not len(gx):
            return
        cut_x, cut_y = [], []
        at_once = max(1, 2_000_000 // len(a))
        for k in range(0, len(gx), at_once):
            cx, cy = gx[k : k + at_once], gy[k : k + at_once]
            met = _touch(a, b, cx * side, cy * side, side)
            count = met.sum(1)
            free = np.flatnonzero(count == 0)
            within = free[_odd(a, b, (cx[free] + 0.5) * side, (cy[free] + 0.5) * side, ring, len(rings))]
            if len(within):
                none = np.zeros(len(within), np.int64)
                yield np.full(len(within), side), cx[within], cy[within], np.ones(len(within), bool), np.zeros((len(within), 2)), none, np.empty(0, bool), none[:0], np.empty((0, 4))
            cut = (count > 0) if level == 0 else (count > EDGES) if level < CUTS else np.zeros(len(cx), bool)
            cut_x.append((cx[cut, None] * 4 + ox).ravel())
            cut_y.append((cy[cut, None] * 4 + oy).ravel())
            edge = np.flatnonzero((count > 0) & ~cut)
            if len(edge):
                yield _border(a, b, ring, len(rings), met[edge], side, cx[edge], cy[edge])
        gx, gy, side = np.concatenate(cut_x), np.concatenate(cut_y), side / 4


def _border(a: np.ndarray, b: np.ndarray, ring: np.ndarray, n_rings: int, met: np.ndarray, side: float, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, ...]:
    # a point of each cell that shares no coordinate with a corner and lies on no edge of the cell
    at = np.empty((len(cx), 2))
    left, share = np.arange(len(cx)), 0.381966
    for _ in range(20):
        at[left, 0], at[left, 1] = (cx[left] + share) * side, (cy[left] + share * 0.91) * side
        x, y = at[left, :1], at[left, 1:]
        bad = (a[:, 0] == x) | (b[:, 0] == x) | (a[:, 1] == y) | (b[:, 1] == y) | ((b[:, 0] - a[:, 0]) * (y - a[:, 1]) == (b[:, 1] - a[:, 1]) * (x - a[:, 0]))
        left = left[(bad & met[left]).any(1)]
        if not len(left):
            break
        share = share * 0.83 + 0.01
    inside = _crossings(a, b, at[:, 0], at[:, 1], ring, n_rings)
    touches = np.stack([met[:, ring == k].any(1) for k in range(n_rings)], axis=1)
    # a cell in a hole that doesn't touch it, or outside of an outline that doesn't, holds nothing
    kept = ~(inside & ~touches)[:, 1:].any(1) & (touches[:, 0] | inside[:, 0])
    met, inside, touches, at, cx, cy = met[kept], inside[kept], touches[kept], at[kept], cx[kept], cy[kept]
    touches[:, 0] = True
    n_edges = np.stack([met[:, ring == k].sum(1) for k in range(n_rings)], axis=1)
    edges = np.nonzero(met)[1]  # by cell and, since edges come ring by ring, by ring
    return np.full(len(cx), side), cx, cy, np.zeros(len(cx), bool), at, touches.sum(1), inside[touches], n_edges[touches], np.hstack([a[edges], b[edges]])


def _touch(a: np.ndarray, b: np.ndarray, x0: np.ndarray, y0: np.ndarray, side: float) -> np.ndarray:
    """Which segments a-b meet the closed square of each corner x0, y0 (separating axes): a row for each square."""
    x0, y0 = x0[:, None], y0[:, None]
    apart = (np.maximum(a[:, 0], b[:, 0]) < x0) | (np.minimum(a[:, 0], b[:, 0]) > x0 + side) | (np.maximum(a[:, 1], b[:, 1]) < y0) | (np.minimum(a[:, 1], b[:, 1]) > y0 + side)
    d = b - a
    corners = [d[:, 0] * (y - a[:, 1]) - d[:, 1] * (x - a[:, 0]) for x in (x0, x0 + side) for y in (y0, y0 + side)]
    one_side = np.logical_and.reduce([c > 0 for c in corners]) | np.logical_and.reduce([c < 0 for c in corners])
    return ~(apart | one_side)


def _crossings(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, ring: np.ndarray, n_rings: int) -> np.ndarray:
    """Whether each point off every border is inside of each ring, by crossings: a row for each point."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = ((a[:, 1] > y[:, None]) != (b[:, 1] > y[:, None])) & (x[:, None] < (b[:, 0] - a[:, 0]) * (y[:, None] - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0])
    return np.stack([cross[:, ring == k].sum(1) % 2 == 1 for k in range(n_rings)], axis=1)


def _odd(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, ring: np.ndarray, n_rings: int) -> np.ndarray:
    """Inside the outline and inside no hole, for points off every border."""
    inside = _crossings(a, b, x, y, ring, n_rings)
    return inside[:, 0] & ~inside[:, 1:].any(1)


def strictly_inside(rings, x, y):
    """Column: x, y lies strictly inside the first ring and neither in nor on any other; even-odd rule."""

    def crossings(ring):
        edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: F.struct(F.get(p, F.lit(0)).alias("ax"), F.get(p, F.lit(1)).alias("ay"), F.get(q, F.lit(0)).alias("bx"), F.get(q, F.lit(1)).alias("by")))

        def step(acc, e):
            turn = (e.bx - e.ax) * (y - e.ay) - (e.by - e.ay) * (x - e.ax)
            on = (turn == 0) & (x >= F.least(e.ax, e.bx)) & (x <= F.greatest(e.ax, e.bx)) & (y >= F.least(e.ay, e.by)) & (y <= F.greatest(e.ay, e.by))
            up = (e.ay > y) != (e.by > y)
            cross = up & F.when(e.by > e.ay, turn > 0).otherwise(turn < 0)
            # odd crossings so far in bit 0, border in bit 1
            return F.when(on | (acc >= 2), F.lit(2)).when(cross, 1 - acc).otherwise(acc)

        return F.aggregate(edges, F.lit(0), step)

    outline = crossings(F.get(rings, F.lit(0))) == 1
    return outline & ~F.exists(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: crossings(r) > 0)


def _within_cell(rings, at, x, y):
    """Column: x, y lies strictly inside the first of a border cell's ``rings`` and neither in nor on any other.

    The way from the point ``at`` goes along y, then along x; each edge of the cell that it crosses changes the side. Both
    legs judge their common corner by the same sign, so a corner on an edge is on one side of it in both.
    """
    ax, ay = F.get(at, F.lit(0)), F.get(at, F.lit(1))

    def crossed(part):
        def step(acc, e):
            x1, y1, x2, y2 = (F.get(e, F.lit(k)) for k in range(4))
            turn = lambda px, py: (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
            here, corner = turn(x, y), turn(ax, y)
            on = (here == 0) & (x >= F.least(x1, x2)) & (x <= F.greatest(x1, x2)) & (y >= F.least(y1, y2)) & (y <= F.greatest(y1, y2))
            upright = ((x1 > ax) != (x2 > ax)) & ((turn(ax, ay) >= 0) != (corner >= 0))
            level = ((y1 > y) != (y2 > y)) & ((corner >= 0) != (here >= 0))
            # inside in bit 0, on the border in bit 1
            return F.when(on | (acc >= 2), F.lit(2)).when(upright != level, 1 - acc).otherwise(acc)

        return F.aggregate(part["edges"], F.when(part["inside"], 1).otherwise(0), step)

    return (crossed(F.get(rings, F.lit(0))) == 1) & ~F.exists(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: crossed(r) > 0)


def inside_regions(points: DataFrame, cover: DataFrame) -> DataFrame:
    """``id, region_id`` for each point strictly inside a region of its scope (see ``cover_regions``); once each.

    Both sides meet on scope and cell by equi-join, one copy of a point for each cell side in use in its scope (a
    handful). An inner cell accepts at once; only matches of border cells are tested, against the edges in the cell.
    """
    sides = small(cover.select("scope", "side").distinct())
    keyed = points.select("id", "scope", "x", "y").join(sides, "scope")
    keyed = keyed.withColumns({"cx": F.floor(F.col("x") / F.col("side")), "cy": F.floor(F.col("y") / F.col("side"))})
    matched = keyed.join(cover, ["scope", "side", "cx", "cy"])
    return matched.where(F.col("inner") | _within_cell(F.col("rings"), F.col("at"), F.col("x"), F.col("y"))).select("id", "region_id").distinct()
