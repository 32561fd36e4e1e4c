"""Grouping records into similarity clusters (problem 4).

Method: hierarchical density clustering on a neighbour graph with mutual reachability weights, distributed Borůvka
minimum spanning tree, condensed hierarchy, stability-based selection, most persistent members as exemplars.

Distances are angles. Records of one cell of the first hash table within half the similarity angle of another one, their
leader, are gathered (data bubbles, with their mean and radius): all members of a bubble are similar to one another, so
the graph of a dense set of any size is one of a few bubbles. Cells follow from the records alone, so bubbles
don't depend on how the table is partitioned. Bubbles find their neighbours through cross-polytope hash tables; within
a bucket a local spanning forest of the sure links is kept, and links that only single members might make are checked on
the members. Trees of the graph are condensed from all pairs of their records whatever their size: up to ``EXACT`` records
in one task, larger ones in pairs of parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselon.llm.components import group_pairs, union
from tesselon.session import discard, materialize, small

#: Rows of a cell gathered at a time, and rows of a bucket compared in one block.
CHUNK, BLOCK = 65_536, 1_024
#: Rows of a bucket beyond which it is compared in pairs of parts, each a task's group of its own.
HOT = 20_000
#: Edges that one task may finish; above, Borůvka rounds are distributed.
LOCAL_EDGES = 400_000
#: Rows that a hash bucket is meant to hold on average.
BUCKET_ROWS = 512
SEED = 20_240_607
#: Records, itself among them, that a record's core distance takes in.
MIN_SAMPLES = 5

MEMBERS = "leader long, id long, ang float, vec binary, n int, radius float, tight float, mean binary, codes array<long>"


@dataclass(frozen=True)
class Hashing:
    """Cross-polytope tables: ``rotations[t]`` are matrices whose largest coordinate gives one digit of the code."""

    rotations: list[list[np.ndarray]]

    def codes(self, vectors: np.ndarray, tables: int | None = None) -> np.ndarray:
        """A column for each table, or for the first few."""
        used = self.rotations[:tables]
        out = np.empty((len(vectors), len(used)), np.int64)
        rows = np.arange(len(vectors))
        for t, matrices in enumerate(used):
            code = np.zeros(len(vectors), np.int64)
            for m in matrices:
                y = vectors @ m
                top = np.abs(y).argmax(1)
                code = code * (2 * m.shape[1]) + 2 * top + (y[rows, top] > 0)
            out[:, t] = code
        return out


def hashing(dims: int, rows: int, angle: float, miss: float = 0.01) -> Hashing:
    """Tables for ``rows`` vectors: codes long enough for small buckets, and as many tables as a pair at ``angle``
    needs to share a bucket with probability 1 - ``miss`` (a nearer one does more often)."""
    rng = np.random.default_rng(SEED)

    def rotation(width: int) -> np.ndarray:
        q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
        return (q * np.sign(np.diag(r)))[:, :width].astype(np.float32)

    wanted = max(2.0, rows / BUCKET_ROWS)
    widths: list[int] = []
    have = 1.0
    while have < 0.75 * wanted:
        width = int(min(dims, max(1, 2 ** round(math.log2(wanted / have / 2)))))
        widths.append(width)
        have *= 2 * width
    a = rng.standard_normal((4_000, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b = math.cos(angle) * a + math.sin(angle) * b / np.linalg.norm(b, axis=1, keepdims=True)
    trial = Hashing([[rotation(w) for w in widths] for _ in range(4)])
    same = float((trial.codes(a) == trial.codes(b)).mean())
    tables = max(2, math.ceil(math.log(miss) / math.log(1 - min(max(same, 0.01), 0.99))))
    return Hashing([[rotation(w) for w in widths] for _ in range(tables)])


@dataclass(frozen=True)
class Graph:
    """``members``: bubbles' rows (see ``MEMBERS``; what is said of a bubble stands in its leader's row, where ``n`` is
    above 0; ``mean`` only of several); ``edges``: a, b, ang between leaders; ``labels``: node, label."""

    members: DataFrame
    edges: DataFrame
    labels: DataFrame
    angle: float


def neighbour_graph(df: DataFrame, record_id: str, vector: str, similarity: float = 0.95) -> Graph:
    """The graph of records with a cosine of at least ``similarity``, on bubbles.

    Null, empty, all-zero and non-finite vectors are similar to nothing and left out, null ids too; vectors of different
    lengths are never similar. Rows repeated with an id and vector count once; an id with several vectors is linked by each
    of them, and angles within a tree are those of one. An empty table gives empty results. Pairs at the very limit are found with probability 0.99, nearer ones
    almost surely; what is found is decided on 16-bit coordinates, that is to 2e-5 in the cosine.
    """
    rows = df.select(F.col(f"`{record_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<float>").alias("x")).where("id is not null and size(x) > 0")
    angle = math.acos(similarity)
    widths = sorted((r["d"], r["n"]) for r in rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect())  # a row for each length that occurs
    tables = {d: (k, hashing(d, n, angle)) for k, (d, n) in enumerate(widths)}
    crowded = materialize(rows.mapInArrow(_cell_counts(tables), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > CHUNK))
    many = crowded.count()
    laid = rows.mapInArrow(_cells(tables), "cell long, id long, d int, vec binary").withColumn("part", F.lit(0).cast("long"))
    if many:
        parts = small(crowded.select("cell", F.ceil(F.col("n") / CHUNK).alias("parts")), many)
        laid = laid.join(parts, "cell", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0).cast("long"))).drop("parts")
    laid = laid.repartition("cell", "part").sortWithinPartitions("cell", "part", "id", "vec")
    members = materialize(laid.mapInArrow(_gather(tables, angle), MEMBERS))
    payload = members.where("n > 0").select("leader", "radius", "tight", F.coalesce("mean", "vec").alias("mean"), "codes").mapInArrow(_payload, "bucket long, leader long, brief binary")
    crowded = materialize(members.where("n > 0").select(F.explode("codes").alias("bucket")).groupBy("bucket").count().where(F.col("count") > HOT))
    spread = pairs_of_parts(payload, crowded)
    laid = spread.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "leader")
    pairs = materialize(laid.mapInArrow(_neighbours(angle), "a long, b long, ang float, sure boolean").groupBy("a", "b").agg(F.min("ang").alias("ang"), F.max("sure").alias("sure")))
    checked = _check_members(members, pairs.where("not sure"), angle)
    edges = pairs.where("sure").select("a", "b", F.col("ang").cast("double").alias("ang"))
    if checked is not None:
        edges = edges.unionByName(checked)
    edges = materialize(edges)
    discard(pairs)
    linked = group_pairs(edges.withColumn("s", F.lit("")), "s", "a", "b").select(F.col("vertex").alias("node"), "label")
    return Graph(members, edges, linked, angle)


def pairs_of_parts(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """``rows`` with ``p, q``: 0, 0 in most buckets; rows of a ``crowded`` bucket (bucket, count) are cut into parts of
    about ``HOT`` by a hash of the leader and stand in each pair of parts that holds them."""
    n = crowded.count()
    if n == 0:
        return rows.withColumns({"p": F.lit(0).cast("long"), "q": F.lit(0).cast("long")})
    cut = rows.join(small(crowded.select("bucket", F.ceil(F.col("count") / HOT).alias("parts")), n), "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("leader"), F.col("parts"))
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return cut.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")}).drop("parts", "own", "other")


Tables = dict[int, tuple[int, Hashing]]


def _unit(ids: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = flat.astype(np.float64).reshape(len(ids), -1)
    norm = np.linalg.norm(x, axis=1)
    good = np.isfinite(norm) & (norm > 0)
    return ids[good], x[good] / norm[good, None]


def _by_width(batch: pa.RecordBatch, tables: Tables) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, unit vectors and cells of a batch, for each length of vectors; the length's number tops the cell."""
    ids, x = batch.column("id").to_numpy(), batch.column("x")
    size = x.value_lengths().to_numpy()
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        flat = x.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False) if len(at) < len(size) else x.flatten().to_numpy(zero_copy_only=False)
        own, v = _unit(ids[at], flat)
        k, hashed = tables[d]
        yield own, v, hashed.codes(v.astype(np.float32), 1)[:, 0] + (k << 48)


def _cell_counts(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, cell in _by_width(batch, tables):
                found, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    return run


def _cells(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, cell in _by_width(batch, tables):
                raw = np.rint(v * 32767).astype("<i2")
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ids), pa.array(np.full(len(ids), v.shape[1], np.int32)), _binary(raw)], names=["cell", "id", "d", "vec"])

    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _gather(tables: Tables, angle: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_by(batches, "cell", "part"):
            for part in _groups(rows, "cell", "part"):
                k, hashed = tables[part["d"][0].as_py()]
                yield _bubbles(part, hashed, angle, k)

    return run


def _bubbles(rows: pa.Table, hashed: Hashing, angle: float, width: int) -> pa.RecordBatch:
    """The members of the bubbles of one cell; bubbles stand in all buckets that any of their members falls in."""
    ids, quantised = rows["id"].to_numpy(), np.frombuffer(b"".join(rows["vec"].to_pylist()), "<i2").reshape(rows.num_rows, -1)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (quantised[1:] != quantised[:-1]).any(1)
    ids, quantised = ids[new], quantised[new]
    v = quantised / np.linalg.norm(quantised.astype(np.float64), axis=1, keepdims=True)
    v32 = v.astype(np.float32)
    codes = hashed.codes(v32)
    n = len(ids)
    leader = np.full(n, -1)
    leads = np.zeros(n, bool)
    half = math.cos(angle / 2 - 1e-6)
    for t in range(min(4, codes.shape[1]) if n > 1 else 0):
        free = np.flatnonzero((leader < 0) | leads)
        order = free[np.argsort(codes[free, t], kind="stable")]
        c = codes[order, t]
        cuts = np.flatnonzero(np.r_[True, c[1:] != c[:-1], True])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi - lo > 1:
                _absorb(order[lo:hi], v32, leader, leads, half)
    alone = leader < 0
    leader[alone] = np.flatnonzero(alone)
    size = np.bincount(leader, minlength=n).astype(np.int32)
    ang, radius, tight = (np.zeros(n, np.float32) for _ in range(3))
    tagged = codes + (np.arange(codes.shape[1]) << 32) + (width << 48)
    mean: list[bytes | None] = [None] * n
    code_lists: list[np.ndarray | None] = [row if size[i] == 1 else None for i, row in enumerate(tagged)]
    order = np.argsort(leader, kind="stable")
    starts = np.r_[0, np.cumsum(size[np.unique(leader)])]
    for head, lo, hi in zip(np.unique(leader), starts[:-1], starts[1:]):
        if hi - lo == 1:
            continue
        own = order[lo:hi]
        m = v[own].mean(0)
        m /= max(np.linalg.norm(m), 1e-12)
        ang[own] = np.arccos(np.clip(v[own] @ m, -1, 1))
        radius[head], tight[head] = ang[own].max(), ang[own].min()
        mean[head] = np.rint(m * 32767).astype("<i2").tobytes()
        code_lists[head] = np.unique(tagged[own])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[leader]), pa.array(ids), pa.array(ang), _binary(quantised), pa.array(size), pa.array(radius), pa.array(tight), pa.array(mean, pa.binary()), pa.array(code_lists, pa.list_(pa.int64()))],
        names=["leader", "id", "ang", "vec", "n", "radius", "tight", "mean", "codes"],
    )


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of each bubble for each of its buckets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        radius, tight = batch.column("radius").to_numpy(), batch.column("tight").to_numpy()
        brief = [_to_brief(r, t, np.frombuffer(m, "<i2").astype(np.float32)) for r, t, m in zip(radius, tight, batch.column("mean").to_pylist())]
        times = pa.array(np.repeat(np.arange(batch.num_rows), batch.column("codes").value_lengths().to_numpy()))
        yield pa.RecordBatch.from_arrays([batch.column("codes").flatten(), batch.column("leader").take(times), pa.array(brief, pa.binary()).take(times)], names=["bucket", "leader", "brief"])


def _absorb(rows: np.ndarray, v: np.ndarray, leader: np.ndarray, leads: np.ndarray, half: float) -> None:
    """Gather free rows of one bucket: to a present leader if near, else around the row with the most near free rows.

    Of a large bucket, blocks are taken one after another; what stays free is alone and no less exact.
    """
    heads = rows[leads[rows]]
    free = rows[leader[rows] < 0]
    for start in range(0, len(heads), BLOCK):
        some = heads[start : start + BLOCK]
        for at in range(0, len(free), 4 * BLOCK):
            part = free[at : at + 4 * BLOCK]
            s = v[part] @ v[some].T
            best = s.argmax(1)
            near = (s[np.arange(len(part)), best] >= half) & (leader[part] < 0)
            leader[part[near]] = some[best[near]]
    free = free[leader[free] < 0]
    while len(free) > 1:
        block = free[:BLOCK]
        near = v[block] @ v[block].T >= half
        new = []
        degree = near.sum(1)
        while (k := int(degree.argmax())) >= 0 and degree[k] > 1:
            got = np.flatnonzero(near[k])
            leader[block[got]] = block[k]
            leads[block[k]] = True
            new.append(block[k])
            degree -= near[:, got].sum(1)
            near[got] = False
            near[:, got] = False
            degree[got] = 0
        free = free[BLOCK:]
        if new and len(free):
            some = np.array(new)
            for at in range(0, len(free), 4 * BLOCK):
                part = free[at : at + 4 * BLOCK]
                s = v[part] @ v[some].T
                best = s.argmax(1)
                near_some = s[np.arange(len(part)), best] >= half
                leader[part[near_some]] = some[best[near_some]]
            free = free[leader[free] < 0]


def _rows_by(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` in a sorted partition, a few batches at a time and never cut within a key."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if kept is not None:
            rows = pa.concat_tables([kept, rows])
        cut = int(_starts(rows, *keys)[-1])
        if cut:
            yield rows.slice(0, cut)
        kept = rows.slice(cut)
    if kept is not None and kept.num_rows:
        yield kept


def _starts(rows: pa.Table, *keys: str) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        k = rows[key].to_numpy()
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _groups(rows: pa.Table, *keys: str) -> Iterator[pa.Table]:
    cuts = np.r_[_starts(rows, *keys), rows.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield rows.slice(lo, hi - lo)


def _same_width(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, by the length of their vectors."""
    width = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32, batch.num_rows + 1, 4 * batch.column(column).offset)) if batch.num_rows else np.empty(0)
    for d in np.unique(width):
        yield batch if (width == d).all() else batch.take(pa.array(np.flatnonzero(width == d)))


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors from their 16-bit form."""
    raw = column.to_pylist()
    v = np.frombuffer(b"".join(raw), "<i2").reshape(len(raw), -1).astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _to_brief(radius: float, nearest: float, mean: np.ndarray) -> bytes:
    """What the hash tables carry of a bubble: its radius, the angle of the member nearest its mean, the mean in 8 bits."""
    return np.array([radius, nearest], "<f4").tobytes() + np.rint(mean / np.abs(mean).max() * 127).astype(np.int8).tobytes()


def _from_brief(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``wide`` and ``tight``: how far the outermost and the nearest member may be from the given unit vector, the
    error of its 8 bits included; and that vector."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    head = np.ascontiguousarray(raw[:, :8]).view("<f4")
    v = raw[:, 8:].view(np.int8).astype(np.float32)
    length = np.linalg.norm(v, axis=1)
    off = np.arcsin(np.minimum(1, math.sqrt(v.shape[1]) / 2 / np.maximum(length, 1e-12))).astype(np.float32) + np.float32(1e-5)
    return head[:, 0] + off, head[:, 1] + off, v / np.maximum(length[:, None], 1e-12)


def _neighbours(angle: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_by(batches, "bucket", "p", "q"):
            parts = []
            width = rows["bucket"].to_numpy() >> 48
            for at in np.split(np.arange(rows.num_rows), np.flatnonzero(np.diff(width)) + 1):
                some = rows.slice(at[0], len(at))
                ids = some["leader"].to_numpy()
                wide, tight, v = _from_brief(some["brief"])
                cuts = np.r_[_starts(some, "bucket", "p", "q"), len(at)]
                parts += [p for lo, hi in zip(cuts[:-1], cuts[1:]) if hi - lo > 1 for p in _bucket(ids[lo:hi], wide[lo:hi], tight[lo:hi], v[lo:hi], angle)]
            if parts:
                a, b, w, sure = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(w.astype(np.float32)), pa.array(sure)], names=["a", "b", "ang", "sure"])

    return run


def _bucket(ids: np.ndarray, wide: np.ndarray, tight: np.ndarray, v: np.ndarray, angle: float) -> Iterator[tuple[np.ndarray, ...]]:
    """A spanning forest of the sure links of one bucket, and the links between its trees that members might make.

    A large bucket is sorted by one coordinate and compared in blocks; blocks too far apart in it are skipped.
    """
    if len(ids) > BLOCK:
        axis = int(v.var(0).argmax())
        order = np.argsort(v[:, axis], kind="stable")
        ids, wide, tight, v = ids[order], wide[order], tight[order], v[order]
        place = v[:, axis]
        reach = 2 * math.sin(min(math.pi, angle + 2 * float(wide.max())) / 2)
    n = len(ids)
    sure: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    maybe: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for p in range(0, n, BLOCK):
        for q in range(p, n, BLOCK):
            if q > p and place[q] - place[min(p + BLOCK, n) - 1] > reach:
                break
            s = v[p : p + BLOCK] @ v[q : q + BLOCK].T
            top = wide[p : p + BLOCK].max() + wide[q : q + BLOCK].max()
            i, j = np.nonzero(s >= math.cos(min(math.pi, angle + float(top))))
            i, j = i + p, j + q
            ahead = (j > i) & (ids[i] != ids[j])
            i, j = i[ahead], j[ahead]
            w = np.arccos(np.clip(s[i - p, j - q], -1, 1))
            near = w <= angle - tight[i] - tight[j]
            sure.append(_forest(i[near], j[near], w[near], n) if near.sum() > 4 * n else (i[near], j[near], w[near]))
            could = ~near & (w <= angle + wide[i] + wide[j])
            maybe.append((i[could], j[could], w[could]))
    i, j, w = (np.concatenate(x) for x in zip(*sure))
    i, j, w = _forest(i, j, w, n)
    tree = union(i, j, n)
    yield ids[i], ids[j], w, np.ones(len(i), bool)
    i, j, w = (np.concatenate(x) for x in zip(*maybe))
    apart = tree[i] != tree[j]
    yield ids[i[apart]], ids[j[apart]], w[apart], np.zeros(int(apart.sum()), bool)


def _forest(i: np.ndarray, j: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forest (Borůvka): each tree takes its least edge, ties by the edge's place in order."""
    order = np.lexsort((j, i, w))
    i, j, w = i[order], j[order], w[order]
    taken = np.zeros(len(i), bool)
    tree = np.arange(n)
    left = np.arange(len(i))
    while len(left):
        a, b = tree[i[left]], tree[j[left]]
        apart = a != b
        left, a, b = left[apart], a[apart], b[apart]
        if not len(left):
            break
        least = np.full(n, len(i))
        np.minimum.at(least, a, left)
        np.minimum.at(least, b, left)
        chosen = np.unique(least[least < len(i)])
        taken[chosen] = True
        tree = union(np.concatenate([i[chosen], np.arange(n)]), np.concatenate([j[chosen], tree]), n)
    return i[taken], j[taken], w[taken]


def _check_members(members: DataFrame, maybe: DataFrame, angle: float) -> DataFrame | None:
    """Links a, b with the angle of their nearest pair of members, of the ``maybe`` ones that hold.

    A member can only take part if it lies as far from its bubble's mean as the means' distance leaves open.
    """
    if maybe.isEmpty():
        return None
    one = members.select(F.col("leader").alias("a"), F.col("id").alias("p"), F.col("ang").alias("pa"), F.col("vec").alias("pv"))
    two = members.select(F.col("leader").alias("b"), F.col("id").alias("q"), F.col("ang").alias("qa"), F.col("vec").alias("qv"))
    widest = maybe.groupBy("b").agg(F.max("ang").alias("t"))
    reach = materialize(two.join(small(widest.select("b")), "b", "left_semi").groupBy("b").agg(F.max("qa").alias("rb")))
    asked = materialize(maybe.select("a", "b", "ang").join(small(reach), "b"))
    open_angle = angle + 0.03  # the means' angle comes from their 8-bit forms
    left = one.join(small(asked), "a").where(F.col("pa") + F.col("rb") >= F.col("ang") - open_angle).select("b", "a", "ang", "pa", "pv")
    both = left.join(two.select("b", "qa", "qv"), "b").where(F.col("pa") + F.col("qa") >= F.col("ang") - open_angle).select("a", "b", "pv", "qv")
    limit = math.cos(angle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in _same_width(whole, "pv")):
            s = (_vectors(batch.column("pv")).astype(np.float64) * _vectors(batch.column("qv"))).sum(1)
            hit = np.flatnonzero(s >= limit - 2e-8)
            if len(hit):
                yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(hit)), batch.column("b").take(pa.array(hit)), pa.array(np.arccos(np.clip(s[hit], -1, 1)))], names=["a", "b", "ang"])

    return both.mapInArrow(run, "a long, b long, ang double").groupBy("a", "b").agg(F.min("ang").alias("ang"))


def similar_sets(graph: Graph, found: DataFrame) -> DataFrame:
    """``id, cluster``: records of sets of two or more that are all similar to one another and to no record outside;
    ``cluster`` is the smallest id of the set.

    The candidates are the roots of the ``hierarchy`` ``found``, that is the subtrees of the spanning forest at the
    similarity angle; the widest pair of each is known from there.
    """
    return found.where("tight").select("id", "cluster")


def spanning_tree(graph: Graph, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``a, b, w, tree``: minimum spanning forest of the nodes by the angles of the edges.

    While the graph is large, Borůvka rounds run on all edges: each tree's least edge is one grouped minimum, trees are
    merged by connected components and parallel edges reduced to the least. A remainder that fits one task by count is
    finished there.
    """
    edges = materialize(graph.edges.select("a", "b", F.col("ang").alias("w"), F.col("a").alias("ta"), F.col("b").alias("tb")))
    done: list[DataFrame] = []
    n = edges.count()
    while n > local_edges:
        pick = F.min(F.struct("w", "a", "b", "ta", "tb")).alias("e")
        least = edges.select(F.explode(F.array("ta", "tb")).alias("t"), "w", "a", "b", "ta", "tb").groupBy("t").agg(pick).select("e.*").distinct()
        least = materialize(least)
        done.append(least.select("a", "b", "w"))
        merged = group_pairs(least.withColumn("s", F.lit("")), "s", "ta", "tb").select("vertex", "label")
        to = lambda c: small(merged.select(F.col("vertex").alias(c), F.col("label").alias(f"{c}_new")))
        moved = edges.join(to("ta"), "ta").join(to("tb"), "tb").where("ta_new <> tb_new")
        pair = [F.least("ta_new", "tb_new").alias("ta"), F.greatest("ta_new", "tb_new").alias("tb")]
        edges = materialize(moved.groupBy(*pair).agg(F.min(F.struct("w", "a", "b")).alias("e")).select("e.a", "e.b", "e.w", "ta", "tb"))
        n = edges.count()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            t = pa.Table.from_batches(rows)
            _, at = np.unique(np.concatenate([t["ta"].to_numpy(), t["tb"].to_numpy()]), return_inverse=True)
            m = t.num_rows
            order = np.lexsort((t["b"].to_numpy(), t["a"].to_numpy(), t["w"].to_numpy()))
            t = t.take(pa.array(order))
            i, j = at[:m][order], at[m:][order]
            marks = np.arange(m, dtype=float)  # the order already breaks ties
            _, _, kept = _forest(i, j, marks, int(at.max()) + 1)
            yield from t.take(pa.array(kept.astype(np.int64))).select(["a", "b", "w"]).combine_chunks().to_batches()

    out = edges.repartition(1).mapInArrow(finish, "a long, b long, w double")
    for part in done:
        out = out.unionByName(part)
    return materialize(out.join(graph.labels.withColumnsRenamed({"node": "a", "label": "tree"}), "a"))


#: Different vectors of a tree that make a part, as long as the tree has no more than ``PARTS`` of them.
PART, PARTS = 32_768, 32
#: Records of a tree up to which one task has all their pairs, as many as two parts hold; a larger tree is cut in parts,
#: with the same result.
EXACT = 2 * PART
#: Records up to which trees of one size are spanned together.
SMALL = 100
#: Nearest points listed of each point, rows and columns of a block of cosines.
LISTED, ROWS, COLUMNS = 8, 64, 4_096
#: Pairs of vectors meant for one task.
TASK_PAIRS = 16_000_000
#: Error of a cosine in single precision, with room to spare.
ROUGH = 1e-5

#: Nodes of a tree that one task condenses; a tree of more is folded in rounds.
NODES = 100_000

HIERARCHY = "tree long, node long, id long, part long, strength double, stability double, tight boolean, cluster long"


def hierarchy(graph: Graph, min_cluster_size: int = 2, exact: int = EXACT) -> DataFrame:
    """``tree, node, id, part, strength, stability, tight, cluster`` of every linked record.

    ``part`` names the chosen cluster, null outside of all; ``tight`` says whether no pair of the tree is farther apart
    than the angle, ``cluster`` is its smallest id. All trees are condensed from all pairs of their records; ``exact``
    only says up to how many records one task does so, it plays no part in the results.
    """
    heads = graph.members.where("n > 0").select(F.col("leader").alias("node"), "n")
    trees = heads.join(small(graph.labels), "node", "left").select("node", F.coalesce("label", "node").alias("tree"), "n")
    sizes = trees.groupBy("tree").agg(F.sum("n").alias("size")).where(F.col("size") >= min_cluster_size)
    placed = materialize(trees.select("node", "tree").join(sizes, "tree"))
    laid = graph.members.select(F.col("leader").alias("node"), "id", "vec").join(small(placed.where(F.col("size") <= exact).drop("size")), "node")
    laid = laid.repartition("tree").sortWithinPartitions("tree", "id", "vec")
    out = laid.mapInArrow(_condense_records(graph.angle, min_cluster_size), HIERARCHY)
    large = placed.where(F.col("size") > exact).drop("size")
    if not large.isEmpty():
        out = out.unionByName(_hierarchy_in_parts(graph, large, min_cluster_size))
    return materialize(out)


def _hierarchy_in_parts(graph: Graph, large: DataFrame, least: int, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """``hierarchy`` of the trees ``large`` (node, tree), by the steps of ``_condense_records`` in pairs of parts.

    Equal vectors are one point with a number ``n``, so copies cost nothing; all pairs of points are compared, once for
    the core distances and once for the spanning trees of the pairs of parts, which hold that of the whole.
    """
    angle, k = graph.angle, max(1, min_samples - 1)
    rows = graph.members.select(F.col("leader").alias("node"), "id", "vec").join(small(large), "node")
    rows = rows.groupBy("tree", "id").agg(F.min(F.struct("vec", "node")).alias("r")).select("tree", "id", "r.vec", "r.node")
    records = materialize(rows.withColumn("key", F.monotonically_increasing_id()))  # an id may stand in several trees
    points = materialize(records.groupBy("tree", "vec").agg(F.min("key").alias("key"), F.count("*").alias("n")))
    sizes = points.groupBy("tree").agg(F.sum("n").alias("size"), F.count("*").alias("points")).where(F.col("size") >= least)
    sizes = materialize(sizes.withColumn("parts", F.least(F.ceil(F.col("points") / PART), F.lit(PARTS)).cast("long")))
    pairs = sizes.agg(F.sum(F.col("points").cast("double") ** 2 / 2)).first()[0] or 0
    tasks = int(min(1_024, 2 * math.ceil(pairs / TASK_PAIRS) + 1))
    points = points.join(small(sizes.select("tree", "size", "parts")), "tree").withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts")))
    points = materialize(points)
    near = _in_pairs_of_parts(points, tasks).mapInArrow(_nearest(k), "tree long, key long, near array<double>, low double")
    near = materialize(near)
    copies = points.where("n > 1").select("tree", "key", F.array_repeat(F.lit(1.0), F.least("n", F.lit(k + 1)).cast("int") - 1).alias("near"))
    nearest = near.select("tree", "key", "near").unionByName(copies).groupBy("tree", "key").agg(F.sort_array(F.flatten(F.collect_list("near")), False).alias("near"))
    last = F.least(F.lit(k), F.col("size") - 1).cast("int")  # of a smaller tree the last record
    core = nearest.join(small(sizes.select("tree", "size")), "tree").select("key", F.greatest(F.element_at("near", F.greatest(last, F.lit(1))), F.lit(math.cos(angle))).alias("core"))
    points = materialize(points.join(small(core), "key"))
    edges = _in_pairs_of_parts(points, tasks, "core").mapInArrow(_part_trees(angle), "a long, b long, ang double")
    labels = points.select(F.col("key").alias("node"), F.col("tree").alias("label"))
    tree = spanning_tree(Graph(graph.members, edges, labels, angle)).select("tree", "a", "b", "w")
    # copies join their point at its core distance
    joined = records.select("tree", "vec", F.col("key").alias("b")).join(points.where("n > 1").select("tree", "vec", F.col("key").alias("a"), "core"), ["tree", "vec"]).where("a <> b")
    joined = joined.select("tree", "a", "b", "core").mapInArrow(_core_edges(angle), "tree long, a long, b long, w double")
    nodes = records.join(small(sizes.select("tree")), "tree", "left_semi").select("tree", F.col("key").alias("node"), F.lit(1).cast("long").alias("n"), F.lit(0.0).alias("total"), F.lit(0.0).alias("below"))
    chosen = condense_trees(nodes, materialize(tree.unionByName(joined)), angle, least).withColumnsRenamed({"node": "key", "part": "named"})
    found = materialize(records.select("tree", "node", "id", "key").join(small(chosen), "key"))
    names = found.where("named is not null").groupBy("named").agg(F.min("id").alias("part"))
    whole = near.groupBy("tree").agg((F.min("low") >= math.cos(angle) - 2e-8).alias("tight"))
    whole = whole.join(records.groupBy("tree").agg(F.min("id").alias("cluster")), "tree")
    found = found.join(small(names), "named", "left").join(small(whole), "tree")
    return found.select("tree", "node", "id", "part", F.col("leave").alias("strength"), "stability", "tight", "cluster")


def _in_pairs_of_parts(points: DataFrame, tasks: int, *columns: str) -> DataFrame:
    """``points`` laid out by ``tree, p, q``, the pairs of their parts; ``side`` 1 follows 0 if p and q differ."""
    spread = points.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.select("tree", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("side"), "key", "n", "vec", *columns)
    return spread.repartition(tasks, "tree", "p", "q").sortWithinPartitions("tree", "p", "q", "side", "key")


def _pairs_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, int]]:
    """Each pair of parts, its vectors in 16-bit steps and the row at which the second part begins, 0 within a part."""
    for rows in _rows_by(batches, "tree", "p", "q"):
        for group in _groups(rows, "tree", "p", "q"):
            n, second = group.num_rows, int(group["side"].to_numpy().sum())
            apart = group["p"][0].as_py() != group["q"][0].as_py()
            if apart and second in (0, n):  # a part without points
                continue
            yield group, np.frombuffer(b"".join(group["vec"].to_pylist()), "<i2").reshape(n, -1).astype(np.float64), n - second if apart else 0


def _nearest(k: int):
    """Of each point the cosines of the ``k`` nearest other records in the other part (or the same), -2 where there
    are fewer, and the lowest cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, v, cut in _pairs_of_parts(batches):
            size, n = len(v), group["n"].to_numpy()
            near, low = np.full((size, k), -2.0), 2.0
            for lo, hi, start, end in [(0, cut, cut, size), (cut, size, 0, cut)] if cut else [(0, size, 0, size)]:
                listed = nearest_points(v, (lo, hi), (start, end), 2 * k)
                near[lo:hi] = _nearest_records(v, n, k, (lo, hi), (start, end), listed)
                low = min(low, listed.low)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, size * k + 1, k, dtype=np.int32)), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([group["tree"].combine_chunks(), group["key"].combine_chunks(), lists, pa.array(np.full(size, low))], names=["tree", "key", "near", "low"])

    return run


@dataclass(frozen=True)
class Listed:
    """Of each row its nearest columns and their cosines, the nearest first; ``bound``: what no cosine of another column
    is above, -2 if there is none; ``low``: the lowest cosine of all."""

    near: np.ndarray
    cos: np.ndarray
    bound: np.ndarray
    low: float


def nearest_points(v: np.ndarray, rows: tuple[int, int], columns: tuple[int, int], width: int) -> Listed:
    """The ``width`` nearest of ``v[columns]`` to each of ``v[rows]``, ranges that are the same or apart.

    Blocks of rough cosines are compared with the least one listed so far, so few are ever sorted.
    """
    (lo, hi), (start, end) = rows, columns
    others = end - start - (lo == start)
    width = min(width, others)
    if not width:
        return Listed(np.empty((hi - lo, 0), np.int64), np.empty((hi - lo, 0)), np.full(hi - lo, -2.0), 1.0)
    scale = 1 / np.maximum(np.linalg.norm(v, axis=1), 1e-12)
    unit = (v * scale[:, None]).astype(np.float32)
    flipped = np.ascontiguousarray(unit[start:end].T)
    near, last, low = np.empty((hi - lo, width), np.int64), np.empty(hi - lo), 2.0
    for at in range(lo, hi, ROWS):
        until = min(at + ROWS, hi)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        begin, stop = start, min(end, start + max(256, 4 * width))
        while begin < end:
            s = unit[at:until] @ flipped[:, begin - start : stop - start]
            if float(s.min()) < low + 2 * ROUGH:
                low = min(low, float(cosines(v[at:until], v[begin:stop]).min()))
            own = np.arange(max(at, begin), min(until, stop))
            s[own - at, own - begin] = -3
            if begin == start:
                least = np.partition(s, s.shape[1] - width, axis=1)[:, s.shape[1] - width]
            hit = np.flatnonzero(s >= least[:, None])
            i, j = np.divmod(hit, stop - begin)
            held.append((i, j + begin, s.ravel()[hit]))
            begin, stop = stop, min(end, 2 * stop - start, stop + COLUMNS)
            if begin == end or sum(len(x[0]) for x in held) > 2 * width * (until - at):
                i, j, c = (np.concatenate(x) for x in zip(*held))
                order = np.lexsort((-c, i))
                order = order[_rank(i[order]) < width]
                held = [(i[order], j[order], c[order])]
                least = held[0][2].reshape(-1, width)[:, -1]
        near[at - lo : until - lo], last[at - lo : until - lo] = held[0][1].reshape(-1, width), least
    cos = _cosines_of(v, scale, np.repeat(np.arange(lo, hi), width), near.ravel()).reshape(near.shape)
    order = np.argsort(-cos, axis=1, kind="stable")
    bound = last + ROUGH if width < others else np.full(hi - lo, -2.0)
    return Listed(np.take_along_axis(near, order, 1), np.take_along_axis(cos, order, 1), bound, low)


def _nearest_records(v: np.ndarray, n: np.ndarray, k: int, rows: tuple[int, int], columns: tuple[int, int], listed: Listed) -> np.ndarray:
    """Cosines of the ``k`` nearest records to each row, of which a column is ``n``; rows whose list leaves them open are
    compared with all columns."""

    def records(near: np.ndarray, cos: np.ndarray) -> np.ndarray:
        reached = np.cumsum(n[near], axis=1)
        out = np.full((len(near), k), -2.0)
        for t in range(k if near.shape[1] else 0):
            at = (reached > t).argmax(1)
            out[:, t] = np.where(reached[:, -1] > t, cos[np.arange(len(near)), at], -2)
        return out

    (lo, _), (start, end) = rows, columns
    out = records(listed.near, listed.cos)
    left = np.flatnonzero(out[:, -1] < listed.bound)
    width = min(k, end - start)
    step = max(1, 2**20 // (end - start))
    for at in range(0, len(left), step):
        some = left[at : at + step]
        s = cosines(v[lo + some], v[start:end])
        if lo == start:
            s[np.arange(len(some)), some] = -2
        j = np.argpartition(s, end - start - width, axis=1)[:, end - start - width :]
        j = np.take_along_axis(j, np.argsort(-np.take_along_axis(s, j, 1), axis=1), 1)
        out[some] = records(j + start, np.take_along_axis(s, j, 1))
    return out


def _rank(i: np.ndarray) -> np.ndarray:
    """Place of each value of ``i``, in order, among its equals."""
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
    return np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))


def _cosines_of(v: np.ndarray, scale: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of pairs of rows, to the last bit those of ``cosines``."""
    out = np.empty(len(i))
    for at in range(0, len(i), 65_536):
        a, b = i[at : at + 65_536], j[at : at + 65_536]
        out[at : at + 65_536] = np.einsum("ij,ij->i", v[a], v[b]) * (scale[a] * scale[b])
    return out


def _part_trees(angle: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, v, cut in _pairs_of_parts(batches):
            keys = group["key"].to_numpy()
            a, b, s = dense_tree(v, group["core"].to_numpy(), math.cos(angle), cut)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(keys[a], keys[b])), pa.array(np.maximum(keys[a], keys[b])), pa.array(_lengths(s, angle))], names=["a", "b", "ang"])

    return run


def _core_edges(angle: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(_lengths(batch.column("core").to_numpy(), angle))], names=["tree", "a", "b", "w"])

    return run


def clusters(graph: Graph, min_cluster_size: int = 2, exemplars: int = 3, exact: int = EXACT) -> tuple[DataFrame, DataFrame]:
    """``id, cluster, strength`` of the clustered records, and ``cluster, size, stability, exemplars`` of each cluster.

    Every tree of the neighbour graph is condensed: read from the widest edge down, a split that leaves
    ``min_cluster_size`` records on two sides or more starts new clusters, else records fall out of the old one; edges
    of one length are cut together. Of a cluster and those below it the more stable choice is kept. ``strength`` is 1
    over the length of the edge at which a record falls out (at most 1000); exemplars are the strongest members, ties
    to the smaller id. ``cluster`` is its smallest id.
    """
    found = hierarchy(graph, min_cluster_size, exact).where("part is not null").select("part", "id", "strength", "stability")
    found = materialize(found.groupBy("part", "id").agg(F.max("strength").alias("strength"), F.max("stability").alias("stability")))
    order = F.struct((-F.col("strength")).alias("s"), "id")
    sizes = found.groupBy("part").agg(F.min("id").alias("cluster"), F.count("*").alias("size"), F.max("stability").alias("stability")).where(F.col("size") >= min_cluster_size)
    top = found.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy(F.desc("strength"), "id"))).where(F.col("r") <= exemplars)
    typical = top.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x.id).alias("exemplars"))
    sizes = materialize(sizes)
    rows_of = found.join(small(sizes.select("part", "cluster")), "part").select("id", "cluster", "strength")
    return rows_of, sizes.join(typical, "part").select("cluster", "size", "stability", "exemplars")


def _condense_records(angle: float, least: int, min_samples: int = MIN_SAMPLES):
    limit = math.cos(angle) - 2e-8

    def spanned(vecs: list[bytes], starts: list[int], n: int) -> Iterator[tuple]:
        many = max(1, 2**19 // n**2) if n <= SMALL else 1
        for at in range(0, len(starts), many):
            some = starts[at : at + many]
            v = np.frombuffer(b"".join(x for lo in some for x in vecs[lo : lo + n]), "<i2").reshape(len(some), n, -1).astype(np.float64)
            yield from zip(*small_trees(v, angle, min_samples)) if n <= SMALL else [record_tree(v[0], angle, min_samples)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_by(batches, "tree"):
            out = []
            first = _starts(rows, "tree", "id")
            tree, node, ids, vecs = (rows[c].take(pa.array(first)) for c in ("tree", "node", "id", "vec"))
            tree, node, ids, vecs = tree.to_numpy(), node.to_numpy(), ids.to_numpy(), vecs.to_pylist()
            cuts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1], True])
            sized: dict[tuple[int, int], list[int]] = {}
            for lo, n in zip(cuts[:-1].tolist(), np.diff(cuts).tolist()):
                if n >= least:
                    sized.setdefault((n, len(vecs[lo])), []).append(lo)
            for (n, _), starts in sized.items():
                lone, none = np.ones(n, np.int64), np.zeros(n)
                for lo, (a, b, w, lowest) in zip(starts, spanned(vecs, starts, n)):
                    own = ids[lo : lo + n]
                    part, stability, leave, _ = fold(own, lone, none, none, own[a], own[b], w, angle, least, close=True)[0]
                    out.append((tree[lo : lo + n], node[lo : lo + n], own, part, leave, stability, np.full(n, lowest >= limit), np.full(n, own[0])))
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                lost = cols[3] == NO_PART
                masked = [pa.array(c, mask=lost) if k in (3, 5) else pa.array(c) for k, c in enumerate(cols)]
                yield pa.RecordBatch.from_arrays(masked, names=["tree", "node", "id", "part", "strength", "stability", "tight", "cluster"])

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all rows of ``a`` with all of ``b``. Products of whole numbers, as vectors in 16-bit steps are, are exact in any
    order, so a pair has the same cosine to the last bit in whatever blocks, and from either side."""
    s = a @ b.T
    s *= (1 / np.maximum(np.linalg.norm(a, axis=1), 1e-12))[:, None] * (1 / np.maximum(np.linalg.norm(b, axis=1), 1e-12))
    return s


def _lengths(s: np.ndarray, angle: float) -> np.ndarray:
    """Angles of the cosines ``s``, at most ``angle``."""
    return np.where(s <= math.cos(angle), angle, np.minimum(np.arccos(np.clip(s, -1, 1)), angle))


def dense_tree(v: np.ndarray, core: np.ndarray, floor: float, cut: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning tree (Prim) of the rows of ``v`` by the highest of their mutual reachability as cosines, the least of
    cosine and both ``core``, ``floor`` at least; with ``cut`` only of the pairs of a row before it and one from it on."""
    n = len(v)
    rows, v, core, scale = np.arange(n), v.copy(), np.maximum(core, floor), 1 / np.maximum(np.linalg.norm(v, axis=1), 1e-12)
    best, source = np.full(n, -np.inf), np.zeros(n, np.int64)
    a, b, s = np.zeros(n - 1, np.int64), np.zeros(n - 1, np.int64), np.zeros(n - 1)
    begin, left = (0, cut), [cut or n, n - cut if cut else 0]  # rows outside of the tree stand first on each side
    at = side = 0
    for step in range(n - 1):
        x, own, own_scale, own_core = rows[at], v[at].copy(), scale[at], core[at]
        left[side] -= 1
        for column in (rows, v, core, scale, best, source):
            column[at] = column[begin[side] + left[side]]
        other = 1 - side if cut else 0
        if left[other]:
            out = slice(begin[other], begin[other] + left[other])
            reach = v[out] @ own
            reach *= scale[out] * own_scale
            np.minimum(reach, core[out], out=reach)
            np.minimum(reach, own_core, out=reach)
            np.maximum(reach, floor, out=reach)
            nearer = np.flatnonzero(reach > best[out])
            best[out][nearer] = reach[nearer]
            source[out][nearer] = x
        at = max((begin[k] + int(best[begin[k] : begin[k] + left[k]].argmax()) for k in (0, 1) if left[k]), key=best.__getitem__)
        side = int(0 < cut <= at)
        a[step], b[step], s[step] = source[at], rows[at], best[at]
    return a, b, s


def record_tree(v: np.ndarray, angle: float, min_samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Minimum spanning tree of the rows of ``v``, linked at ``angle``, by mutual reachability, edges by weight; and the
    cosine of the widest pair.

    A core distance is the angle to the (``min_samples`` - 1)-th other record, of a smaller tree to the last one, and
    ``angle`` where that is farther. Copies of a vector are compared once and join at their core distance.
    """
    _, first, point, n = np.unique(v.astype("<i2").view(f"V{2 * v.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True)
    k, floor = max(1, min(min_samples - 1, len(v) - 1)), math.cos(angle)
    x, m = v[first], len(first)
    listed = nearest_points(x, (0, m), (0, m), max(LISTED, 2 * k))
    near = _nearest_records(x, n, k, (0, m), (0, m), listed)
    core = np.maximum(np.where(n > k, 1.0, near[np.arange(m), np.maximum(k - n, 0)]), floor)
    a, b, s = _tree_of_lists(x, core, floor, listed)
    copy = np.flatnonzero(first[point] != np.arange(len(v)))
    a, b, s = np.r_[first[a], first[point[copy]]], np.r_[first[b], copy], np.r_[s, core[point[copy]]]
    w = _lengths(s, angle)
    order = np.argsort(w, kind="stable")
    return a[order], b[order], w[order], listed.low


def _tree_of_lists(v: np.ndarray, core: np.ndarray, floor: float, listed: Listed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``dense_tree`` from the nearest points of each.

    The links listed are spanned first. One that neither end lists reaches no more than the bounds of both ends, so it
    can only count where an end joins the main branch of that tree further down than its bound; the rows of such ends
    are compared with all others, and so are trees that lists leave apart. If these are many, all pairs are taken.
    """
    m, width = listed.near.shape
    step = max(1, 2**20 // m)

    def reach(rows: np.ndarray) -> np.ndarray:
        s = cosines(v[rows], v)
        np.minimum(s, core, out=s)
        np.minimum(s, core[rows][:, None], out=s)
        return np.maximum(s, floor, out=s)

    def spanned(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j, s = (np.concatenate(x) for x in zip(*parts))
        a, b, w = _forest(i, j, -s, m)
        order = np.argsort(w, kind="stable")
        return a[order], b[order], -w[order]

    i, j = np.repeat(np.arange(m), width), listed.near.ravel()
    a, b, s = spanned([(i, j, np.maximum(np.minimum(listed.cos.ravel(), np.minimum(core[i], core[j])), floor))])
    while len(a) < m - 1:
        tree = union(a, b, m)
        apart = np.flatnonzero(tree != np.bincount(tree).argmax())
        if 8 * len(apart) > m:
            return dense_tree(v, core, floor)
        links = [(a, b, s)]
        for at in range(0, len(apart), step):
            rows = apart[at : at + step]
            c = reach(rows)
            c[tree[rows][:, None] == tree] = -2
            best = c.argmax(1)
            links.append((rows, best, c[np.arange(len(rows)), best]))
        a, b, s = spanned(links)
    if width >= m - 1:
        return a, b, s
    order, gap, main = _leaves(a, b, s, m)
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    joins = _joined(gap, place[[main]])[0][place]
    open_ends = np.flatnonzero(joins < np.maximum(np.minimum(listed.bound, core), floor))
    if 8 * len(open_ends) > m:
        return dense_tree(v, core, floor)
    links = [(a, b, s)]
    for at in range(0, len(open_ends), step):
        rows = open_ends[at : at + step]
        c = reach(rows)
        c[np.arange(len(rows)), rows] = -2
        i, j = np.nonzero(c > _joined(gap, place[rows])[:, place])
        links.append((rows[i], j, c[i, j]))
    return spanned(links) if sum(len(x[0]) for x in links) > len(a) else (a, b, s)


def _leaves(a: np.ndarray, b: np.ndarray, s: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Points of a tree, given by falling ``s``, in an order in which each part that holds together at some value stands
    in one piece; the value that joins a place to the one before; and a point of the larger part at every join."""
    top, size, head, last, after, gap = list(range(m)), [1] * m, list(range(m)), list(range(m)), [-1] * m, [-2.0] * m
    x = 0
    for x, y, value in zip(a.tolist(), b.tolist(), s.tolist()):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        while top[y] != y:
            top[y] = top[top[y]]
            y = top[y]
        if size[x] < size[y]:
            x, y = y, x
        top[y] = x
        size[x] += size[y]
        after[last[x]], gap[head[y]], last[x] = head[y], value, last[y]
    order = [head[x]]
    while after[order[-1]] >= 0:
        order.append(after[order[-1]])
    return np.array(order), np.array(gap)[order], x


def _joined(gap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The values at which each of the ``places`` and every place are joined: the least gap between them."""
    p, q = places[:, None], np.arange(len(gap))
    after = np.minimum.accumulate(np.where(q > p, gap, 2.0), axis=1)
    before = np.minimum.accumulate(np.where(q < p, np.r_[gap[1:], 2.0], 2.0)[:, ::-1], axis=1)[:, ::-1]
    return np.minimum(after, before)


def small_trees(v: np.ndarray, angle: float, min_samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``record_tree`` of many trees of one size, ``v`` by tree, record and coordinate, from all of their pairs."""
    many, n, _ = v.shape
    floor, k, each, own = math.cos(angle), max(1, min(min_samples - 1, n - 1)), np.arange(many), np.arange(n)
    scale = 1 / np.maximum(np.linalg.norm(v, axis=2), 1e-12)
    s = v @ v.transpose(0, 2, 1)
    s *= scale[:, :, None] * scale[:, None, :]
    lowest = s.min((1, 2))
    s[:, own, own] = -2
    core = np.partition(s, n - k, axis=2)[:, :, n - k]
    s = np.maximum(np.minimum(s, np.minimum(core[:, :, None], core[:, None, :])), floor)
    best, source, left = s[:, 0].copy(), np.zeros((many, n), np.int64), np.ones((many, n), bool)
    a, b, reach = np.empty((many, n - 1), np.int64), np.empty((many, n - 1), np.int64), np.empty((many, n - 1))
    best[:, 0], left[:, 0] = -2, False
    for step in range(n - 1):
        at = best.argmax(1)
        a[:, step], b[:, step], reach[:, step] = source[each, at], at, best[each, at]
        best[each, at], left[each, at] = -2, False
        nearer = left & (s[each, at] > best)
        best = np.where(nearer, s[each, at], best)
        source = np.where(nearer, at[:, None], source)
    w = _lengths(reach, angle)
    order = np.argsort(w, axis=1, kind="stable")
    return (*(np.take_along_axis(x, order, 1) for x in (a, b, w)), lowest)


#: Stands for no cluster in arrays of ``part``.
NO_PART = -(2**63)


def fold(node, n, total, below, a, b, w, angle: float, least: int, close: bool):
    """Condenses trees given as nodes and edges, edges in rising order of ``w``, from the nearest edge up.

    A node is a record (``n`` 1, the rest 0), a bubble or a part of a tree folded before: ``n`` records; if these are
    ``least`` or more they are a cluster of which ``total`` is the sum of the densities (1 over the length) at which its
    records leave it, and ``below`` the best stability of the clusters under it. Where edges of one length join two or
    more such parts, the clusters end, with ``total`` less ``n`` times the density there as their stability, and one
    begins that all their records leave there; smaller parts fall out of the cluster they are joined to. A cluster is
    kept if it is as stable as the best choice below it, and chosen if none above it is kept.

    Gives, by node, ``part`` (smallest node of the chosen cluster, ``NO_PART`` in none), its ``stability``, ``leave``
    (density at which the node falls out; infinite for a cluster, nan if open) and the component; and, by component,
    its smallest node, ``n``, ``total`` and ``below``. With ``close`` the last clusters end at the density of ``angle``,
    else they stay open.
    """
    born = 1 / angle
    k = len(node)
    index = {x: i for i, x in enumerate(node.tolist())}
    level = np.maximum(born, 1 / np.maximum(w, 1e-3)).tolist()
    ends = [(index[x], index[y]) for x, y in zip(a.tolist(), b.tolist())]
    top, low, size, sums, under = list(range(k)), node.tolist(), n.tolist(), total.tolist(), below.tolist()
    loose = [[i] if size[i] < least else [] for i in range(k)]
    cluster = [i if size[i] >= least else -1 for i in range(k)]  # of a component; the first k clusters are the nodes' own
    home, leave = list(cluster), [math.inf if c >= 0 else math.nan for c in cluster]
    above, kept, name, stable = [-1] * k, [False] * k, [NO_PART] * k, [0.0] * k

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    def end(c: int, at: float) -> float:
        own = max(0.0, sums[c] - size[c] * at)
        kept[cluster[c]], name[cluster[c]], stable[cluster[c]] = own >= under[c] - 1e-9 * max(1.0, under[c]), low[c], own
        return max(own, under[c])

    def join(parts: list[int], at: float, root: int) -> None:
        big = [c for c in parts if cluster[c] >= 0]
        count = sum(size[c] for c in parts)
        first = min(low[c] for c in parts)
        if not big and count < least:
            loose[root] = [i for c in parts for i in loose[c]]
        else:
            if len(big) == 1:
                into, whole, best = cluster[big[0]], sums[big[0]], under[big[0]]
            else:
                into, whole, best = len(above), at * sum(size[c] for c in big), sum(end(c, at) for c in big)
                for c in big:
                    above[cluster[c]] = into
                above.append(-1), kept.append(False), name.append(NO_PART), stable.append(0.0)
            for c in parts:
                if cluster[c] < 0:
                    whole += at * size[c]
                    for i in loose[c]:
                        home[i], leave[i] = into, at
            loose[root], cluster[root], sums[root], under[root] = [], into, whole, best
        size[root], low[root] = count, first

    at = 0
    while at < len(ends):
        until = at + 1
        while until < len(ends) and level[until] == level[at]:
            until += 1
        met: dict[int, list[int]] = {}
        for x, y in ends[at:until]:
            p, q = find(x), find(y)
            if p != q:
                met[p] = met.get(p, [p]) + met.pop(q, [q])
                top[q] = p
        for root, parts in met.items():
            join(parts, level[at], root)
        at = until
    roots = [i for i in range(k) if top[i] == i]
    if close:
        for root in roots:
            if cluster[root] >= 0:
                end(root, born)
    chosen = [-1] * len(above)
    for c in range(len(above) - 1, -1, -1):
        outer = chosen[above[c]] if above[c] >= 0 else -1
        chosen[c] = outer if outer >= 0 else (c if kept[c] else -1)
    pick = [chosen[c] if c >= 0 else -1 for c in home]
    nodes = (np.array([name[c] if c >= 0 else NO_PART for c in pick], np.int64), np.array([stable[c] if c >= 0 else 0.0 for c in pick]), np.array(leave), np.array([low[find(i)] for i in range(k)], np.int64))
    return nodes, tuple(np.array([x[r] for r in roots], t) for x, t in ((low, np.int64), (size, np.int64), (sums, float), (under, float)))


FOLDED = "tree long, comp long, node long, part long, stability double, leave double, n long, total double, below double"


def _fold_groups(nodes: DataFrame, edges: DataFrame, angle: float, least: int, close: bool) -> DataFrame:
    """``fold`` for each ``tree, comp``: a row of each node and, if open, one of each component, its ``node`` null."""
    none = lambda t: F.lit(None).cast(t)
    rows = nodes.select("tree", "comp", F.col("node").alias("a"), none("long").alias("b"), none("double").alias("w"), "n", "total", "below")
    rows = rows.unionByName(edges.select("tree", "comp", "a", "b", "w", none("long").alias("n"), none("double").alias("total"), none("double").alias("below")))
    laid = rows.repartition("tree", "comp").sortWithinPartitions("tree", "comp", F.col("b").isNotNull(), "w", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _rows_by(batches, "tree", "comp"):
            for group in _groups(some, "tree", "comp"):
                m = group.num_rows - group["b"].null_count
                k = group.num_rows - m
                head, tail = group.slice(0, k), group.slice(k)
                own, (low, n, total, below) = fold(
                    head["a"].to_numpy(), head["n"].to_numpy(), head["total"].to_numpy(), head["below"].to_numpy(), tail["a"].to_numpy(), tail["b"].to_numpy(), tail["w"].to_numpy(), angle, least, close
                )
                part, stability, leave, comp = own
                lost = part == NO_PART
                tree = np.full(k, group["tree"][0].as_py())
                empty = lambda t, size: pa.nulls(size, t)
                names = ["tree", "comp", "node", "part", "stability", "leave", "n", "total", "below"]
                yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(comp), pa.array(head["a"].to_numpy()), pa.array(part, mask=lost), pa.array(stability, mask=lost), pa.array(leave), empty(pa.int64(), k), empty(pa.float64(), k), empty(pa.float64(), k)], names=names)
                if not close:
                    r = len(low)
                    yield pa.RecordBatch.from_arrays([pa.array(tree[:r]), pa.array(low), empty(pa.int64(), r), empty(pa.int64(), r), empty(pa.float64(), r), empty(pa.float64(), r), pa.array(n), pa.array(total), pa.array(below)], names=names)

    return laid.mapInArrow(run, FOLDED)


def condense_trees(nodes: DataFrame, edges: DataFrame, angle: float, least: int, limit: int = NODES) -> DataFrame:
    """``node, part, stability, leave`` by ``fold`` for nodes ``tree, node, n, total, below`` and edges ``tree, a, b, w``.

    A tree of more than ``limit`` nodes is folded in rounds: what its nearest edges hold together, cut at a quantile of
    their lengths that leaves no more than ``limit`` nodes together, is folded into one node each, then the smaller tree
    of these in the same way; at last the choices go down again, a cluster chosen above standing for those below.
    """
    edges = edges.select("tree", "a", "b", F.greatest(F.col("w"), F.lit(1e-3)).alias("w"))
    crowded = materialize(nodes.groupBy("tree").count().where(F.col("count") > limit).select("tree"))
    if crowded.isEmpty():
        zero = F.lit(0).cast("long")
        return _fold_groups(nodes.withColumn("comp", zero), edges.withColumn("comp", zero), angle, least, True).select("node", "part", "stability", "leave")
    big = small(crowded)
    whole = condense_trees(nodes.join(big, "tree", "left_anti"), edges.join(big, "tree", "left_anti"), angle, least, limit)
    own, links = nodes.join(big, "tree", "left_semi"), materialize(edges.join(big, "tree", "left_semi"))
    for share in (0.9, 0.5, 0.1, 0.01):
        cut = materialize(links.join(small(links.groupBy("tree").agg(F.percentile_approx("w", F.lit(share)).alias("t"))), "tree").withColumn("within", F.col("w") <= F.col("t")))
        comps = group_pairs(cut.where("within").withColumn("s", F.lit("")), "s", "a", "b").select(F.col("vertex").alias("node"), F.col("label").alias("comp"))
        if comps.groupBy("comp").count().agg(F.max("count")).first()[0] <= limit:
            break
    comps = small(comps)
    at = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
    placed = own.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    inner = cut.where("within").join(at("a"), "a").select("tree", F.col("a_comp").alias("comp"), "a", "b", "w")
    folded = materialize(_fold_groups(placed, inner, angle, least, False))
    outer = cut.where("not within").join(at("a"), "a", "left").join(at("b"), "b", "left").select("tree", F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b"), "w")
    upper = condense_trees(materialize(folded.where("node is null").select("tree", F.col("comp").alias("node"), "n", "total", "below")), materialize(outer), angle, least, limit)
    upper = upper.select(F.col("node").alias("comp"), F.col("part").alias("up"), F.col("stability").alias("up_stability"), F.col("leave").alias("up_leave"))
    down = folded.where("node is not null").select("comp", "node", "part", "stability", "leave").join(small(upper), "comp")
    down = down.select("node", F.coalesce("up", "part").alias("part"), F.when(F.col("up").isNotNull(), F.col("up_stability")).otherwise(F.col("stability")).alias("stability"), F.when(F.isnan("leave"), F.col("up_leave")).otherwise(F.col("leave")).alias("leave"))
    return materialize(whole.unionByName(down))
