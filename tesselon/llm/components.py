"""Consolidating pairwise matches into groups (problem 1).

Method: two-dimensional grid. Vertices are hashed into B blocks; an edge belongs to the partition of its two blocks, so
a vertex, hub or not, meets at most 2B - 1 of the B * B partitions. Each partition runs union-find on its own edges and
keeps a star: every vertex and its local representative, the smallest vertex it reaches. Then the representatives that
a vertex got along its row and its column are exchanged: the smallest becomes its parent, the others are linked to it
and form the next, smaller graph. The rounds end when no vertex has two representatives, i.e. the parents are stable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselon.session import materialize, small

#: Edges that one partition of the grid is meant to hold.
BLOCK_EDGES = 500_000


def group_pairs(pairs: DataFrame, scope: str, u: str, v: str, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """``scope, vertex, label``: each vertex of ``pairs`` with the smallest vertex of its group.

    ``u`` and ``v`` are longs of one numbering within ``scope`` (a string); equal numbers in two scopes are different
    vertices. Rows with a null in any of the three link nothing and are left out; a vertex paired with itself is a
    group of one; repeated pairs change nothing; an empty table gives no rows. Other columns play no part.
    """
    edges = pairs.select(F.col(f"`{scope}`").cast("string").alias("scope"), F.col(f"`{u}`").cast("long").alias("u"), F.col(f"`{v}`").cast("long").alias("v")).na.drop()
    n = edges.count()
    steps: list[DataFrame] = []
    while n or not steps:
        blocks = max(1, int(np.ceil(np.sqrt(n / block_edges))))
        if not steps and n > 10_000:
            blocks = max(blocks, 3)
        at = lambda c: F.pmod(F.xxhash64("scope", c), F.lit(blocks)).cast("int")  # noqa: E731, B023
        grid = edges.repartitionById(blocks * blocks, at("u") * blocks + at("v"))
        stars = grid.mapInArrow(_stars, "scope string, vertex long, rep long")
        reps = stars.groupBy("scope", "vertex").agg(F.collect_set("rep").alias("reps"))  # at most 2 * blocks - 1 each
        step = materialize(reps.select("scope", "vertex", F.array_min("reps").alias("parent"), F.array_remove("reps", F.array_min("reps")).alias("others")))
        steps.append(step)
        edges = materialize(step.where(F.size("others") > 0).select("scope", F.col("parent").alias("u"), F.explode("others").alias("v")).distinct())
        n = edges.count()
    labels = steps[-1].select("scope", "vertex", F.col("parent").alias("label"))
    for step in reversed(steps[:-1]):
        later = small(labels.select("scope", F.col("vertex").alias("parent"), "label"))
        labels = materialize(step.select("scope", "vertex", "parent").join(later, ["scope", "parent"], "left").select("scope", "vertex", F.coalesce("label", "parent").alias("label")))
    return labels


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's vertices with their representatives. Edges are taken in chunks; a chunk is reduced together
    with the forest so far, so memory follows the vertices and not the edges."""
    forest: pa.Table | None = None
    waiting: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(pa.Table.from_batches([batch]).rename_columns(["scope", "u", "v"]))
            rows += batch.num_rows
        if rows >= 400_000:
            forest, waiting, rows = _union(waiting, forest), [], 0
    if waiting:
        forest = _union(waiting, forest)
    if forest is not None:
        yield from forest.rename_columns(["scope", "vertex", "rep"]).combine_chunks().to_batches(max_chunksize=100_000)


def _union(parts: list[pa.Table], forest: pa.Table | None) -> pa.Table:
    edges = pa.concat_tables(([forest] if forest is not None else []) + parts).combine_chunks()
    coded = edges["scope"].combine_chunks().dictionary_encode()
    scope = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    u, v = edges["u"].to_numpy(), edges["v"].to_numpy()
    n = len(u)
    s, x = np.concatenate([scope, scope]), np.concatenate([u, v])
    order = np.lexsort((x, s))
    new = np.ones(2 * n, bool)
    new[1:] = (s[order][1:] != s[order][:-1]) | (x[order][1:] != x[order][:-1])
    index = np.empty(2 * n, np.int64)
    index[order] = np.cumsum(new) - 1
    first = order[new]
    parent = union(index[:n], index[n:], len(first))
    return pa.table({"scope": coded.dictionary.take(pa.array(s[first])), "u": pa.array(x[first]), "v": pa.array(x[first][parent])})


def union(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Union-find over edges a-b of vertices 0..n-1: for each vertex the smallest of its set.

    Roots are hooked under smaller ones, all edges at a time, and paths are halved until flat.
    """
    parent = np.arange(n)
    while len(a):
        p, q = parent[a], parent[b]
        apart = p != q
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent
