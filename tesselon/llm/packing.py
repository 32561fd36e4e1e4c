"""Filling fixed-capacity containers with items (problem 8).

Method: variable-capacity best-fit. Several capacities are permitted. Items are taken from the largest down; one goes
into the open bin whose free space it fills best. If none has room, that bin size is opened which a look-ahead over the
items still to come fills at the least cost (unused space and a fixed cost for each bin, by the capacity). In the end
every bin shrinks to the smallest capacity that holds its contents. Items are packed in shards of bounded size; what
lies in poorly filled bins is taken out and packed once more, together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselon.session import materialize

CAPACITIES = (512, 1024, 2048, 4096)
#: Items of one shard, fill below which a bin is repacked, cost of a bin in units of space.
SHARD_ITEMS, POOR, BIN_COST = 50_000, 0.97, 8

PACKED = "id long, piece int, size int, container_id long, capacity int"


def pieces(items: DataFrame, record_id: str, size: str, capacity: int) -> DataFrame:
    """``id, piece, size``: an item itself, or, if larger than ``capacity``, full pieces and the rest."""
    n = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    rows = items.select(F.col(f"`{record_id}`").cast("long").alias("id"), F.greatest(F.lit(0), F.coalesce(F.col(f"`{size}`").cast("int"), F.lit(0))).alias("size"))
    cut = rows.withColumn("n", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return cut.select("id", "piece", F.when(F.col("piece") < F.col("n") - 1, F.lit(capacity)).otherwise(F.col("size") - (F.col("n") - 1) * capacity).cast("int").alias("size"))


def pack(items: DataFrame, record_id: str, size: str, capacities: Sequence[int] = CAPACITIES, shard_items: int = SHARD_ITEMS, poor: float = POOR) -> DataFrame:
    """``id, piece, size, container_id, capacity``: every item whole in one container, larger ones in pieces.

    A null or negative size counts as 0; items of size 0 lie in some container. Rows repeated with an id are items of
    their own. An empty table gives no rows. The number of shards follows the number of items, so no task or group
    holds more than about ``shard_items`` of them.
    """
    sizes = sorted(set(int(c) for c in capacities))
    todo = materialize(pieces(items, record_id, size, sizes[-1]))
    done: list[DataFrame] = []
    rounds = 3
    for round_no in range(rounds):
        n = todo.count()
        if n == 0 and round_no:
            break
        shards = max(1, -(-n // shard_items))
        spread = F.pmod(F.xxhash64("id", "piece", F.lit(round_no)), F.lit(shards)).cast("int")
        packed = todo.withColumn("shard", spread).groupBy("shard").applyInPandas(_packer(sizes, round_no), PACKED)
        if shards == 1 or round_no == rounds - 1:
            done.append(packed)
            break
        packed = materialize(packed)
        # contents of a bin lie in one shard, so their fill can be told by one aggregate
        fill = packed.groupBy("container_id").agg((F.sum("size") / F.first("capacity")).alias("fill")).where(F.col("fill") < poor).select("container_id")
        fill = materialize(fill)
        done.append(packed.join(fill, "container_id", "left_anti").select("id", "piece", "size", "container_id", "capacity"))
        todo = materialize(packed.join(fill, "container_id", "left_semi").select("id", "piece", "size"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _packer(sizes: list[int], round_no: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "id", "piece"], ascending=[False, True, True], kind="stable")
        bins, capacity = best_fit(frame["size"].to_numpy(), sizes)
        base = (round_no << 58) | (int(key[0]) << 24)
        return pd.DataFrame({"id": frame["id"].to_numpy(), "piece": frame["piece"].to_numpy(), "size": frame["size"].to_numpy(), "container_id": base + bins.astype(np.int64), "capacity": capacity[bins].astype(np.int32)})

    return run


def best_fit(items: np.ndarray, capacities: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For items in falling order of size: the bin of each and the final capacity of each bin."""
    largest = capacities[-1]
    left = np.bincount(items, minlength=largest + 1).tolist()  # items still to come, by size
    sizes_left = sum(1 << s for s, n in enumerate(left) if n)
    open_bins: list[list[int]] = [[] for _ in range(largest + 1)]  # by free space
    free_mask = 0
    where = np.empty(len(items), np.int64)
    used: list[int] = []
    for i, size in enumerate(items.tolist()):
        left[size] -= 1
        if not left[size]:
            sizes_left &= ~(1 << size)
        fits = free_mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = open_bins[free].pop()
            if not open_bins[free]:
                free_mask &= ~(1 << free)
        else:
            b = len(used)
            used.append(0)
            free = _cheapest(size, capacities, left, sizes_left)
        used[b] += size
        where[i] = b
        free -= size
        if not open_bins[free]:
            free_mask |= 1 << free
        open_bins[free].append(b)
    steps = np.array(capacities)
    return where, steps[np.searchsorted(steps, np.array(used, np.int64))]


def _cheapest(size: int, capacities: list[int], left: list[int], sizes_left: int) -> int:
    """The capacity that the items still to come fill at the least cost for its space: largest that fit go first."""
    best, cost = capacities[-1], float("inf")
    for capacity in capacities:
        if capacity < size:
            continue
        room, taken = capacity - size, {}
        mask = sizes_left
        while room and (within := mask & ((1 << (room + 1)) - 1)) and (s := within.bit_length() - 1):
            count = min(left[s] - taken.get(s, 0), room // s)
            if count <= 0:
                mask &= ~(1 << s)
                continue
            taken[s] = taken.get(s, 0) + count
            room -= s * count
            if taken[s] >= left[s]:
                mask &= ~(1 << s)
        now = (room + BIN_COST) / capacity
        if now <= cost:
            best, cost = capacity, now
    return best
