"""Encoding of the whole corpus with a public byte-level BPE tokenizer (problem 7).

Method: hierarchical-bitmap rank queue. The bytes of a pre-token form a linked list. Each adjacent pair that can be
merged lies in the bucket of its merge rank; a three-level bitmap marks the filled buckets, so find-first-set gives the
lowest rank in three steps, whatever the pre-token's length. Positions whose pair has changed since are stale and
skipped. Long unbroken runs thus cost n log n and not n squared; frequent short pre-tokens come from a bounded cache.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabularies lie on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

#: Fixed value: how byte-level BPE splits text into pre-tokens.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

CACHED, CACHED_CHARS = 200_000, 64


class RankQueue:
    """Positions by merge rank; ``pop`` gives the leftmost position of the lowest rank, or None."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.leaf: dict[int, int] = {}
        self.middle: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word, part = rank >> 6, rank >> 12
            self.leaf[word] = self.leaf.get(word, 0) | 1 << (rank & 63)
            self.middle[part] = self.middle.get(part, 0) | 1 << (word & 63)
            self.top |= 1 << part
        else:
            heappush(bucket, position)

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        part = (self.top & -self.top).bit_length() - 1
        bits = self.middle[part]
        word = part << 6 | (bits & -bits).bit_length() - 1
        bits = self.leaf[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.leaf[word] &= ~(1 << (rank & 63))
            if not self.leaf[word]:
                self.middle[part] &= ~(1 << (word & 63))
                if not self.middle[part]:
                    self.top &= ~(1 << part)
        return rank, position


class Encoder:
    """``encode`` turns a text into the ids of one vocabulary file, special tokens being ordinary text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        self.single = [vocab[c] for c in byte_letters()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.cache: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache = self.cache
        for part in SPLIT.findall(text):
            ids = cache.get(part)
            if ids is None:
                ids = self.merge(part.encode("utf-8", "replace"))
                if len(part) <= CACHED_CHARS:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[part] = ids
            out += ids
        return out

    def merge(self, raw: bytes) -> list[int]:
        ids = [self.single[b] for b in raw]
        n = len(ids)
        if n < 2:
            return ids
        merges, queue = self.merges, RankQueue()
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.push(found[0], i)
        while (item := queue.pop()) is not None:
            rank, i = item
            if ids[i] < 0 or (j := after[i]) >= n:
                continue
            found = merges.get((ids[i], ids[j]))
            if found is None or found[0] != rank:  # stale: a neighbour has merged since
                continue
            ids[i], ids[j] = found[1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((ids[i], ids[k])):
                    queue.push(found[0], i)
            if (h := before[i]) >= 0 and (found := merges.get((ids[h], ids[i]))):
                queue.push(found[0], h)
        return [t for t in ids if t >= 0]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 ones for themselves, the others the
    code points from 256 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [], 256
    for b in range(256):
        if b in plain:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


@lru_cache(maxsize=4)
def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder for a worker process and file."""
    return Encoder(path)


def encode_documents(documents: DataFrame, record_id: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``record_id, ids``: one row for each row of ``documents``, in one pass without a shuffle.

    Null and empty texts give an empty list; blanks are text. Repeated rows come repeatedly, a null id is kept. Whole
    texts are encoded, whatever their length.
    """
    rows = documents.select(F.col(f"`{record_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(_mapper(path, lengths=False), "id long, ids array<int>").withColumnRenamed("id", record_id)


def count_tokens(documents: DataFrame, record_id: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``record_id, n_tokens`` as ``encode_documents`` would give; 0 for null and empty texts."""
    rows = documents.select(F.col(f"`{record_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(_mapper(path, lengths=True), "id long, n_tokens int").withColumnRenamed("id", record_id)


def _mapper(path: str, lengths: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for big in batches:
            for start in range(0, big.num_rows, 2_000):
                batch = big.slice(start, 2_000)
                ids = [encode(t) if t else [] for t in batch.column("text").to_pylist()]
                sizes = np.fromiter((len(x) for x in ids), np.int32, len(ids))
                if lengths:
                    yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes)], names=["id", "n_tokens"])
                else:
                    flat = np.fromiter((t for x in ids for t in x), np.int32, int(sizes.sum()))
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "ids"])

    return run
