"""A Spark data source for the features of GeoJSON files of any size, cut into ranges of bytes.

    spark.dataSource.register(GeojsonFeatures)
    spark.read.format("geojson_features").load("/data/cells.geojson")

A range gives the features that begin in it. Features are told by ``{"type": "Feature"`` at their start, as writers of
the format put it, in one collection or one after another. Every feature's successor is looked at, so that a file
written otherwise is an error and never loses rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tesselon.sources.files import matching, open_file

RANGE_BYTES = 32 << 20
CHUNK = 1 << 20
START = re.compile(rb'\{\s*"type"\s*:\s*"Feature"\s*[,}]')
OPENING = re.compile(rb'"features"\s*:\s*\[\s*')
TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|["{}]', re.DOTALL)
NEXT = re.compile(rb"\s*,?\s*")
#: More blanks than this within the start of a feature or between two aren't expected.
MARGIN = 4096


class _Range(InputPartition):
    def __init__(self, path: str, part: int, begin: int, end: int) -> None:
        self.path, self.part, self.begin, self.end = path, part, begin, end


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.size = int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self) -> list[_Range]:
        return [_Range(p, k, at, min(at + self.size, n)) for p, n in matching(self.path) for k, at in enumerate(range(0, n, self.size))] or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[tuple]:
        if part.path:
            with open_file(part.path) as file:
                for place, feature in enumerate(features(file, part.begin, part.end, part.path)):
                    yield part.path, part.part, place, feature.decode("utf-8", "replace")


class GeojsonFeatures(DataSource):
    """``path, part, place, feature``: the text of each feature, its range and its place within that."""

    @classmethod
    def name(cls) -> str:
        return "geojson_features"

    def schema(self) -> str:
        return "path string, part int, place long, feature string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def features(file: Any, begin: int, end: int, name: str = "") -> Iterator[bytes]:
    """The features that start from ``begin`` to before ``end``."""
    file.seek(begin)
    held, offset, at, over = b"", begin, 0, False  # ``held`` lies at ``offset`` of the file

    def more() -> None:
        nonlocal held, over
        chunk = file.read(CHUNK)
        over = not chunk
        held += chunk

    def checked(here: int) -> None:
        """An object at ``here`` has to be a feature."""
        if held[here : here + 1] == b"{" and not START.match(held, here):
            raise ValueError(f"{name}: the object at byte {offset + here} doesn't start as a feature; read the file whole")

    more()
    if begin == 0:
        while len(held) < MARGIN and not over:
            more()
        opening = OPENING.search(held)
        first = opening.end() if opening else NEXT.match(held).end()
        if opening or held[first:]:
            checked(first)
    while True:
        found = START.search(held, at)
        if found is None:
            if over or offset + len(held) - MARGIN >= end:
                return
            at = max(at, len(held) - MARGIN)
            held, offset, at = held[at:], offset + at, 0
            more()
            continue
        first = found.start()
        if offset + first >= end:
            return
        depth, look = 0, first
        while True:
            stop = None
            for token in TOKEN.finditer(held, look):
                sign = token.group()
                if sign == b'"':  # a text that goes on beyond what is held
                    break
                depth += (sign == b"{") - (sign == b"}")
                look = token.end()
                if depth == 0:
                    stop = look
                    break
            if stop is not None:
                break
            if over:
                raise ValueError(f"{name}: the feature at byte {offset + first} doesn't end")
            held, offset = held[first:], offset + first
            first, look, depth = 0, 0, 0
            more()
        while len(held) - stop < MARGIN and not over:
            more()
        yield held[first:stop]
        checked(NEXT.match(held, stop).end())
        at = stop
