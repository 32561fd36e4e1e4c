"""Spark data sources for grey TIFF and BigTIFF files in strips or tiles, plain, LZW or deflate.

    spark.dataSource.register(TiffPixels)
    spark.read.format("tiff_pixels").option("above", 10).option("x0", 0).option("x1", 512).load("hdfs://host/data/*.tif")

Files are opened where the tasks run, by their path or URI, with random access: a task reads its own blocks only, at most
``TASK_BYTES`` of pixels unless one compressed block has more. Plain strips are cut into ranges of lines.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tesselon.sources.files import matching, open_file

PIXELS = "path string, channel int, x int, y int, value double"
PAGES = "path string, channel int, width int, height int, bits int, compression int, n_blocks int, tiled boolean, big boolean, description string"
TASK_BYTES = 16 << 20
#: TIFF tags, the forms of its field types, its compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, DESCRIPTION, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR = 256, 257, 258, 259, 270, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
FIELD = {1: "B", 2: "s", 3: "H", 4: "I", 16: "Q"}
PLAIN, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946


class Block(NamedTuple):
    """Lines ``y`` to ``y + rows`` and columns ``x`` to ``x + columns`` of a page, stored ``stored`` columns wide."""

    x: int
    y: int
    rows: int
    columns: int
    stored: int
    offset: int
    size: int


class Page(NamedTuple):
    channel: int
    width: int
    height: int
    dtype: str
    bits: int
    compression: int
    predictor: int
    samples: int
    tiled: bool
    big: bool
    description: str | None
    blocks: list[Block]


class _Part(InputPartition):
    def __init__(self, path: str, page: Page | None, blocks: list[Block]) -> None:
        self.path, self.page, self.blocks = path, page, blocks


class _Source(DataSource):
    def reader(self, schema) -> DataSourceReader:
        return self.READER(self.options)


class _PagesReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = [p for p, _ in matching(options["path"])]

    def partitions(self) -> list[_Part]:
        return [_Part(p, None, []) for p in self.paths] or [_Part("", None, [])]

    def read(self, part: _Part) -> Iterator[tuple]:
        for p in pages(part.path) if part.path else ():
            yield part.path, p.channel, p.width, p.height, p.bits, p.compression, len(p.blocks), p.tiled, p.big, p.description


class TiffPages(_Source):
    """One row for each page, from the headers alone; ``channel`` is the page's number."""

    READER = _PagesReader

    @classmethod
    def name(cls) -> str:
        return "tiff_pages"

    def schema(self) -> str:
        return PAGES


class _PixelsReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = [p for p, _ in matching(options["path"])]
        self.above = float(options.get("above", "0"))
        self.only = options.get("channel")
        self.window = tuple(int(options.get(k, d)) for k, d in (("x0", 0), ("y0", 0), ("x1", 1 << 40), ("y1", 1 << 40)))

    def partitions(self) -> list[_Part]:
        x0, y0, x1, y1 = self.window
        out: list[_Part] = []
        for path in self.paths:
            for page in pages(path):
                if self.only is not None and page.channel != int(self.only):
                    continue
                if page.compression not in (PLAIN, LZW, DEFLATE, OLD_DEFLATE) or page.samples != 1 or page.predictor not in (1, 2):
                    raise ValueError(f"{path}: pages of one sample, plain, LZW or deflate, can be read")
                lean = page._replace(blocks=[], description=None)
                held, room = [], 0
                for b in (c for block in page.blocks for c in _cut(block, page, y0, y1)):
                    if b.x >= x1 or b.x + b.columns <= x0 or b.y >= y1 or b.y + b.rows <= y0:
                        continue
                    size = b.rows * b.stored * page.bits // 8
                    if held and room + size > TASK_BYTES:
                        out.append(_Part(path, lean, held))
                        held, room = [], 0
                    held.append(b)
                    room += size
                if held:
                    out.append(_Part(path, lean, held))
        return out or [_Part("", None, [])]

    def read(self, part: _Part) -> Iterator[pa.RecordBatch]:
        if not part.blocks:
            return
        x0, y0, x1, y1 = self.window
        with open_file(part.path) as file:
            for b in part.blocks:
                file.seek(b.offset)
                data = _decode(file.read(b.size), part.page, b)[max(y0 - b.y, 0) : y1 - b.y, max(x0 - b.x, 0) : x1 - b.x]
                y, x = np.nonzero(data > self.above)
                n = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.path] * n, pa.string()),
                        pa.array(np.full(n, part.page.channel, np.int32)),
                        pa.array((x + max(b.x, x0)).astype(np.int32)),
                        pa.array((y + max(b.y, y0)).astype(np.int32)),
                        pa.array(data[y, x].astype(np.float64)),
                    ],
                    names=["path", "channel", "x", "y", "value"],
                )


class TiffPixels(_Source):
    """Pixels strictly above ``above`` (default 0). ``channel`` reads one page only; ``x0, y0, x1, y1`` (upper ends not
    included) only the blocks that meet the window. No file, or no pixel above, gives no rows."""

    READER = _PixelsReader

    @classmethod
    def name(cls) -> str:
        return "tiff_pixels"

    def schema(self) -> str:
        return PIXELS


def pages(path: str) -> list[Page]:
    """The pages of a file with their blocks, from the headers alone."""
    out: list[Page] = []
    with open_file(path) as file:
        head = file.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        magic = struct.unpack(order + "H", head[2:4])[0] if order and len(head) >= 8 else 0
        if magic not in (42, 43):
            raise ValueError(f"{path} is no TIFF")
        big = magic == 43
        count, entry, link, room = ("Q", "HHQ8s", "Q", 8) if big else ("H", "HHI4s", "I", 4)

        def take(form: str) -> tuple:
            return struct.unpack(order + form, file.read(struct.calcsize(order + form)))

        at = struct.unpack(order + link, head[8:16] if big else head[4:8])[0]
        while at:
            file.seek(at)
            entries = [take(entry) for _ in range(take(count)[0])]
            at = take(link)[0]
            tags: dict[int, tuple] = {}
            for tag, kind, n, raw in entries:
                if kind in FIELD:
                    form = f"{order}{n}{FIELD[kind]}"
                    size = struct.calcsize(form)
                    if size > room:
                        file.seek(struct.unpack(order + link, raw)[0])
                        raw = file.read(size)
                    tags[tag] = struct.unpack(form, raw[:size])
            out.append(_page(len(out), tags, order, big))
    return out


def _page(channel: int, tags: dict[int, tuple], order: str, big: bool) -> Page:
    one = lambda tag, other: tags.get(tag, (other,))[0]
    width, height, bits, tiled = tags[WIDTH][0], tags[HEIGHT][0], one(BITS, 1), TILE_OFFSETS in tags
    kind = {1: "u", 2: "i", 3: "f"}.get(one(FORMAT, 1))
    if kind is None or bits not in (8, 16, 32, 64):
        raise ValueError(f"pixels of {bits} bits and format {one(FORMAT, 1)} can't be read")
    blocks: list[Block] = []
    if tiled:
        w, h = tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]
        across = -(-width // w)
        for k, (offset, size) in enumerate(zip(tags[TILE_OFFSETS], tags[TILE_COUNTS])):
            x, y = k % across * w, k // across * h
            if size:
                blocks.append(Block(x, y, min(h, height - y), min(w, width - x), w, offset, size))
    else:
        rows = min(one(ROWS, height), height)
        for k, offset in enumerate(tags[OFFSETS]):
            lines = min(rows, height - k * rows)
            blocks.append(Block(0, k * rows, lines, width, width, offset, tags[COUNTS][k] if COUNTS in tags else lines * width * bits // 8))
    text = tags[DESCRIPTION][0].rstrip(b"\0").decode("utf-8", "replace") if DESCRIPTION in tags else None
    return Page(channel, width, height, f"{order}{kind}{bits // 8}", bits, one(COMPRESSION, PLAIN), one(PREDICTOR, 1), one(SAMPLES, 1), tiled, big, text, blocks)


def _cut(block: Block, page: Page, y0: int, y1: int) -> Iterator[Block]:
    """A plain block as ranges of lines within the window that fit a task; others whole."""
    if page.compression != PLAIN:
        yield block
        return
    line = block.stored * page.bits // 8
    step = max(TASK_BYTES // line, 1)
    for y in range(max(block.y, y0), min(block.y + block.rows, y1), step):
        rows = min(step, block.y + block.rows - y, y1 - y)
        yield block._replace(y=y, rows=rows, offset=block.offset + (y - block.y) * line, size=rows * line)


def _decode(raw: bytes, page: Page, b: Block) -> np.ndarray:
    if page.compression == LZW:
        raw = unpack_lzw(raw)
    elif page.compression != PLAIN:
        raw = zlib.decompress(raw)
    data = np.frombuffer(raw, page.dtype, b.rows * b.stored).reshape(b.rows, b.stored)
    if page.predictor == 2:
        data = np.cumsum(data, axis=1, dtype=data.dtype)
    return data[:, : b.columns]


def unpack_lzw(raw: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits from the highest bit, 256 clears the table, 257 ends."""
    single = [bytes([k]) for k in range(256)] + [b"", b""]
    table, width, last = list(single), 9, b""
    out, held, bits = bytearray(), 0, 0
    for byte in raw:
        held = (held << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(single), 9, b""
            continue
        now = table[code] if code < len(table) else last + last[:1]
        if last:
            table.append(last + now[:1])
        out += now
        last = now
        # the width grows one code early
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)
