import hashlib
import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselon.operators import audit as A
from tesselon.sources import geojson, layouts
from tesselon.sources import tiff as tiff_source
from tesselon.sources.tiff import TiffPages, TiffPixels
from tesselon.streaming.ingest import ingest_available


@pytest.mark.parametrize(
    ("flags", "want"),
    [("c", "DONE"), ("qmr", "READY_FULL"), ("qma", "READY_FULL"), ("qmet", "READY_CELLBIN"), ("qm", "READY_NO_IMAGE"), ("et", "CELLBIN_ONLY"), ("e", "NEED_IMAGES"), ("q", "NEED_DATA"), ("", "NEED_DATA")],
)
def test_readiness(spark, flags, want):
    cols = [F.lit(True) if f in flags else F.lit(None).cast("boolean") for f in "cqmraet"]
    assert spark.range(1).select(A.readiness(*cols)).first()[0] == want


def test_fingerprint(spark, tmp_path):
    small, big = b"abc", bytes(range(256)) * 10_000
    (tmp_path / "a.bin").write_bytes(small)
    (tmp_path / "b.ome.tif").write_bytes(big)
    got = {r.name: (r.stem, r["size"], r.hash) for r in A.file_listing(spark, str(tmp_path), hashed=True).collect()}
    mib = 1024 * 1024
    ends = hashlib.sha256(big[:mib] + big[-mib:] + str(len(big)).encode()).hexdigest()[:16]
    assert got == {"a.bin": ("a", 3, hashlib.sha256(small).hexdigest()[:16]), "b.ome.tif": ("b", len(big), ends)}
    assert spark.createDataFrame([(None,)], "c binary").select(A.fingerprint(F.col("c"))).first()[0] == "MISSING"


def test_gate(spark):
    status = spark.createDataFrame([("ok", "approved"), ("edited", "approved"), ("gone", "approved"), ("open", None), ("none", "approved")], "sample_id string, status string")
    manifest = spark.createDataFrame([("ok", "r", "p1", "h1"), ("edited", "r", "p2", "h2"), ("gone", "r", "p3", "h3"), ("open", "r", "p1", "h1")], "sample_id string, role string, path string, hash string")
    now = spark.createDataFrame([("p1", "h1"), ("p2", "other")], "path string, hash string")
    got = {r.sample_id: r.decision for r in A.approval(status, A.verify_manifest(manifest, now)).collect()}
    assert got == {"ok": "approved", "edited": "files_changed", "gone": "files_changed", "open": "not_approved", "none": "no_manifest"}


def test_manifest_and_metadata(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "meta_2.csv").write_text("id,note\n9,late\n")
    (tmp_path / "meta_1.csv").write_text('id,note\n1,"two\nlines, ""quoted"""\n2,\n')
    here = f"file:{tmp_path}/a.bin"
    files = spark.createDataFrame([("s", "mask", here), ("s", "mask", here), ("s", "image", "file:/none"), ("t", "mask", None)], "sample_id string, role string, path string")
    got = {(r.sample_id, r.role): (r.present, r.hash, r["size"]) for r in A.build_manifest(files, A.file_listing(spark, str(tmp_path), "*.bin", hashed=True)).collect()}
    assert got == {("s", "mask"): (True, hashlib.sha256(b"abc").hexdigest()[:16], 3), ("s", "image"): (False, "MISSING", None), ("t", "mask"): (False, "MISSING", None)}
    assert [tuple(r) for r in layouts.read_metadata(spark, f"{tmp_path}/meta_*.csv").collect()] == [("1", 'two\nlines, "quoted"'), ("2", None)]
    with pytest.raises(ValueError):
        layouts.read_metadata(spark, f"{tmp_path}/no*.csv")


def test_channels_written(spark, tmp_path):
    long = spark.createDataFrame([("s/1", c, x, 0, float(x)) for c in ("a b", "c") for x in range(3)], "sample_id string, channel string, x int, y int, value double")
    layouts.write_channels(long, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.sample_id, r.channel, r.x) for r in back.collect()} == {("s_1", c, x) for c in ("a_b", "c") for x in range(3)}


def test_names(spark):
    df = spark.createDataFrame([("AB12_chip_3",), ("x",), (None,)], "s string")
    s, c = A.sample_and_chip(F.col("s"))
    rows = df.select(A.numeric_part(F.col("s")).alias("n"), A.safe_name(F.concat("s", F.lit("/é ?"))).alias("f"), s.alias("a"), c.alias("b")).collect()
    assert [tuple(r) for r in rows] == [(12, "AB12_chip_3_é__", "AB12", "chip_3"), (0, "x_é__", "x", None), (0, None, None, None)]


def test_layouts(spark, tmp_path):
    long = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "x int, y int, intensity double")
    long.write.parquet(str(tmp_path / "s1" / "DAPI.parquet"))
    long.where("y = 1").withColumnRenamed("intensity", "CD3").write.parquet(str(tmp_path / "s1" / "CD3.parquet"))
    spark.createDataFrame([(0, 0, 1.0, None)], "x int, y int, a double, b double").write.parquet(str(tmp_path / "s2.parquet"))
    assert [layouts.detect_layout(spark, str(tmp_path), s) for s in ("s1", "s2", "s3")] == ["channels", "single", "unknown"]
    assert sorted(tuple(r) for r in layouts.read_pixels(spark, str(tmp_path), "s1").select("x", "y", "CD3", "DAPI").collect()) == [(0, 0, 0.0, 1.0), (0, 1, 2.0, 2.0)]
    assert [tuple(r) for r in layouts.read_pixels(spark, str(tmp_path), "s2").collect()] == [(0, 0, 1.0, 0.0)]
    with pytest.raises(ValueError, match="no pixel table"):
        layouts.read_pixels(spark, str(tmp_path), "s3")


def test_geojson_and_transforms(spark, tmp_path):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    features = [
        {"type": "Feature", "id": "a", "geometry": {"type": "Polygon", "coordinates": [square]}, "properties": {"label": 7}},
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square]]}, "properties": {"object_index": 3, "classification": {"name": "Cell"}}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {}},
    ]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = sorted((r.feature_id, r.label, r["class"], len(r.rings)) for r in layouts.read_geojson(spark, str(tmp_path / "g.json")).collect())
    assert got == [("1", 4, "Cell", 1), ("1", 4, "Cell", 1), ("a", 7, None, 1)]
    assert got == sorted((r.feature_id, r.label, r["class"], len(r.rings)) for r in layouts.read_geojson(spark, str(tmp_path / "g.json"), whole=True).collect())
    layouts.write_geojson(layouts.read_geojson(spark, str(tmp_path / "g.json")), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == layouts.read_geojson(spark, str(tmp_path / "out")).count() == 3
    body = {"_note": "x", "S1": {"reference": "r", "transforms": {"_c": {}, "he": {"matrix": [[2, 0, 0], [0, 2, 0]]}, "msi": {"matrix": [[1, 0, 5], [0, 1, 6]], "invert": False}, "bad": {"matrix": [[1, 0]]}}}}
    (tmp_path / "t.json").write_text(json.dumps(body))
    got = {r.modality: r.effective for r in layouts.read_transforms(spark, str(tmp_path / "t.json")).collect()}
    assert got["he"][0][0] == 0.5 and got["msi"] == [[1.0, 0.0, 5.0], [0.0, 1.0, 6.0]] and got["bad"] is None


@pytest.mark.parametrize("indent", [None, 2])
def test_geojson_in_ranges(spark, tmp_path, indent, monkeypatch):
    rng = np.random.default_rng(4)
    odd = 'a "quoted\\" {brace} é }'
    feature = lambda k: {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [rng.integers(0, 99, (int(rng.integers(3, 40)), 2)).tolist()]}, "properties": {"classification": {"name": f"{odd} {k}"}}}
    made = [feature(k) for k in range(60)]
    text = json.dumps({"type": "FeatureCollection", "features": made}, indent=indent)
    (tmp_path / "g.json").write_text(text)
    monkeypatch.setattr(geojson, "CHUNK", 700)
    monkeypatch.setattr(geojson, "MARGIN", 64)
    for size in (333, 5_000, 10**9):
        texts = []
        for at in range(0, len(text), size):
            with open(tmp_path / "g.json", "rb") as file:
                texts += list(geojson.features(file, at, min(at + size, len(text))))
        assert [json.loads(t) for t in texts] == made
    got = sorted((r.label, r["class"], r.rings) for r in layouts.read_geojson(spark, str(tmp_path / "g.json"), range_bytes=900).collect())
    assert got == [(k + 1, f"{odd} {k}", [[[float(x), float(y)] for x, y in f["geometry"]["coordinates"][0]]]) for k, f in enumerate(made)]


def test_geojson_written_otherwise(tmp_path):
    turned = {"features": [{"properties": {}, "type": "Feature"}], "type": "FeatureCollection"}
    mixed = {"type": "FeatureCollection", "features": [{"type": "Feature", "id": 1}, {"id": 2, "type": "Feature"}]}
    for body in (json.dumps(turned), json.dumps(mixed), '{"type": "Polygon"}', '{"type": "Feature", "id": "no end'):
        (tmp_path / "g.json").write_text(body)
        with open(tmp_path / "g.json", "rb") as file, pytest.raises(ValueError):
            list(geojson.features(file, 0, len(body)))
    for body in ("", " ", json.dumps({"type": "FeatureCollection", "features": []})):
        (tmp_path / "g.json").write_text(body)
        with open(tmp_path / "g.json", "rb") as file:
            assert list(geojson.features(file, 0, len(body))) == []


def test_bundle(spark, tmp_path):
    obs, var, x = spark.range(3), spark.range(2), spark.range(6)
    layouts.write_bundle(str(tmp_path / "b"), obs, var, x)
    assert [d.count() for d in layouts.read_bundle(spark, str(tmp_path / "b"))] == [3, 2, 6]


def tiff(pages, rows_per_strip=2):
    out, offsets = bytearray(b"II*\0\0\0\0\0"), []
    for page in pages:
        page = page.astype("<u2")
        starts = []
        for y in range(0, page.shape[0], rows_per_strip):
            starts.append(len(out))
            out += page[y : y + rows_per_strip].tobytes()
        table = len(out)
        out += struct.pack(f"<{len(starts)}I", *starts)
        offsets.append((len(out), table, len(starts), page.shape))
        out += b"\0" * (2 + 12 * 7 + 4)
    for k, (at, table, n, (h, w)) in enumerate(offsets):
        where = table if n > 1 else struct.unpack("<I", out[table : table + 4])[0]
        tags = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, n, where), (277, 3, 1, 1), (278, 4, 1, rows_per_strip)]
        after = offsets[k + 1][0] if k + 1 < len(offsets) else 0
        out[at : at + 2 + 84 + 4] = struct.pack("<H", 7) + b"".join(struct.pack("<HHII", *t) for t in tags) + struct.pack("<I", after)
    out[4:8] = struct.pack("<I", offsets[0][0])
    return bytes(out)


def test_tiff_source(spark, tmp_path):
    rng = np.random.default_rng(0)
    pages = [rng.integers(0, 50, (5, 4)), rng.integers(0, 50, (2, 3))]
    (tmp_path / "i.tif").write_bytes(tiff(pages))
    spark.dataSource.register(TiffPixels)
    got = {(r.channel, r.x, r.y): r.value for r in spark.read.format("tiff_pixels").option("above", 25).load(str(tmp_path / "*.tif")).collect()}
    assert got == {(c, x, y): float(v) for c, p in enumerate(pages) for (y, x), v in np.ndenumerate(p) if v > 25}
    one = spark.read.format("tiff_pixels").option("channel", 1).load(str(tmp_path / "i.tif"))
    assert {r.channel for r in one.collect()} == {1}
    assert spark.read.format("tiff_pixels").load(str(tmp_path / "none*.tif")).count() == 0


def lzw(data):
    """Plain encoder: growing table, cleared when full."""
    def start():
        return {bytes([k]): k for k in range(256)}, 258

    table, free = start()
    bits, word = format(256, "09b"), b""
    width = lambda: 9 if free < 512 else 10 if free < 1024 else 11 if free < 2048 else 12
    for k in range(len(data)):
        if word + data[k : k + 1] in table:
            word += data[k : k + 1]
            continue
        bits += format(table[word], f"0{width()}b")
        table[word + data[k : k + 1]], free, word = free, free + 1, data[k : k + 1]
        if free == 4094:
            bits += format(table[word], f"0{width()}b") + format(256, "012b")
            (table, free), word = start(), b""
    if word:
        bits += format(table[word], f"0{width()}b")
        free += 1
    bits += format(257, f"0{width()}b")
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def big_tiled(page, side, compression):
    """A BigTIFF of one page of 32-bit pixels in tiles, with differences along the lines."""
    out, offsets, sizes = bytearray(b"II+\0" + struct.pack("<HHQ", 8, 0, 0)), [], []
    h, w = page.shape
    padded = np.zeros((-(-h // side) * side, -(-w // side) * side), "<u4")
    padded[:h, :w] = page
    for y in range(0, h, side):
        for x in range(0, w, side):
            t = padded[y : y + side, x : x + side]
            raw = np.diff(t, axis=1, prepend=np.zeros((side, 1), "<u4")).astype("<u4").tobytes()
            raw = zlib.compress(raw) if compression == 8 else lzw(raw)
            offsets.append(len(out))
            sizes.append(len(raw))
            out += raw
    n = len(offsets)
    lists = len(out)
    out += struct.pack(f"<{n}Q{n}Q", *offsets, *sizes) + b"mask\0"
    at = len(out)
    tags = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, 32), (259, 3, 1, compression), (270, 2, 5, int.from_bytes(b"mask\0", "little")), (277, 3, 1, 1), (317, 3, 1, 2), (322, 4, 1, side), (323, 4, 1, side), (324, 16, n, lists), (325, 16, n, lists + 8 * n)]
    out += struct.pack("<Q", len(tags)) + b"".join(struct.pack("<HHQQ", *t) for t in tags) + struct.pack("<Q", 0)
    out[8:16] = struct.pack("<Q", at)
    return bytes(out)


@pytest.mark.parametrize("compression", [8, 5])
def test_big_tiled_tiff(spark, tmp_path, compression):
    page = np.random.default_rng(1).integers(0, 4, (70, 90)) * 70_001
    page[10:40, 10:80] = 5
    (tmp_path / "m.tif").write_bytes(big_tiled(page, 32, compression))
    spark.dataSource.register(TiffPixels)
    spark.dataSource.register(TiffPages)
    read = spark.read.format("tiff_pixels")
    assert {(r.x, r.y): r.value for r in read.load(str(tmp_path / "*.tif")).collect()} == {(x, y): float(v) for (y, x), v in np.ndenumerate(page) if v}
    part = read.options(x0=30, y0=5, x1=66, y1=33).load(f"file://{tmp_path}/m.tif").collect()
    assert {(r.x, r.y): r.value for r in part} == {(x, y): float(v) for (y, x), v in np.ndenumerate(page) if v and 30 <= x < 66 and 5 <= y < 33}
    got = spark.read.format("tiff_pages").load(str(tmp_path / "m.tif")).first()
    assert (got.width, got.height, got.bits, got.n_blocks, got.tiled, got.big, got.description) == (90, 70, 32, 9, True, True, "mask")


def test_lzw_through_full_tables():
    rng = np.random.default_rng(2)
    for data in (b"", b"a", b"abab" * 5_000, rng.integers(0, 256, 30_000).astype("u1").tobytes(), rng.integers(0, 3, 60_000).astype("u1").tobytes()):
        assert tiff_source.unpack_lzw(lzw(data)) == data


def test_plain_strips_are_cut_into_lines(tmp_path):
    (tmp_path / "i.tif").write_bytes(tiff([np.arange(40).reshape(10, 4)], 10))
    page = tiff_source.pages(str(tmp_path / "i.tif"))[0]
    before, tiff_source.TASK_BYTES = tiff_source.TASK_BYTES, 24
    try:
        cut = list(tiff_source._cut(page.blocks[0], page, 2, 9))
    finally:
        tiff_source.TASK_BYTES = before
    assert [(b.y, b.rows, b.size) for b in cut] == [(2, 3, 24), (5, 3, 24), (8, 1, 8)]


def test_ingest_takes_new_files_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(source)
    assert ingest_available(spark, source, ["id"], target).count() == 5
    assert ingest_available(spark, source, ["id"], target).count() == 5
    spark.range(3).write.mode("append").parquet(source)
    assert ingest_available(spark, source, ["id"], target).count() == 8
