"""Workbooks, rasters, shapefiles, well-known binary and feature services, on files and a server made here."""

import json
import math
import struct
import threading
import zipfile
import zlib
from datetime import date, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessarea import sources
from tessarea.operators import shapes
from tessarea.operators.expect import ExpectationError
from tessarea.sources import raster, shapefile
from tessarea.sources.workbook import column_of


def book(path, sheets, shared=()):
    """sheets: name -> rows (number, [(reference, type, text)])."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        for i, rows in enumerate(sheets.values()):
            body = "".join(f'<row r="{n}">' + "".join(f'<c r="{ref}"' + (f' t="{t}"' if t else "") + ">" + (f"<is><t>{v}</t></is>" if t == "inlineStr" else f"<v>{v}</v>") + "</c>" for ref, t, v in cells) + "</row>" for n, cells in rows)
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


SHARED = ["<t>Table 8</t>", "<r><t>Ci</t></r><r><t>ty</t></r>", "<t> Murder\n 1 </t>", "<t>Robbery</t>", "<t>Ávila</t>"]
SHEET = [(1, [("A1", "s", 0)]), (3, [("A3", "s", 1), ("B3", "s", 2), ("D3", "s", 3), ("E3", "inlineStr", "City")]), (4, [("A4", "s", 4), ("B4", "", 12), ("D4", "", 3.5), ("E4", "b", 1)]), (5, []), (7, [("A7", "inlineStr", "B &amp; C")])]


def test_workbooks(spark, tmp_path):
    book(tmp_path / "a.xlsx", {"One": SHEET, "Two": SHEET[1:3]}, SHARED)
    book(tmp_path / "b.xlsx", {"One": SHEET[1:]}, SHARED)
    rows = sources.read_workbook(spark, str(tmp_path / "a.xlsx"), "One").orderBy("row").collect()
    assert [(r.row, r["cells"]) for r in rows] == [(1, ["Table 8"]), (3, ["City", " Murder\n 1 ", None, "Robbery", "City"]), (4, ["Ávila", "12", None, "3.5", "true"]), (5, []), (7, ["B & C"])]
    table = sources.workbook_table(spark, str(tmp_path), ["murder", "robbery"], 2, ["City", "Murder 1", "Robbery", "City 5", "column 3", "none"])
    got = sorted((r.path[-6:], r.sheet, r.row, *r[3:]) for r in table.collect())
    a = ("Ávila", "12", "3.5", "true", None, None)
    assert got == [("a.xlsx", "One", 4, *a), ("a.xlsx", "One", 7, "B & C", *[None] * 5), ("a.xlsx", "Two", 4, *a), ("b.xlsx", "One", 4, *a), ("b.xlsx", "One", 7, "B & C", *[None] * 5)]
    with pytest.raises(ExpectationError, match="a.xlsx"):
        sources.workbook_table(spark, str(tmp_path / "a*"), ["arson"], 1, ["City"])
    assert [column_of(x) for x in ("A1", "Z9", "AA1", "BC12")] == [0, 25, 26, 54]


def lzw(data):
    out, table, nxt, width, cur = [(256, 9)], {bytes([i]): i for i in range(256)}, 258, 9, b""
    for b in data:
        x = cur + bytes([b])
        if x in table:
            cur = x
            continue
        out.append((table[cur], width))
        table[x], nxt = nxt, nxt + 1
        if nxt >= 1 << width and width < 12:
            width += 1
        if nxt >= 4094:
            out.append((256, width))
            table, nxt, width = {bytes([i]): i for i in range(256)}, 258, 9
        cur = bytes([b])
    out += [(table[cur], width)] if cur else []
    bits = "".join(format(c, f"0{w}b") for c, w in [*out, (257, width)])
    return int(bits + "0" * (-len(bits) % 8), 2).to_bytes(-(-len(bits) // 8), "big")


def runs(data):
    out, i = b"", 0
    while i < len(data):
        j = i
        while j < len(data) and j - i < 127 and data[j] == data[i]:
            j += 1
        out += bytes([257 - (j - i), data[i]]) if j - i > 1 else bytes([0, data[i]])
        i = j
    return out


PACK = {1: bytes, 8: zlib.compress, 5: lzw, 32773: runs}


def tiff(path, v, order="<", compression=8, tile=None, strip=7, predictor=1, nodata=None, place=(100.0, 50.0, 2.0)):
    """A one-band file of the array v."""
    height, width = v.shape
    v = v.astype(v.dtype.newbyteorder(order))
    blocks = []
    if tile:
        for a in range(0, height, tile):
            for b in range(0, width, tile):
                block = np.zeros((tile, tile), v.dtype)
                part = v[a : a + tile, b : b + tile]
                block[: part.shape[0], : part.shape[1]] = part
                blocks.append(block)
    else:
        blocks = [v[a : a + strip] for a in range(0, height, strip)]
    if predictor == 2:
        blocks = [np.concatenate([b[:, :1], np.diff(b, axis=1)], axis=1).astype(v.dtype) for b in blocks]
    packed = [PACK[compression](b.tobytes()) for b in blocks]
    body, at = b"", []
    for p in packed:
        at.append(8 + len(body))
        body += p + b"\0" * (len(p) % 2)
    kind = {"u": 1, "i": 2, "f": 3}[v.dtype.kind]
    tags = {256: ("I", [width]), 257: ("I", [height]), 258: ("H", [8 * v.dtype.itemsize]), 259: ("H", [compression]), 277: ("H", [1]), 317: ("H", [predictor]), 339: ("H", [kind])}
    sizes = [len(p) for p in packed]
    tags |= {322: ("I", [tile]), 323: ("I", [tile]), 324: ("I", at), 325: ("I", sizes)} if tile else {273: ("I", at), 278: ("I", [strip]), 279: ("I", sizes)}
    x, y, d = place
    tags |= {33550: ("d", [d, d, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, x, y, 0.0])}
    if nodata is not None:
        tags[42113] = ("s", f"{nodata}\0".encode())
    codes, extra, entries = {"H": 3, "I": 4, "d": 12, "s": 2}, b"", b""
    start = 8 + len(body)
    room = start + 2 + 12 * len(tags) + 4
    for tag in sorted(tags):
        letter, values = tags[tag]
        raw = values if letter == "s" else struct.pack(f"{order}{len(values)}{letter}", *values)
        if len(raw) > 4:
            place_ = struct.pack(f"{order}I", room + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
        else:
            place_ = raw.ljust(4, b"\0")
        entries += struct.pack(f"{order}HHI", tag, codes[letter], len(values)) + place_
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, start)
    path.write_bytes(head + body + struct.pack(f"{order}H", len(tags)) + entries + b"\0" * 4 + extra)


@pytest.mark.parametrize(
    ("kind", "more"),
    [("u1", {}), ("u2", {"tile": 16, "compression": 5}), ("i2", {"compression": 32773, "order": ">"}), ("f4", {"compression": 1, "tile": 16, "order": ">"}), ("u1", {"compression": 5, "predictor": 2}), ("i4", {"predictor": 2, "tile": 16, "nodata": -9})],
)
def test_rasters(spark, tmp_path, kind, more):
    rng = np.random.default_rng(1)
    v = rng.integers(0, 100, (40, 53)).astype(kind)
    if "nodata" in more:
        v[rng.random(v.shape) < 0.1] = more["nodata"]
    tiff(tmp_path / "r.tif", v, **more)
    lines = sources.read_raster(spark, str(tmp_path / "r.tif"), 3)
    got = np.full(v.shape, np.nan)
    for r in lines.collect():
        got[r.row, r.first : r.first + len(r["values"])] = [np.nan if x is None else x for x in r["values"]]
        assert (r.x, r.y) == (101.0 + 2 * r.first, 49.0 - 2 * r.row)
    assert np.array_equal(got, np.where(v == more.get("nodata", 1000), np.nan, v.astype(float)), equal_nan=True)
    assert lines.rdd.getNumPartitions() > 1


def test_zonal_statistics_equal_single_pixels(spark, tmp_path):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 12, (60, 70)).astype("u1")
    tiff(tmp_path / "z.tif", v, tile=16, nodata=11)
    star = lambda cx, cy, r, n: [{"x": cx + r * (0.4 + 0.6 * (k % 2)) * math.cos(6.283 * k / n), "y": cy + r * (0.4 + 0.6 * (k % 2)) * math.sin(6.283 * k / n)} for k in range(n)]
    zones = [(1, [star(150, 0, 45, 11)]), (2, [star(200, -20, 60, 16), star(200, -20, 15, 5)]), (3, [star(90, 60, 30, 8)]), (4, [star(900, 900, 3, 8)]), (5, None)]
    table = spark.createDataFrame(zones, f"zone long, rings {shapes.RINGS}")
    found = {r.zone: r for r in sources.zonal(table, "zone", spark, str(tmp_path / "z.tif"), {"high": F.col("value") >= 6}).collect()}
    assert set(found) == {1, 2, 3}
    for zone, rings in zones[:3]:
        e = shapes.edges_of(rings)
        inside = np.array([[shapes._inside(e, 101.0 + 2 * c, 49.0 - 2 * r) for c in range(70)] for r in range(60)])
        x, all_ = v[inside & (v != 11)].astype(float), int(inside.sum())
        counts = np.bincount(x.astype(int))
        r = found[zone]
        assert (r.pixels, r.majority) == (all_, counts.argmax())
        assert (r.missing, r["mean"], r.quantile, r.high) == pytest.approx((1 - len(x) / all_, x.mean(), np.percentile(x, 90), (x >= 6).mean()))


def test_what_is_no_raster_is_an_error(spark, tmp_path):
    (tmp_path / "x.tif").write_bytes(b"PK\3\4 nothing")
    with pytest.raises(ValueError, match="no TIFF"):
        raster.Header(str(tmp_path / "x.tif"))


def ring(x, y, n):
    return [(x, y), (x + n, y), (x + n, y + n), (x, y + n), (x, y)]


def shp(folder, name, rows):
    """rows: (rings or None, number, text, day, flag)."""
    records, index, at = b"", b"", 100
    for i, (rings, *_) in enumerate(rows):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            xs, ys = [p[0] for p in points], [p[1] for p in points]
            starts = np.cumsum([0, *map(len, rings)])[:-1].tolist()
            content = struct.pack("<i4dii", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        records += struct.pack(">ii", i + 1, len(content) // 2) + content
        index += struct.pack(">ii", at // 2, len(content) // 2)
        at += 8 + len(content)
    (folder / f"{name}.shp").write_bytes(b"\0" * 100 + records)
    (folder / f"{name}.shx").write_bytes(b"\0" * 100 + index)
    fields = [("NUM", "N", 9, 0), ("NAME", "C", 12, 0), ("DAY", "D", 8, 0), ("FLAG", "L", 1, 0), ("SHARE", "N", 8, 3)]
    head = b"".join(n.encode().ljust(11, b"\0") + k.encode() + b"\0" * 4 + bytes([s, d]) + b"\0" * 14 for n, k, s, d in fields) + b"\r"
    width = 1 + sum(s for _, _, s, _ in fields)
    body = b"".join((b"*" if num == -1 else b" ") + str("" if num is None else num).rjust(9).encode() + text.encode().ljust(12) + day.encode().ljust(8) + flag.encode().ljust(1) + (b"*" * 8 if num is None else f"{num / 4:.3f}".rjust(8).encode()) for _, num, text, day, flag in rows)
    (folder / f"{name}.dbf").write_bytes(struct.pack("<4BIHH", 3, 24, 1, 1, len(rows), 32 + len(head), width) + b"\0" * 20 + head + body)


def test_shapefiles(spark, tmp_path):
    rows = [([ring(i * 10.0, 0.0, 4.0), ring(i * 10.0 + 1, 1.0, 1.0)], i, f"é{i}", "20240131", "T") for i in range(7)] + [(None, None, "", "", "?"), ([ring(0.0, 0.0, 1.0)], -1, "gone", "20240101", "F")]
    shp(tmp_path, "a", rows)
    df = sources.read_shapefile(spark, str(tmp_path / "a.shp"), together="3")
    assert df.rdd.getNumPartitions() == 3
    assert dict(df.dtypes)["NUM"] == "bigint" and dict(df.dtypes)["SHARE"] == "double" and dict(df.dtypes)["DAY"] == "date"
    got = {r.NAME: r for r in df.collect()}
    assert len(got) == 8 and got["é2"].NUM == 2 and got["é2"].DAY == date(2024, 1, 31) and got["é2"].FLAG and got["é2"].SHARE == 0.5
    assert [[tuple(p) for p in r] for r in got["é2"].rings] == rows[2][0] and got["é2"].xmax == 24.0
    assert (got[None].NUM, got[None].SHARE, got[None].FLAG, got[None].rings, got[None].xmin) == (None,) * 5
    part = sources.read_shapefile(spark, str(tmp_path / "a.shp"), ["NUM", "xmin"], (15, 0, 31, 2))
    assert sorted(tuple(r) for r in part.collect()) == [(2, 20.0), (3, 30.0)]
    area = {r.NUM: r.area for r in shapes.areas(shapes.covers(df.filter("NUM IS NOT NULL"), "NUM"), "NUM").collect()}
    assert area == pytest.approx({i: 15.0 for i in range(7)})


def wkb(order, kind, *rings, size=2, extra=b""):
    o = "<" if order else ">"
    return bytes([order]) + struct.pack(f"{o}I", kind) + extra + struct.pack(f"{o}I", len(rings)) + b"".join(struct.pack(f"{o}I", len(r)) + b"".join(struct.pack(f"{o}{size}d", *p, *[9.0] * (size - 2)) for p in r) for r in rings)


def test_well_known_binary(spark):
    a, b = ring(0.0, 0.0, 4.0), ring(1.0, 1.0, 1.0)
    many = bytes([1]) + struct.pack("<II", 6, 2) + wkb(1, 3, a, b) + wkb(0, 3, b)
    cases = [wkb(1, 3, a, b), wkb(0, 3, a), many, wkb(1, 1003, a, size=3), wkb(1, 0x80000000 | 3, a, size=3), wkb(1, 0x20000000 | 3, a, extra=struct.pack("<I", 4326)), wkb(0, 3003, b, size=4), None]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, shape binary")
    got = {r.id: r.rings and [[tuple(p) for p in x] for x in r.rings] for r in sources.with_rings(df, "shape").collect()}
    assert got == {0: [a, b], 1: [a], 2: [a, b, b], 3: [a], 4: [a], 5: [a], 6: [b], 7: None}
    with pytest.raises(ValueError, match="no polygon"):
        shapefile.rings_of_binary(bytes([1]) + struct.pack("<I2d", 1, 0, 0) + b"\0" * 8)


def test_features_of_several_parts(spark, tmp_path):
    a, b = [[0, 0], [4, 0], [4, 4], [0, 4]], [[1, 1], [2, 1], [2, 2], [1, 2]]
    far = [[9, 9], [10, 9], [10, 10]]
    made = [{"properties": {"id": 1}, "geometry": {"type": "Polygon", "coordinates": [a, b]}}, {"properties": {"id": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [[a, b], [far]]}}, {"properties": {"id": 3}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": made}))
    (tmp_path / "l.ndjson").write_text("\n".join(("\x1e" if i else "") + json.dumps(x) for i, x in enumerate(made)) + "\n\n")
    for df in (sources.read_features(spark, str(tmp_path / "c.json"), "id: long"), sources.read_feature_lines(spark, str(tmp_path / "l.ndjson"), "id: long")):
        got = {r.id: r.rings and [[[int(p.x), int(p.y)] for p in x] for x in r.rings] for r in df.collect()}
        assert got == {1: [a, b], 2: [a, b, far], 3: None}
        area = {r.id: r.area for r in shapes.areas(shapes.covers(df, "id"), "id").collect()}
        assert area == pytest.approx({1: 15.0, 2: 15.5})


class Layer(BaseHTTPRequestHandler):
    """A layer that fails at each third request, and whose rows grow."""

    rows: list = []
    asked = 0
    lock = threading.Lock()

    def do_GET(self):
        with Layer.lock:
            Layer.asked += 1
            fails = Layer.asked % 3 == 0
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        if fails:
            self.send_response(503 if Layer.asked % 2 else 200)
            self.end_headers()
            self.wfile.write(b'{"error": {"code": 500}}')
            return
        found = Layer.rows
        if "OID >" in q.get("where", ""):
            low, high = (int(x.split("OID")[1].split()[1]) for x in q["where"].split(" AND ")[-2:])
            found = [r for r in found if low < r["OID"] <= high]
        found = sorted(found, key=lambda r: r["OID"], reverse="DESC" in q.get("orderByFields", ""))
        if "query" not in self.path:
            page = {"objectIdField": "OID", "maxRecordCount": 10, "fields": [{"name": n, "type": f"esriFieldType{t}"} for n, t in (("OID", "OID"), ("name", "String"), ("when", "Date"), ("v", "Double"), ("Shape", "Geometry"))]}
        elif "returnCountOnly" in q:
            page = {"count": len(found)}
        else:
            at = int(q.get("resultOffset", 0))
            page = {"features": [{"attributes": r, "geometry": {"x": r["OID"] / 2, "y": -1.0}} for r in found[at : at + int(q.get("resultRecordCount", 10))]]}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(page).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def layer():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Layer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Layer.rows = [{"OID": 3 * i, "name": f"n{i}", "when": 1_700_000_000_000 + 1000 * i, "v": i / 2 if i % 4 else None} for i in range(47)]
    yield f"http://127.0.0.1:{server.server_port}/layer/0"
    server.shutdown()


def test_layers_are_planned_and_read_again_after_faults(spark, layer):
    df = sources.read_layer(spark, layer, geometry="true", wait="0.01", together="2")
    assert df.dtypes == [("OID", "bigint"), ("name", "string"), ("when", "timestamp"), ("v", "double"), ("x", "double"), ("y", "double")]
    assert df.rdd.getNumPartitions() == 3
    got = sorted(tuple(r) for r in df.select("OID", "name", F.col("when").cast("long"), "v", "x", "y").collect())
    assert got == [(3 * i, f"n{i}", 1_700_000_000 + i, i / 2 if i % 4 else None, 1.5 * i, -1.0) for i in range(47)]
    assert isinstance(df.first().when, datetime)


def test_a_layer_that_stays_broken_is_an_error(spark):
    with pytest.raises(Exception, match="refused|URLError|urlopen"):
        sources.read_layer(spark, "http://127.0.0.1:9/layer/0", wait="0.01", tries="2").count()


def test_a_layer_that_grows_is_followed(spark, layer, tmp_path):
    def run():
        q = sources.follow_layer(spark, layer, wait="0.01").select("OID", "name").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 47
    Layer.rows = [*Layer.rows, *({"OID": 500 + i, "name": "new", "when": None, "v": None} for i in range(25))]
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.distinct().count() == 72 and out.filter("name = 'new'").count() == 25
