"""Rasters in TIFF files as scan lines of their tiles or strips, and statistics of zones from them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tessarea.operators.distributed import quantiles
from tessarea.operators.shapes import edges_of
from tessarea.sources.store import opened, part

# Fixed values of the format: types of fields with their sizes, tags, and kinds of samples.
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8)}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_SIZE, PLANES = 256, 257, 258, 259, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_SIZE, FORMAT, SCALE, TIE, NODATA = 317, 322, 323, 324, 325, 339, 33550, 33922, 42113
SAMPLE = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}


class Header:
    """What the first directory of a file tells: size, blocks (tiles or strips) and where they lie, samples, place of pixels, nodata."""

    def __init__(self, path: str):
        with opened(path) as f:
            order = {b"II": "<", b"MM": ">"}.get(f.read(2))
            if order is None:
                raise ValueError(f"{path} is no TIFF")
            version = struct.unpack(f"{order}H", part(f, 2, 2))[0]
            if version not in (42, 43):
                raise ValueError(f"{path}: version {version}")
            self.path, self.order, large = path, order, version == 43
            at = struct.unpack(f"{order}{'Q' if large else 'I'}", part(f, 8 if large else 4, 8 if large else 4))[0]
            count_size, entry, room = (8, 20, 8) if large else (2, 12, 4)
            count = struct.unpack(f"{order}{'Q' if large else 'H'}", part(f, at, count_size))[0]
            tags: dict[int, tuple] = {}
            block = part(f, at + count_size, entry * count)
            for i in range(count):
                one = block[entry * i : entry * (i + 1)]
                tag, kind = struct.unpack(f"{order}HH", one[:4])
                n = struct.unpack(f"{order}{'Q' if large else 'I'}", one[4 : entry - room])[0]
                if kind not in TYPES:
                    continue
                letter, size = TYPES[kind]
                raw = one[entry - room : entry - room + n * size] if n * size <= room else part(f, struct.unpack(f"{order}{'Q' if large else 'I'}", one[entry - room :])[0], n * size)
                tags[tag] = struct.unpack(f"{order}{n}{letter}" if letter != "s" else f"{n}s", raw)
        one = lambda tag, default: tags.get(tag, (default,))[0]
        self.width, self.height, self.compression, self.predictor = one(WIDTH, 0), one(HEIGHT, 0), one(COMPRESSION, 1), one(PREDICTOR, 1)
        if one(SAMPLES, 1) != 1:
            raise ValueError(f"{path}: one band is read, it has {one(SAMPLES, 1)}")
        self.tiled = TILE_AT in tags
        self.block_width = one(TILE_WIDTH, 0) if self.tiled else self.width
        self.block_height = one(TILE_HEIGHT, 0) if self.tiled else min(one(STRIP_ROWS, self.height), self.height)
        self.at, self.sizes = (tags[TILE_AT], tags[TILE_SIZE]) if self.tiled else (tags[STRIP_AT], tags[STRIP_SIZE])
        kind = (one(FORMAT, 1), one(BITS, 1))
        if kind not in SAMPLE or self.compression not in (1, 5, 8, 32773, 32946) or self.predictor not in (1, 2):
            raise ValueError(f"{path}: samples {kind}, compression {self.compression}, predictor {self.predictor}")
        self.sample = np.dtype(order + SAMPLE[kind])
        scale, tie = tags.get(SCALE, (1.0, 1.0, 0.0)), tags.get(TIE, (0.0,) * 6)
        # The centre of pixel (0, 0), and the steps: rows go down.
        self.dx, self.dy = scale[0], scale[1]
        self.x, self.y = tie[3] + (0.5 - tie[0]) * self.dx, tie[4] - (0.5 - tie[1]) * self.dy
        self.nodata = float(tags[NODATA][0].strip(b"\0 ")) if NODATA in tags else None
        self.across = -(-self.width // self.block_width)

    def pixels(self, f: pa.NativeFile, block: int) -> np.ndarray:
        """The values of a block, rows by columns, without what lies beyond the edges."""
        raw = unpacked(part(f, self.at[block], self.sizes[block]), self.compression)
        row = block // self.across * self.block_height
        height = self.block_height if self.tiled else min(self.block_height, self.height - row)
        v = np.frombuffer(raw, self.sample, height * self.block_width).reshape(height, self.block_width)
        if self.predictor == 2:
            v = np.cumsum(v, axis=1, dtype=v.dtype.newbyteorder("=")).astype(v.dtype)
        return v[: self.height - row, : self.width - block % self.across * self.block_width]


def unpacked(data: bytes, compression: int) -> bytes:
    if compression in (8, 32946):
        return zlib.decompress(data)
    return {1: bytes, 5: from_lzw, 32773: from_runs}[compression](data)


def from_runs(data: bytes) -> bytes:
    """Byte runs: a count n and n + 1 bytes as they are, or 257 - n times the next byte; 128 says nothing."""
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def from_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest first; 256 begins a new table, 257 ends. The width grows one code early."""
    out, table, before = bytearray(), [], b""
    at, bits, held = 0, 0, 0
    width = 9
    while True:
        while bits < width:
            if at >= len(data):
                return bytes(out)
            held, bits, at = held << 8 | data[at], bits + 8, at + 1
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == 257:
            return bytes(out)
        if code == 256:
            table, before, width = [bytes([i]) for i in range(256)] + [b"", b""], b"", 9
            continue
        word = table[code] if code < len(table) else before + before[:1]
        out += word
        if before:
            table.append(before + word[:1])
        before = word
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1


class Blocks(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__(None)
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.together = options["path"], int(options.get("together", "16"))

    def partitions(self) -> list[InputPartition]:
        n = len(Header(self.path).at)
        return [Blocks(i, min(n, i + self.together)) for i in range(0, n, self.together)]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        h = Header(self.path)
        with opened(self.path) as f:
            for block in range(partition.first, partition.last):
                v = h.pixels(f, block).astype(float)
                row, column = block // h.across * h.block_height, block % h.across
                gone = np.isnan(v) | (v == h.nodata if h.nodata is not None else False)
                lines = [pa.array(line, pa.float64(), mask=mask) for line, mask in zip(v, gone, strict=True)]
                n, first = len(lines), column * h.block_width
                values = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * v.shape[1], pa.concat_arrays(lines)) if n else pa.array([], pa.list_(pa.float64()))
                rows = np.arange(row, row + n)
                columns = [pa.array(rows, pa.int32()), pa.array([column] * n, pa.int32()), pa.array([first] * n, pa.int32()), pa.array([h.x + first * h.dx] * n, pa.float64()), pa.array(h.y - rows * h.dy, pa.float64()), values]
                yield pa.record_batch(columns, names=["row", "block", "first", "x", "y", "values"])


class RasterSource(DataSource):
    """Options: path, together (blocks a task). A row is a line of a block: its first column, the centre of its first pixel, and the values, NULL where the file says nodata."""

    @classmethod
    def name(cls) -> str:
        return "tessarea_raster"

    def schema(self) -> str:
        return "row int, block int, first int, x double, y double, values array<double>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


def read_raster(spark: SparkSession, path: str, together: int = 16) -> DataFrame:
    """The lines of a one-band TIFF: tiles or strips, plain, LZW, deflated or in byte runs. The driver reads the header, tasks their blocks."""
    spark.dataSource.register(RasterSource)
    return spark.read.format(RasterSource.name()).options(path=path, together=str(together)).load()


def filled(zones: DataFrame, key: str, header: Header, rings: str = "rings") -> DataFrame:
    """key, row, block, low, high: the pixels whose centres lie in each shape, as runs of columns (``high`` is left out), cut at the blocks' edges.

    Each row of pixels is filled between the crossings of its line with the rings, two and two; no pixel is tested by itself."""
    kind, h = zones.schema[key].dataType.simpleString(), (header.x, header.y, header.dx, header.dy, header.width, header.height, header.block_width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x0, y0, dx, dy, width, height, wide = h
        for batch in batches:
            for k in range(batch.num_rows):
                e, found = edges_of(batch.column(1)[k].as_py()), []
                if not len(e):
                    continue
                low_y, high_y = float(e[:, [1, 3]].min()), float(e[:, [1, 3]].max())
                for row in range(max(0, int((y0 - high_y) / dy) - 1), min(height, int((y0 - low_y) / dy) + 2)):
                    y = y0 - row * dy
                    c = e[(e[:, 1] > y) != (e[:, 3] > y)]
                    x = np.sort((c[:, 2] - c[:, 0]) * (y - c[:, 1]) / (c[:, 3] - c[:, 1]) + c[:, 0])
                    # A centre right of an odd number of crossings is inside: the first beyond a crossing is the next whole column.
                    at = np.clip(np.floor((x - x0) / dx).astype(np.int64) + 1, 0, width)
                    for a, b in zip(at[0::2].tolist(), at[1::2].tolist(), strict=True):
                        found += [(row, q, max(a, q * wide), min(b, q * wide + wide)) for q in range(a // wide, -(-b // wide)) if b > a]
                    if len(found) > 10_000:
                        yield _runs(batch, k, found)
                        found = []
                if found:
                    yield _runs(batch, k, found)

    def _runs(batch: pa.RecordBatch, k: int, found: list) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int32()) for c in zip(*found, strict=True)]
        return pa.record_batch([pa.concat_arrays([batch.column(0).slice(k, 1)] * len(found)), *columns], names=[key, "row", "block", "low", "high"])

    plain = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))))
    return zones.select(key, plain.alias("rings")).mapInArrow(run, f"{key} {kind}, row int, block int, low int, high int")


def zonal(zones: DataFrame, key: str, spark: SparkSession, path: str, shares: dict[str, Column] | None = None, quantile: float = 0.9, rings: str = "rings") -> DataFrame:
    """key, pixels, missing (its share), mean, majority (ties: the smaller value), the quantile with linear interpolation, and a share of known pixels for each
    named condition on ``value``. Lines and runs meet by row and block; values are counted by zone before anything else."""
    lines = read_raster(spark, path)
    runs = filled(zones, key, Header(path), rings)
    met = runs.join(lines, ["row", "block"]).select(key, F.explode(F.slice("values", F.col("low") - F.col("first") + 1, F.col("high") - F.col("low"))).alias("value"))
    counts = met.groupBy(key, "value").agg(F.count("*").alias("n"))
    from tessarea.session import Scratch

    counts = Scratch(spark, "zonal").keep(counts, "counts")
    known = F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    made = [F.try_divide(F.sum(F.when(condition, F.col("n"))), known).alias(name) for name, condition in (shares or {}).items()]
    most = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("a"), "value")))
    sums = counts.groupBy(key).agg(
        F.sum("n").alias("pixels"),
        (F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)) / F.sum("n")).alias("missing"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), known).alias("mean"),
        most["value"].alias("majority"),
        *made,
    )
    tail = quantiles(counts, [key], "value", [quantile], ["quantile"], "n")
    return sums.join(tail, key, "left").select(key, "pixels", "missing", "mean", "majority", "quantile", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in (shares or {})])
