"""Shapes in binary files and columns: shapefiles with their attribute tables, split by records, and well-known binary."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tessarea.operators.shapes import RINGS
from tessarea.sources.store import opened, part

BOUNDS = ("xmin", "ymin", "xmax", "ymax")


class Records(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__(None)
        self.first, self.last = first, last


class Table:
    """The layout of an attribute table: names, types and widths of its fields."""

    def __init__(self, path: str):
        self.path = path
        with opened(path) as f:
            self.rows, self.head, self.width = struct.unpack("<IHH", part(f, 4, 8))
            raw = part(f, 32, self.head - 32)
        self.fields, at = [], 1
        for i in range(0, len(raw) - 31, 32):
            if raw[i] == 0x0D:
                break
            name, kind, size, digits = raw[i : i + 11].split(b"\0")[0].decode("latin-1"), chr(raw[i + 11]), raw[i + 16], raw[i + 17]
            self.fields.append((name, kind, at, size, digits))
            at += size

    def ddl(self) -> list[tuple[str, str]]:
        # Whole numbers of up to 18 digits fit 64 bits.
        whole = lambda kind, size, digits: kind == "N" and digits == 0 and size <= 18
        return [(n, "date" if k == "D" else "boolean" if k == "L" else "long" if whole(k, s, d) else "double" if k in "NF" else "string") for n, k, _, s, d in self.fields]


def value_of(raw: bytes, kind: str, encoding: str):
    """A field's value by its type in the schema; what is blank or filled with stars is NULL."""
    text = raw.decode(encoding, "replace").strip(" \0")
    if kind == "string":
        return text or None
    if not text or set(text) <= {"*"}:
        return None
    if kind == "date":
        return date(int(text[:4]), int(text[4:6]), int(text[6:8])) if text.isdigit() and text != "0" * 8 else None
    if kind == "boolean":
        return {"Y": True, "T": True, "N": False, "F": False}.get(text.upper())
    return int(text) if kind == "long" else float(text)


def rings_of_record(content: bytes) -> list[list[dict]] | None:
    """All rings of a polygon record (with or without heights and measures); None for a null shape."""
    kind = struct.unpack_from("<i", content)[0]
    if kind == 0:
        return None
    if kind not in (5, 15, 25):
        raise ValueError(f"shape type {kind} is no polygon")
    parts, points = struct.unpack_from("<ii", content, 36)
    starts = [*struct.unpack_from(f"<{parts}i", content, 44), points]
    xy = np.frombuffer(content, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2).tolist()
    return [[{"x": x, "y": y} for x, y in xy[a:b]] for a, b in zip(starts, starts[1:], strict=False)]


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.base, self.names = options["path"].removesuffix(".shp"), schema.names
        self.together, self.encoding = int(options.get("together", "2000")), options.get("encoding", "utf-8")
        self.box = tuple(map(float, options["box"].split(","))) if options.get("box") else None

    def partitions(self) -> list[InputPartition]:
        with opened(f"{self.base}.shx") as f:
            n = (f.size() - 100) // 8
        return [Records(i, min(n, i + self.together)) for i in range(0, n, self.together)]

    def read(self, partition: Records | None) -> Iterator[tuple]:
        if partition is None:
            return
        table = Table(f"{self.base}.dbf")
        kinds, wanted = dict(table.ddl()), set(self.names)
        fields = {n: (at, size) for n, _, at, size, _ in table.fields if n in wanted}
        with opened(f"{self.base}.shx") as index, opened(f"{self.base}.shp") as shapes, opened(f"{self.base}.dbf") as rows:
            n = partition.last - partition.first
            places = np.frombuffer(part(index, 100 + 8 * partition.first, 8 * n), ">i4").reshape(-1, 2) * 2
            records = part(rows, table.head + partition.first * table.width, n * table.width)
            for k in range(n):
                record = records[k * table.width : (k + 1) * table.width]
                at, size = (int(v) for v in places[k])
                bounds = [None] * 4
                start = part(shapes, at + 8, min(36, size))
                if len(start) == 36:
                    bounds = list(struct.unpack("<4d", start[4:]))
                if record[:1] == b"*":  # deleted
                    continue
                if self.box and (bounds[0] is None or bounds[0] > self.box[2] or bounds[2] < self.box[0] or bounds[1] > self.box[3] or bounds[3] < self.box[1]):
                    continue  # told by the record's own box, its points are not read
                values = {c: value_of(record[a : a + s], kinds[c], self.encoding) for c, (a, s) in fields.items()}
                values |= dict(zip(BOUNDS, bounds, strict=True))
                if "rings" in wanted:
                    values["rings"] = rings_of_record(part(shapes, at + 8, size))
                yield tuple(values[c] for c in self.names)


class ShapefileSource(DataSource):
    """Options: path (.shp, with .shx and .dbf beside it), columns (names with commas, all if not given), box (xmin,ymin,xmax,ymax), together (records a task), encoding."""

    @classmethod
    def name(cls) -> str:
        return "tessarea_shapefile"

    def schema(self) -> str:
        columns = [*Table(f"{self.options['path'].removesuffix('.shp')}.dbf").ddl(), *[(b, "double") for b in BOUNDS], ("rings", RINGS)]
        only = self.options.get("columns")
        names = only.split(",") if only else [c for c, _ in columns]
        kinds = dict(columns)
        return ", ".join(f"`{c}` {kinds[c]}" for c in names)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)


def read_shapefile(spark: SparkSession, path: str, columns: Sequence[str] | None = None, box: Sequence[float] | None = None, **options: str) -> DataFrame:
    """Attributes, bounds and rings of the polygons of a shapefile. Tasks read ranges of records that the index file names, of each the fields and, only if
    wanted, the points; with ``box`` just the records whose bounds meet it."""
    spark.dataSource.register(ShapefileSource)
    more = ({"columns": ",".join(columns)} if columns else {}) | ({"box": ",".join(map(repr, map(float, box)))} if box else {})
    return spark.read.format(ShapefileSource.name()).options(path=path, **more, **options).load()


def rings_of_binary(data: bytes) -> list[list[dict]]:
    """Rings of a well-known binary polygon, multipolygon or collection of them; heights, measures and a reference system are passed over."""
    out: list[list[dict]] = []

    def read(at: int) -> int:
        order = "<" if data[at] else ">"
        kind = struct.unpack_from(f"{order}I", data, at + 1)[0]
        at += 9 if kind & 0x20000000 else 5
        plain = kind & 0xFF if kind & 0xE0000000 else kind
        size = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000) if kind & 0xE0000000 else 2 + (0, 1, 1, 2)[plain // 1000 % 4]
        shape, n = plain % 1000, struct.unpack_from(f"{order}I", data, at)[0]
        at += 4
        if shape in (6, 7):
            for _ in range(n):
                at = read(at)
            return at
        if shape != 3:
            raise ValueError(f"geometry {shape} is no polygon")
        for _ in range(n):
            points = struct.unpack_from(f"{order}I", data, at)[0]
            xy = np.frombuffer(data, f"{order}f8", points * size, at + 4).reshape(-1, size)[:, :2].tolist()
            out.append([{"x": x, "y": y} for x, y in xy])
            at += 4 + 8 * points * size
        return at

    read(0)
    return out


def with_rings(df: DataFrame, column: str, name: str = "rings") -> DataFrame:
    """Adds the rings of a column of well-known binary; NULL stays NULL. Decoded in Arrow batches, other columns pass through."""
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {RINGS}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([None if v is None else rings_of_binary(v) for v in batch.column(column).to_pylist()], kind)
            yield pa.record_batch([*batch.columns, found], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)
