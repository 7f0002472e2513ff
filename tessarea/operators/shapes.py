"""Polygons of any number of parts and holes, convex or not, by a cover of cells.

A shape is a column of rings, array<array<struct<x, y>>>, in any order and direction: a place is inside if a ray from it crosses
the rings an odd number of times, so holes and parts need no marks. Each shape is covered by cells of a quadtree: cells within it
are kept whole and as large as they are, cells that its edges cross are cut until they hold few edges. A cell takes along the edges that
rays from it meet, not the shape. Points and shapes meet in cells by equi-joins over the levels that occur, so neither a large
shape nor a hot place is compared with everything, and no task gets more edges than its cells' rows have.

Areas shared by two shapes are sums over common cells. Within one, the lines of all corners and crossings part it into strips, in each of
which no edges cross: there the length inside both is linear, and its value at half height times the height is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.session import Scratch

FEW, DEEP = 8, 14  # edges of a cell that is not cut; levels below that of the whole shape
RINGS = "array<array<struct<x: double, y: double>>>"
COVER = "level int, i long, j long, inner boolean, edges array<double>"


def edges_of(rings: list) -> np.ndarray:
    """Rows x0, y0, x1, y1 of all edges of closed rings; level ones are left out, as rays along them meet nothing."""
    out = []
    for ring in rings or ():
        p = np.array([(c["x"], c["y"]) for c in ring or () if c is not None and c["x"] is not None and c["y"] is not None], float).reshape(-1, 2)
        if len(p) > 2:
            out.append(np.hstack([p, np.roll(p, -1, axis=0)]))
    e = np.concatenate(out) if out else np.empty((0, 4))
    return e[e[:, 1] != e[:, 3]]


def _inside(e: np.ndarray, x: float, y: float) -> bool:
    """Rays go to the left; an edge holds its lower end alone."""
    e = e[(e[:, 1] > y) != (e[:, 3] > y)]
    return bool(((e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0] < x).sum() & 1)


def _touching(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Which edges have a point in the box."""
    near = (np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0) & (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0)
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    sides = np.stack([dx * (y - e[:, 1]) - dy * (x - e[:, 0]) for x in (x0, x1) for y in (y0, y1)])
    return near & (sides.min(0) <= 0) & (sides.max(0) >= 0)


def cover(rings: list, few: int = FEW, deep: int = DEEP) -> Iterator[tuple[int, int, int, bool, np.ndarray]]:
    """(level, i, j, inner, edges) of the cells of a shape; a cell of level l has sides of 2^-l."""
    e = edges_of(rings)
    if not len(e):
        return
    low, high = np.minimum(e[:, :2], e[:, 2:]).min(0), np.maximum(e[:, :2], e[:, 2:]).max(0)
    top = int(-np.ceil(np.log2(max(float((high - low).max()), 2.0**-40))))
    first, last = np.floor(low * 2.0**top).astype(np.int64), np.floor(high * 2.0**top).astype(np.int64)
    todo = [(top, i, j, e) for i in range(first[0], last[0] + 1) for j in range(first[1], last[1] + 1)]
    while todo:
        level, i, j, strip = todo.pop()
        side = 2.0**-level
        x0, y0 = i * side, j * side
        # What rays from the cell can meet: edges as high as it, to its left or in it.
        strip = strip[(np.maximum(strip[:, 1], strip[:, 3]) >= y0) & (np.minimum(strip[:, 1], strip[:, 3]) <= y0 + side) & (np.minimum(strip[:, 0], strip[:, 2]) <= x0 + side)]
        n = int(_touching(strip, x0, y0, x0 + side, y0 + side).sum())
        if not n:
            if _inside(strip, x0 + side / 2, y0 + side / 2):
                yield level, i, j, True, strip[:0]
        elif n <= few or level >= top + deep:
            yield level, i, j, False, strip
        else:
            todo += [(level + 1, 2 * i + a, 2 * j + b, strip) for a in (0, 1) for b in (0, 1)]


def covers(shapes: DataFrame, key: str, rings: str = "rings", few: int = FEW) -> DataFrame:
    """key and the cells of each shape. A NULL or flat shape has none."""
    kind = shapes.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                name, found = row.column(0), []
                for cell in cover(row.column(1).to_pylist()[0], few):
                    found.append(cell)
                    if len(found) == 4096:
                        yield _rows(name, found)
                        found = []
                if found:
                    yield _rows(name, found)

    def _rows(name: pa.Array, found: list) -> pa.RecordBatch:
        level, i, j, inner, edges = zip(*found, strict=True)
        names = pa.concat_arrays([name] * len(found))
        columns = [names, pa.array(level, pa.int32()), pa.array(map(int, i), pa.int64()), pa.array(map(int, j), pa.int64()), pa.array(inner), pa.array([x.ravel() for x in edges], pa.list_(pa.float64()))]
        return pa.record_batch(columns, names=[key, "level", "i", "j", "inner", "edges"])

    plain = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))))
    return shapes.select(key, plain.alias("rings")).mapInArrow(run, f"{key} {kind}, {COVER}")


def _levels(cells: DataFrame) -> list[int]:
    """The levels that occur: at most some sixty numbers."""
    return sorted(r.level for r in cells.select("level").distinct().collect())


def inside(x: Column, y: Column, edges: Column) -> Column:
    """Whether an odd number of edges (x0, y0, x1, y1, one after another) lies to the left of a place."""
    at = lambda k, c: F.element_at(edges, 4 * k + c)
    n = (F.size(edges) / 4).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    crossed = F.filter(starts, lambda k: ((at(k, 2) > y) != (at(k, 4) > y)) & ((at(k, 3) - at(k, 1)) * (y - at(k, 2)) / (at(k, 4) - at(k, 2)) + at(k, 1) < x))
    return F.size(crossed) % 2 == 1


def held_by(points: DataFrame, cells: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Points joined with the shapes (their covers) that hold them: cells within a shape need no test, others one of their own edges."""
    at = [F.struct(F.lit(level).alias("level"), F.floor(F.col(x) * 2.0**level).cast("long").alias("i"), F.floor(F.col(y) * 2.0**level).cast("long").alias("j")) for level in _levels(cells)]
    if not at:
        at = [F.struct(F.lit(0).alias("level"), F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))]
    met = points.withColumn("_at", F.explode(F.array(*at))).withColumns({"_l": F.col("_at.level"), "_i": F.col("_at.i"), "_j": F.col("_at.j")}).drop("_at")
    met = met.join(cells.withColumnsRenamed({"level": "_l", "i": "_i", "j": "_j"}), ["_l", "_i", "_j"])
    return met.filter(F.col("inner") | inside(F.col(x), F.col(y), F.col("edges"))).drop("_l", "_i", "_j", "inner", "edges")


def _spans(e: np.ndarray | None, at: np.ndarray, x0: float, x1: float) -> np.ndarray:
    """For each height the spans within the shape between x0 and x1, as rows of begin, end, begin, end; None for all of it."""
    if e is None:
        return np.tile([x0, x1], (len(at), 1))
    y = at[:, None]
    meets = (e[:, 1] > y) != (e[:, 3] > y)
    x = np.where(meets, (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0], np.inf)
    x = np.sort(x, axis=1)
    x = np.hstack([x, np.full((len(at), len(e) % 2), np.inf)])
    return np.clip(x, x0, x1)


def shared_area(a: np.ndarray | None, b: np.ndarray | None, x0: float, y0: float, x1: float, y1: float) -> float:
    """Of the box the area within both; None stands for all of it."""
    edges = [e for e in (a, b) if e is not None]
    if not edges:
        return (x1 - x0) * (y1 - y0)
    e = np.concatenate(edges)
    heights = [e[:, 1], e[:, 3], *[e[:, 1] + (x - e[:, 0]) * (e[:, 3] - e[:, 1]) / np.where(e[:, 2] != e[:, 0], e[:, 2] - e[:, 0], np.inf) for x in (x0, x1)]]
    d = e[:, 2:] - e[:, :2]
    cross = d[:, None, 0] * d[None, :, 1] - d[:, None, 1] * d[None, :, 0]
    gap = e[None, :, :2] - e[:, None, :2]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (gap[..., 0] * d[None, :, 1] - gap[..., 1] * d[None, :, 0]) / cross
        meets = (t >= 0) & (t <= 1)
        heights.append((e[:, None, 1] + t * d[:, None, 1])[meets])
    y = np.unique(np.clip(np.concatenate([*heights, [y0, y1]]), y0, y1))
    at = (y[1:] + y[:-1]) / 2
    p, q = _spans(a, at, x0, x1), _spans(b, at, x0, x1)
    low = np.maximum(p[:, 0::2, None], q[:, None, 0::2])
    high = np.minimum(p[:, 1::2, None], q[:, None, 1::2])
    return float((np.maximum(high - low, 0).sum((1, 2)) * np.diff(y)).sum())


def _areas(cells: DataFrame, keys: Sequence[str], two: bool) -> DataFrame:
    """keys and the area of each row's cell (level, i, j) within its shape, or within both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in batch.schema.names if n not in keys and not n.startswith("edges")}
            sides = [(batch.column(f"edges{s}"), c[f"inner{s}"]) for s in ("", "_2")[: 1 + two]]
            out = []
            for r in range(batch.num_rows):
                both = [None if whole[r] else e[r].values.to_numpy(zero_copy_only=False).reshape(-1, 4) for e, whole in sides]
                side = 2.0 ** -c["level"][r]
                x, y = c["i"][r] * side, c["j"][r] * side
                out.append(shared_area(both[0], both[1] if two else None, x, y, x + side, y + side))
            yield pa.record_batch([*[batch.column(k) for k in keys], pa.array(out, pa.float64())], names=[*keys, "area"])

    kinds = ", ".join(f"{k} {cells.schema[k].dataType.simpleString()}" for k in keys)
    wanted = [*keys, "level", "i", "j", "inner", "edges", *(["inner_2", "edges_2"] if two else [])]
    return cells.select(*wanted).mapInArrow(run, f"{kinds}, area double")


def areas(cells: DataFrame, key: str) -> DataFrame:
    """key and area of each shape, from its cover."""
    return _areas(cells, [key], False).groupBy(key).agg(F.sum("area").alias("area"))


def overlay(left: DataFrame, right: DataFrame, key: str = "id", key2: str = "id2") -> DataFrame:
    """key, key2 and ``overlap``: the area that two shapes share, where it is positive. Both are given by their covers.

    Cells of different sizes meet where one lies in the other: the smaller looks up all cells above it in the other cover."""
    a = left.select(F.col(key).alias("_a"), "level", "i", "j", "inner", "edges")
    b = right.select(F.col(key2).alias("_b"), *[F.col(c).alias(f"{c}_2") for c in ("level", "i", "j", "inner", "edges")])
    above = lambda c, level, to: F.call_function("shiftright", F.col(c), F.col(level) - to)

    def lifted(df: DataFrame, suffix: str, levels: list[int], strict: bool) -> DataFrame:
        level = f"level{suffix}"
        ups = [F.when(F.col(level) > to if strict else F.col(level) >= to, F.struct(F.lit(to).alias("l"), above(f"i{suffix}", level, to).alias("m"), above(f"j{suffix}", level, to).alias("n"))) for to in levels]
        return df.withColumn("_up", F.explode(F.filter(F.array(*ups), lambda x: x.isNotNull()))).select("*", "_up.*").drop("_up")

    levels, levels_2 = _levels(left), _levels(right)
    if not levels or not levels_2:
        levels, levels_2 = [0], [0]
    small_a = lifted(a, "", levels_2, False).join(b.withColumnsRenamed({"level_2": "l", "i_2": "m", "j_2": "n"}), ["l", "m", "n"])
    small_b = lifted(b, "_2", levels, True).join(a.withColumnsRenamed({"level": "l", "i": "m", "j": "n"}), ["l", "m", "n"]).withColumnsRenamed({"level_2": "level", "i_2": "i", "j_2": "j"})
    columns = ["_a", "_b", "level", "i", "j", "inner", "edges", "inner_2", "edges_2"]
    met = small_a.select(*columns).unionByName(small_b.select(*columns))
    sums = _areas(met, ["_a", "_b"], True).groupBy("_a", "_b").agg(F.sum("area").alias("overlap")).filter("overlap > 0")
    return sums.withColumnsRenamed({"_a": key, "_b": key2})


def assign(points: DataFrame, layers: Sequence[tuple[DataFrame, str]], key: str, zone: str, largest: bool = False, default: str = "remainder") -> DataFrame:
    """Each point's zone (text), from the first layer (zone, rings) with any shape that holds it: the smallest by area, or the largest, ties to the smaller zone; then
    the default. The label of the layer is ``layer``. Points are (``key``, x, y) with any other columns."""
    out, tried, labels = points, [], []
    places = points.select("x", "y").distinct()  # equal places are tried once
    for i, (shapes, label) in enumerate(layers):
        cells = Scratch(points.sparkSession, "assign").keep(covers(shapes, zone), "cells")
        sizes = areas(cells, zone).select(zone, F.round(F.col("area") * (-1 if largest else 1), 12).alias("_a"))
        held = held_by(places, cells).join(sizes, zone)
        best = held.groupBy("x", "y").agg(F.min(F.struct("_a", zone)).alias("_b")).select("x", "y", F.col("_b")[zone].alias(f"_z{i}"))
        out = out.join(best, ["x", "y"], "left")
        tried.append(F.col(f"_z{i}"))
        labels.append(F.when(F.col(f"_z{i}").isNotNull(), F.lit(label)))
    return out.withColumns({zone: F.coalesce(*tried, F.lit(default)), "layer": F.coalesce(*labels, F.lit("none"))}).drop(*[f"_z{i}" for i in range(len(layers))])


def pieces(lines: DataFrame, key: str, path: str = "path", finer: int = 3) -> DataFrame:
    """key, level, i, j, x0, y0, x1, y1: lines (arrays of (x, y)) cut at the grid of cells of which a side is about an eighth of the segment, each piece with its cell."""
    kind = lines.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                points = [(p["x"], p["y"]) for p in batch.column(1)[k].as_py() or () if p is not None and p["x"] is not None and p["y"] is not None]
                found: list[tuple] = []
                for (x0, y0), (x1, y1) in zip(points, points[1:], strict=False):
                    length = max(abs(x1 - x0), abs(y1 - y0))
                    if length == 0:
                        continue
                    level = int(np.floor(-np.log2(length))) + finer
                    t = np.unique(np.concatenate([[0.0, 1.0], _grid(x0, x1, level), _grid(y0, y1, level)]))
                    at = np.stack([x0 + t * (x1 - x0), y0 + t * (y1 - y0)], 1)
                    cell = np.floor((at[1:] + at[:-1]) / 2 * 2.0**level).astype(np.int64)
                    found += [(level, *map(int, c), *map(float, a), *map(float, b)) for c, a, b in zip(cell, at[:-1], at[1:], strict=True)]
                    if len(found) > 10_000:
                        yield _named(batch.column(0).slice(k, 1), found)
                        found = []
                if found:
                    yield _named(batch.column(0).slice(k, 1), found)

    def _named(name: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 4]
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.record_batch([pa.concat_arrays([name] * len(found)), *columns], names=[key, "level", "i", "j", "x0", "y0", "x1", "y1"])

    plain = F.transform(path, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return lines.select(key, plain.alias("path")).mapInArrow(run, f"{key} {kind}, level int, i long, j long, x0 double, y0 double, x1 double, y1 double")


def _grid(a: float, b: float, level: int) -> np.ndarray:
    """Where along a to b the lines of the grid are crossed."""
    low, high = sorted((a * 2.0**level, b * 2.0**level))
    lines = np.arange(np.ceil(low), np.floor(high) + 1) / 2.0**level
    return (lines - a) / (b - a) if a != b else np.empty(0)


def inner_length(x0: float, y0: float, x1: float, y1: float, level: int, i: int, j: int, edges: np.ndarray | None) -> float:
    """Length of a piece in a cell and, with edges, within their shape. A piece along a cell's side belongs to one of the cells alone."""
    side = 2.0**-level
    low, high = 0.0, 1.0
    for a, b, at in ((x0, x1, i * side), (y0, y1, j * side)):
        if a != b:
            s, e = sorted(((at - a) / (b - a), (at + side - a) / (b - a)))
            low, high = max(low, s), min(high, e)
    if low >= high:
        return 0.0
    middle = (low + high) / 2
    if (int(np.floor((x0 + middle * (x1 - x0)) / side)), int(np.floor((y0 + middle * (y1 - y0)) / side))) != (i, j):
        return 0.0
    length = float(np.hypot(x1 - x0, y1 - y0))
    if edges is None:
        return (high - low) * length
    dx, dy, ex, ey = x1 - x0, y1 - y0, edges[:, 2] - edges[:, 0], edges[:, 3] - edges[:, 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = dx * ey - dy * ex
        t = ((edges[:, 0] - x0) * ey - (edges[:, 1] - y0) * ex) / cross
    t = np.unique(np.concatenate([[low, high], t[(t > low) & (t < high)]]))
    return float(sum((b - a) * length for a, b in zip(t[:-1], t[1:], strict=True) if _inside(edges, x0 + (a + b) / 2 * dx, y0 + (a + b) / 2 * dy)))


def lengths_inside(lines: DataFrame, cells: DataFrame, line: str, shape: str, path: str = "path") -> DataFrame:
    """line, shape and ``length``: how much of each line lies in each shape (given by its cover), where that is positive. Shapes may be concave and have holes."""
    scratch = Scratch(lines.sparkSession, "lines")
    # Equal lines are measured once, under a number that is written with them.
    paths = scratch.keep(lines.select(F.col(path).alias("_path")).distinct().withColumn("_a", F.monotonically_increasing_id()), "paths")
    cut = scratch.keep(pieces(paths, "_a", "_path"), "pieces")
    b = cells.select(F.col(shape).alias("_b"), *[F.col(c).alias(f"{c}_2") for c in ("level", "i", "j", "inner", "edges")])
    up = lambda c, level, to: F.call_function("shiftright", F.col(c), F.col(level) - to)

    def lifted(df: DataFrame, suffix: str, levels: list[int], strict: bool) -> DataFrame:
        level = f"level{suffix}"
        ups = [F.when(F.col(level) > to if strict else F.col(level) >= to, F.struct(F.lit(to).alias("l"), up(f"i{suffix}", level, to).alias("m"), up(f"j{suffix}", level, to).alias("n"))) for to in levels or [0]]
        return df.withColumn("_up", F.explode(F.filter(F.array(*ups), lambda x: x.isNotNull()))).select("*", "_up.*").drop("_up")

    small = lifted(cut, "", _levels(cells), False).join(b.withColumnsRenamed({"level_2": "l", "i_2": "m", "j_2": "n"}), ["l", "m", "n"])
    large = lifted(b, "_2", _levels(cut), True).join(cut.withColumnsRenamed({"level": "l", "i": "m", "j": "n"}), ["l", "m", "n"]).withColumnsRenamed({"level_2": "level", "i_2": "i", "j_2": "j"})
    columns = ["_a", "_b", "level", "i", "j", "inner_2", "edges_2", "x0", "y0", "x1", "y1"]
    met = small.select(*columns).unionByName(large.select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in columns[2:] if n != "edges_2"}
            edges = [None if whole else e.values.to_numpy(zero_copy_only=False).reshape(-1, 4) for whole, e in zip(c["inner_2"], batch.column("edges_2"), strict=True)]
            found = [inner_length(*v, e) for *v, e in zip(c["x0"], c["y0"], c["x1"], c["y1"], c["level"], c["i"], c["j"], edges, strict=True)]
            yield pa.record_batch([batch.column("_a"), batch.column("_b"), pa.array(found, pa.float64())], names=["_a", "_b", "length"])

    kinds = ", ".join(f"{k} {met.schema[k].dataType.simpleString()}" for k in ("_a", "_b"))
    sums = met.mapInArrow(run, f"{kinds}, length double").groupBy("_a", "_b").agg(F.sum("length").alias("length")).filter("length > 0")
    named = lines.select(line, F.col(path).alias("_path")).join(paths, "_path").select(line, "_a")
    return named.join(sums, "_a").select(line, F.col("_b").alias(shape), "length")
