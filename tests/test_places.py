"""Nearest places without a radius, and shapes of several rings, against brute force."""

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tessarea.operators import geo, neighbours, shapes
from tessarea.operators.neighbours import nearest_places, neighbour_graph


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * 6371.0088 * math.asin(min(1, math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def somewhere(rng, dense):
    if dense:
        return 40 + rng.gauss(0, 0.01), -75 + rng.gauss(0, 0.01)
    return math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)


POLES = [(1000, 90.0, 0.0), (1001, -90.0, 5.0), (1002, 0.0, 180.0), (1003, 0.0, -180.0), (1004, 10.0, 10.0), (1005, None, 3.0), (1006, 10.0, 10.0)]


@pytest.mark.parametrize(("k", "grouped"), [(1, False), (3, True)])
def test_nearest_are_those_of_all_pairs(spark, k, grouped):
    rng = random.Random(k)
    right = [(i, *somewhere(rng, i % 3), i % 4 or None) for i in range(250)] + [(900 + i, 10.0, 10.0, 1) for i in range(5)] + [(990, None, 1.0, 1), (991, 1.0, 1.0, 77)]
    left = [(i, *somewhere(rng, i % 2), i % 4 or None) for i in range(120)] + [(*p, 1) for p in POLES]
    on = ["g"] if grouped else []
    got = {}
    for r in nearest_places(spark.createDataFrame(left, "id long, lat double, lon double, g int"), spark.createDataFrame(right, "id2 long, lat2 double, lon2 double, g int"), k, on, most=4).collect():
        got.setdefault(r.id, {})[r.place] = r.id2
    for i, a, b, g in left:
        want = [] if a is None else [j for _, j in sorted((round(km(a, b, c, d), 6), j) for j, c, d, h in right if c is not None and (not grouped or g == h))[:k]]
        assert [got.get(i, {})[p] for p in sorted(got.get(i, {}))] == want


def test_one_isolated_place_and_a_dense_far_cluster(spark):
    rng = random.Random(9)
    right = [(i, 40 + rng.gauss(0, 1e-4), -75 + rng.gauss(0, 1e-4)) for i in range(2000)]
    table = spark.createDataFrame(right, "id2 long, lat2 double, lon2 double")
    found = nearest_places(spark.createDataFrame([(1, -40.0, 105.0), (2, 40.0, -75.0)], "id long, lat double, lon double"), table, 2).collect()
    for i, a, b in ((1, -40.0, 105.0), (2, 40.0, -75.0)):
        want = [j for _, j in sorted((round(km(a, b, c, d), 6), j) for j, c, d in right)[:2]]
        assert [r.id2 for r in sorted(found, key=lambda r: r.place) if r.id == i] == want


def test_fewer_than_asked_and_none(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "id long, lat double, lon double")
    right = spark.createDataFrame([(5, 50.0, 50.0)], "id2 long, lat2 double, lon2 double")
    assert [(r.id2, r.place) for r in nearest_places(left, right, 3).collect()] == [(5, 1)]
    assert nearest_places(left, right.limit(0), 3).count() == 0 and nearest_places(left.limit(0), right, 3).count() == 0


def test_neighbours_of_equal_places(spark):
    rows = [(i, 1.0, 1.0) for i in range(6)] + [(10, 1.0, 1.1)]
    got = {}
    for r in neighbour_graph(spark.createDataFrame(rows, "id long, lat double, lon double"), 2).collect():
        got.setdefault(r.id, []).append(r.id2)
    assert {i: sorted(x) for i, x in got.items()} == {0: [1, 2], 1: [0, 2], 2: [0, 1], 3: [0, 1], 4: [0, 1], 5: [0, 1], 10: [0, 1]}


def test_cells_are_cut_where_places_crowd(spark):
    from tessarea.session import Scratch

    rng = random.Random(4)
    rows = [(i, *somewhere(rng, i % 2)) for i in range(400)]
    points = neighbours._in_space(spark.createDataFrame(rows, "id2 long, lat2 double, lon2 double"), "lat2", "lon2")
    placed, tree = neighbours._leaves(points, [], 8, Scratch(spark, "test"))
    assert placed.count() == 400
    assert tree.filter("leaf AND n > 8").count() == 0 and tree.filter("leaf").select("level").distinct().count() > 1
    assert {r.n for r in tree.filter("level = 0").collect()} == {400}


def star(rng, cx, cy, r, n):
    return [{"x": cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), "y": cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)} for k in range(n)]


def made_shapes(rng, n):
    """Stars, with a hole run the other way, and with a second part."""
    out = []
    for k in range(n):
        cx, cy, r = rng.uniform(-3, 3), rng.uniform(-3, 3), rng.choice([0.3, 1, 2])
        rings = [star(rng, cx, cy, r, rng.choice([5, 30, 200]))]
        if k % 2:
            rings.append([{"x": cx + r * 0.1 * math.cos(t), "y": cy + r * 0.1 * math.sin(t)} for t in (5, 3, 1)])
        if k % 3 == 0:
            rings.append(star(rng, cx + 3 * r, cy, r / 2, 7))
        out.append((k, rings))
    return out


@pytest.fixture(scope="module")
def two(spark):
    rng = random.Random(1)
    a, b = made_shapes(rng, 10), made_shapes(rng, 10)
    table = lambda rows, key: shapes.covers(spark.createDataFrame([*rows, (99, None), (98, []), (97, [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}]])], f"{key} long, rings {shapes.RINGS}"), key).cache()
    return a, b, table(a, "id"), table(b, "id2")


N = 600
AT = np.linspace(-8, 8, N, endpoint=False) + 8 / N


def raster(rings):
    x, y = np.meshgrid(AT, AT)
    hits = np.zeros(x.shape, int)
    for ring in rings:
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            if p["y"] != q["y"]:
                hits += ((p["y"] > y) != (q["y"] > y)) & ((q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"] < x)
    return hits % 2 == 1


def test_shared_areas_equal_rasters(two):
    a, b, ca, cb = two
    got = {(r.id, r.id2): r.overlap for r in shapes.overlay(ca, cb).collect()}
    left, right, cell = {k: raster(r) for k, r in a}, {k: raster(r) for k, r in b}, (16 / N) ** 2
    edge = lambda m: (m[1:] != m[:-1]).sum() + (m[:, 1:] != m[:, :-1]).sum()
    for i, p in left.items():
        for j, q in right.items():
            assert abs((p & q).sum() * cell - got.get((i, j), 0)) <= cell * max(4, (edge(p & q)) / 4)
    own = {r.id: r.area for r in shapes.areas(ca, "id").collect()}
    assert set(own) == set(left)
    assert all(abs(own[i] - p.sum() * cell) <= cell * edge(p) / 4 for i, p in left.items())


def test_a_shape_shares_its_area_with_itself(two):
    _, _, ca, _ = two
    own = {r.id: r.area for r in shapes.areas(ca, "id").collect()}
    same = {r.id: r.overlap for r in shapes.overlay(ca, ca.withColumnRenamed("id", "id2")).filter("id = id2").collect()}
    assert same == pytest.approx(own, rel=1e-9)


def test_points_in_shapes(spark, two):
    a, _, ca, _ = two
    rng = random.Random(3)
    points = [(k, rng.uniform(-5, 5), rng.uniform(-5, 5)) for k in range(1500)]
    got = {(r.p, r.id) for r in shapes.held_by(spark.createDataFrame(points, "p long, x double, y double"), ca).collect()}
    want = set()
    for k, x, y in points:
        for i, rings in a:
            crossed = sum((p["y"] > y) != (q["y"] > y) and (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"] < x for r in rings for p, q in zip(r, r[1:] + r[:1], strict=True))
            want |= {(k, i)} if crossed % 2 else set()
    assert got == want and want


def test_a_large_shape_has_few_cells():
    ring = [{"x": 1000 * math.cos(2 * math.pi * k / 2000), "y": 1000 * math.sin(2 * math.pi * k / 2000)} for k in range(2000)]
    cells = list(shapes.cover([ring]))
    assert len(cells) < 4000 and sum(c[3] for c in cells) > 100
    assert sum((2.0 ** -c[0]) ** 2 for c in cells if c[3]) == pytest.approx(math.pi * 1e6, rel=0.05)


def test_lengths_of_lines_in_shapes(spark, two):
    a, _, ca, _ = two
    rng = random.Random(8)
    lines = [(k, [{"x": rng.uniform(-5, 5), "y": rng.uniform(-5, 5)} for _ in range(rng.randrange(1, 5))]) for k in range(25)]
    lines += [(50, None), (51, [{"x": 1.0, "y": 1.0}, {"x": 1.0, "y": 1.0}]), (52, [{"x": -4.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}])]
    got = {(r.line, r.id): r.length for r in shapes.lengths_inside(spark.createDataFrame(lines, "line long, path array<struct<x: double, y: double>>"), ca, "line", "id").collect()}
    for k, path in lines:
        for i, rings in a:
            want, e = 0.0, shapes.edges_of(rings)
            for p, q in zip(path or [], (path or [])[1:], strict=False):
                n = 4000
                t = (np.arange(n) + 0.5) / n
                inside = [shapes._inside(e, p["x"] + s * (q["x"] - p["x"]), p["y"] + s * (q["y"] - p["y"])) for s in t[::10]]
                want += math.hypot(q["x"] - p["x"], q["y"] - p["y"]) * np.mean(inside)
            assert got.get((k, i), 0.0) == pytest.approx(want, abs=0.35)
    assert sum(got.values()) > 20


def test_assignment_by_layers_of_shapes(spark):
    box = lambda x, y, n: [{"x": x, "y": y}, {"x": x + n, "y": y}, {"x": x + n, "y": y + n}, {"x": x, "y": y + n}]
    layer = lambda rows: spark.createDataFrame(rows, f"zone string, rings {shapes.RINGS}")
    first, second = layer([("big", [box(0.0, 0.0, 10.0), box(4.0, 4.0, 2.0)]), ("small", [box(1.0, 1.0, 1.0)])]), layer([("wide", [box(-5.0, -5.0, 30.0)])])
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 3.0, 3.0), (3, 5.0, 5.0), (4, 90.0, 9.0)], "id int, x double, y double")
    got = lambda largest: {r.id: (r.zone, r.layer) for r in shapes.assign(points, [(first, "a"), (second, "b")], "id", "zone", largest).collect()}
    assert got(False) == {1: ("small", "a"), 2: ("big", "a"), 3: ("wide", "b"), 4: ("remainder", "none")}
    assert got(True)[1] == ("big", "a")


def test_equal_places_and_lines_are_tried_once(spark, monkeypatch):
    tried = {}

    def counting(module, name):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda first, *rest, **more: tried.update({name: first.count()}) or plain(first, *rest, **more))

    counting(geo, "in_polygons"), counting(shapes, "held_by"), counting(shapes, "pieces")
    points = spark.range(600).select("id", (F.col("id") % 3 + 0.5).cast("double").alias("x"), F.lit(0.5).alias("y"))
    zones = spark.createDataFrame([("a", [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 1.0)])], "zone string, ring array<struct<x: double, y: double>>")
    rings = zones.select("zone", F.array("ring").alias("rings"))
    for got in (geo.assign(points, [(zones, "l")], "id", "zone", 0.5), shapes.assign(points, [(rings, "l")], "id", "zone")):
        assert {(r.zone, r["count"]) for r in got.groupBy("zone").count().collect()} == {("a", 400), ("remainder", 200)}
    lines = spark.range(600).select("id", F.array(*[F.struct(x.cast("double").alias("x"), F.lit(0.3).alias("y")) for x in (F.lit(1.5), 2.5 + F.col("id") % 2)]).alias("path"))
    inside = shapes.lengths_inside(lines, shapes.covers(rings, "zone"), "id", "zone")
    assert [(r["count"], round(r["sum(length)"], 9)) for r in inside.groupBy("zone").agg(F.count("*").alias("count"), F.sum("length")).collect()] == [(600, 300.0)]
    assert tried == {"in_polygons": 3, "held_by": 3, "pieces": 2}


def test_nearest_within_a_radius(spark):
    rng = random.Random(4)
    left = spark.createDataFrame([(i, *somewhere(rng, True)) for i in range(60)], "id long, lat double, lon double")
    right = spark.createDataFrame([(i, *somewhere(rng, True)) for i in range(40)], "id2 long, lat2 double, lon2 double")
    every = geo.nearest(geo.within_km(left, right, 0.4).withColumn("km", F.round("km", 6)), "id", [F.asc("km"), F.asc("id2")], 2)
    got = nearest_places(left, right, 2, within=0.4).select("id", "id2")
    assert sorted(got.collect()) == sorted(every.select("id", "id2").collect())
    assert 0 < got.count() < 120
