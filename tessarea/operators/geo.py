"""Spatial joins on plain coordinates: cells prune by an equi-join, exact predicates decide."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.functions import haversine_km


def within_km(left: DataFrame, right: DataFrame, km: float, on: list[str] | None = None) -> DataFrame:
    """Pairs of rows of left (id, lat, lon) and right (id2, lat2, lon2) at most ``km`` apart, and equal in the columns ``on``.

    Bands of latitude as high as the radius are cut into cells at least as wide as it is there; each left row is sent to the cells
    around it in its band and the two beside it. Longitudes wrap, and a band at a pole is one cell."""
    size = math.degrees(km / 6371.0088) * 1.000001
    lon = lambda x: F.pmod(F.col(x) + 180.0, F.lit(360.0))
    # A degree's width at the far edge of the neighbouring band; arcs are less than 1.6 times their sines.
    cells = lambda i: F.greatest(F.lit(1), F.floor(360.0 / (1.6 * size) * F.cos(F.radians(F.least(F.lit(90.0), (F.abs(i + 0.5) + 2.5) * size)))).cast("long"))
    band = lambda x: F.floor(F.col(x) / size).cast("long")
    at = lambda x, i: F.least(F.floor(x / 360.0 * cells(i)).cast("long"), cells(i) - 1)
    steps = F.array(*[F.lit(x) for x in (-1, 0, 1)])
    around = F.flatten(F.transform(steps, lambda a: F.array_distinct(F.transform(steps, lambda b: F.struct((band("lat") + a).alias("i"), F.pmod(at(lon("lon"), band("lat") + a) + b, cells(band("lat") + a)).alias("j"))))))
    # Equal places are compared once, however many rows have them; the rows come back by equi-joins on the places.
    on = list(on or [])
    a = left.select(*on, "lat", "lon").distinct().withColumn("_c", F.explode(around))
    b = right.select(*on, "lat2", "lon2").distinct().withColumn("_c", F.struct(band("lat2").alias("i"), at(lon("lon2"), band("lat2")).alias("j")))
    near = a.join(b, ["_c", *on]).drop("_c").withColumn("km", haversine_km("lat", "lon", "lat2", "lon2")).filter(F.col("km") <= km)
    met = left.join(near, [*on, "lat", "lon"]).join(right, [*on, "lat2", "lon2"])
    return met.select(*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on], "km")


def nearest(pairs: DataFrame, key: str, order: list[Column], k: int = 1) -> DataFrame:
    """The first k pairs of each key."""
    return pairs.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting with expressions alone: ring is an array of structs (x, y), closed or not. Points on an edge may fall either side."""
    n = F.size(ring)
    shifted = F.concat(F.slice(ring, n, 1), F.slice(ring, 1, n - 1))
    crosses = F.zip_with(ring, shifted, lambda a, b: F.when((a["y"] > y) != (b["y"] > y), x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]).otherwise(False))
    return F.size(F.filter(crosses, lambda c: F.coalesce(c, F.lit(False)))) % 2 == 1


def area(ring: Column) -> Column:
    """Of a simple ring, by the sum of its corners' cross products."""
    shifted = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.abs(F.aggregate(F.zip_with(ring, shifted, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, x: s + x)) / 2


def in_polygons(points: DataFrame, polygons: DataFrame, size: float, x: str = "x", y: str = "y", ring: str = "ring") -> DataFrame:
    """Points joined with the polygons that hold them. Polygons are sent to the cells of their bounding boxes, points to their own; rays decide."""
    low = lambda c: F.floor(F.array_min(F.transform(ring, lambda p: p[c])) / size).cast("long")
    high = lambda c: F.floor(F.array_max(F.transform(ring, lambda p: p[c])) / size).cast("long")
    cells = F.flatten(F.transform(F.sequence(low("x"), high("x")), lambda i: F.transform(F.sequence(low("y"), high("y")), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    own = F.struct(F.floor(F.col(x) / size).cast("long").alias("i"), F.floor(F.col(y) / size).cast("long").alias("j"))
    met = points.withColumn("_c", own).join(polygons.withColumn("_c", F.explode(cells)), "_c").drop("_c")
    return met.filter(point_in_ring(F.col(x), F.col(y), F.col(ring)))


def assign(points: DataFrame, layers: list[tuple[DataFrame, str]], key: str, zone: str, size: float, largest: bool = False, default: str = "remainder") -> DataFrame:
    """Each point's zone: of the first layer with any that holds it the smallest, or largest, by area (to nine places), ties to the smaller zone; then the default.

    ``zone`` is text. The label of the layer is ``layer``."""
    out, tried, labels = points, [], []
    places = points.select("x", "y").distinct()  # equal places are tried once
    for i, (polygons, label) in enumerate(layers):
        held = in_polygons(places, polygons.withColumn("_a", F.round(area(F.col("ring")) * (-1 if largest else 1), 9)), size)
        best = held.groupBy("x", "y").agg(F.min(F.struct("_a", zone)).alias("_b")).select("x", "y", F.col("_b")[zone].alias(f"_z{i}"))
        out = out.join(best, ["x", "y"], "left")
        tried.append(F.col(f"_z{i}"))
        labels.append(F.when(F.col(f"_z{i}").isNotNull(), F.lit(label)))
    return out.withColumns({zone: F.coalesce(*tried, F.lit(default)), "layer": F.coalesce(*labels, F.lit("none"))}).drop(*[f"_z{i}" for i in range(len(layers))])


def clip_ring(subject: Column, window: Column) -> Column:
    """The part of a ring within a convex ring whose corners run counter-clockwise; empty if there is none. Edge by edge of the window."""
    n = F.size(window)
    edges = F.zip_with(window, F.concat(F.slice(window, 2, n - 1), F.slice(window, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def keep(ring: Column, e: Column) -> Column:
        side = lambda p: (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"])
        point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

        def step(p: Column, q: Column) -> Column:
            t = F.try_divide(side(p), side(p) - side(q))
            cross = F.array(point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"])))
            own = F.array(point(q["x"], q["y"]))
            return F.when((side(p) >= 0) & (side(q) >= 0), own).when(side(p) >= 0, cross).when(side(q) >= 0, F.concat(cross, own)).otherwise(F.slice(own, 1, 0))

        before = F.concat(F.slice(ring, -1, 1), F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))))
        return F.when(F.size(ring) > 0, F.flatten(F.zip_with(before, ring, step))).otherwise(ring)

    plain = F.transform(subject, lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return F.aggregate(edges, plain, keep)


def overlaps(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """left (id, ring), right (id2, ring2, convex and counter-clockwise): pairs with ``overlap``, the area they share, where that is positive. Cells of the bounding boxes pair them."""

    def cells(ring: str) -> Column:
        low = lambda c: F.floor(F.array_min(F.transform(ring, lambda p: p[c])) / size).cast("long")
        high = lambda c: F.floor(F.array_max(F.transform(ring, lambda p: p[c])) / size).cast("long")
        return F.explode(F.flatten(F.transform(F.sequence(low("x"), high("x")), lambda i: F.transform(F.sequence(low("y"), high("y")), lambda j: F.struct(i.alias("i"), j.alias("j"))))))

    pairs = left.select("id", cells("ring").alias("_c")).join(right.select("id2", cells("ring2").alias("_c")), "_c").select("id", "id2").distinct()
    wide = pairs.join(left, "id").join(right, "id2")
    return wide.withColumn("overlap", area(clip_ring(F.col("ring"), F.col("ring2")))).filter("overlap > 0")


def clipped_length(x0: Column, y0: Column, x1: Column, y1: Column, window: Column) -> Column:
    """Length of a segment within a convex ring whose corners run counter-clockwise."""
    n = F.size(window)
    edges = F.zip_with(window, F.concat(F.slice(window, 2, n - 1), F.slice(window, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    side = lambda e, x, y: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])

    def narrow(span: Column, e: Column) -> Column:
        p, q = side(e, x0, y0), side(e, x1, y1)
        t = F.try_divide(p, p - q)
        low = F.when((p < 0) & (q >= 0), F.greatest(span["low"], t)).when((p < 0) & (q < 0), F.lit(1.0)).otherwise(span["low"])
        high = F.when((q < 0) & (p >= 0), F.least(span["high"], t)).when((p < 0) & (q < 0), F.lit(0.0)).otherwise(span["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    span = F.aggregate(edges, F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), narrow)
    return F.greatest(F.lit(0.0), span["high"] - span["low"]) * F.sqrt(F.pow(x1 - x0, 2) + F.pow(y1 - y0, 2))


def interpolated(pairs: DataFrame, zone: str, share: str, sums: list[str], means: dict[str, str]) -> DataFrame:
    """Values of source areas on the zones that overlap them: sums by area share; means weighted by share times a column where known, with the share covered."""
    made = [F.sum(F.col(c) * F.col(share)).alias(c) for c in sums]
    for c, weight in means.items():
        w = F.col(weight) * F.col(share)
        known = F.when(F.col(c).isNotNull(), w)
        made += [F.try_divide(F.sum(F.col(c) * w), F.sum(known)).alias(c), F.coalesce(F.try_divide(F.sum(known), F.sum(w)), F.lit(0.0)).alias(f"{c}_coverage")]
    return pairs.groupBy(zone).agg(*made)


# The ellipsoid GRS 80 and the conic equal-area projection of the contiguous United States (EPSG:5070).
ALBERS = {"a": 6378137.0, "f": 1 / 298.257222101, "lat0": 23.0, "lon0": -96.0, "lat1": 29.5, "lat2": 45.5}


def equal_area(lat: Column, lon: Column, p: dict = ALBERS) -> tuple[Column, Column]:
    """Degrees to metres (x, y) of a conic equal-area projection with two standard parallels."""
    e2 = p["f"] * (2 - p["f"])
    e = math.sqrt(e2)

    def q_of(sine: float) -> float:
        return (1 - e2) * (sine / (1 - e2 * sine**2) - math.log((1 - e * sine) / (1 + e * sine)) / (2 * e))

    def m_of(degrees: float) -> float:
        return math.cos(math.radians(degrees)) / math.sqrt(1 - e2 * math.sin(math.radians(degrees)) ** 2)

    q0, q1, q2 = (q_of(math.sin(math.radians(p[k]))) for k in ("lat0", "lat1", "lat2"))
    m1, m2 = m_of(p["lat1"]), m_of(p["lat2"])
    n = (m1**2 - m2**2) / (q2 - q1)
    c = m1**2 + n * q1
    sine = F.sin(F.radians(lat))
    q = (1 - e2) * (sine / (1 - e2 * sine * sine) - F.log((1 - e * sine) / (1 + e * sine)) / (2 * e))
    rho, theta = p["a"] * F.sqrt(c - n * q) / n, n * F.radians(lon - p["lon0"])
    return rho * F.sin(theta), p["a"] * math.sqrt(c - n * q0) / n - rho * F.cos(theta)
