"""Polygons on the test tables: assignment, overlays, clipped lines, interpolation and neighbours within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.operators import geo, rel, shapes
from tessarea.operators.neighbours import nearest_places
from tessarea.plans.general import KM, PLACES, SITES, places, sites
from tessarea.plans.registry import Tables, query, r
from tessarea.session import Scratch

# Boxes of several sizes around points on a grid; id is a number, and corners run counter-clockwise.
BOXES = "(SELECT s_suppkey AS id2, 40 + (s_suppkey * 53 % 1000) / 500.0 AS y0, -75 + (s_suppkey * 71 % 1000) / 500.0 AS x0, 0.1 + (s_suppkey % 7) * 0.05 AS w, 0.1 + (s_suppkey % 5) * 0.05 AS h FROM supplier)"
TILES = "(SELECT n_nationkey AS id, 40 + (n_nationkey % 5) * 0.4 AS y0, -75 + (n_nationkey // 5) * 0.4 AS x0, 0.4 AS w, 0.4 AS h FROM nation)"


def box(x0: Column, y0: Column, w: Column, h: Column) -> Column:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(corner(x0, y0), corner(x0 + w, y0), corner(x0 + w, y0 + h), corner(x0, y0 + h))


def boxes(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    ring = box(-75 + (k * 71 % 1000) / 500.0, 40 + (k * 53 % 1000) / 500.0, 0.1 + (k % 7) * 0.05, 0.1 + (k % 5) * 0.05)
    return t.supplier.select(k.alias("id2"), ring.alias("ring2"))


def tiles(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    return t.nation.select(k.alias("id"), box(-75 + F.floor(k / 5) * 0.4, 40 + (k % 5) * 0.4, F.lit(0.4), F.lit(0.4)).alias("ring"))


def zones_of_sites(t: Tables) -> DataFrame:
    return boxes(t).select(F.col("id2").cast("string").alias("zone"), F.col("ring2").alias("ring"))


def points(t: Tables) -> DataFrame:
    """Places moved off the lines of the grid."""
    return places(t).select("id", (F.col("lon") + 0.0007).alias("x"), (F.col("lat") + 0.0007).alias("y"))


def summed_places(t: Tables) -> DataFrame:
    """How many points each place has, and their weights: sums by zone need no more, so equal places meet the zones once."""
    return points(t).groupBy("x", "y").agg(F.count("*").alias("n"), F.sum(F.col("id") % 11).alias("v"))


HELD = f"(SELECT id, id2, w * h AS a FROM {PLACES} JOIN {BOXES} ON lon + 0.0007 > x0 AND lon + 0.0007 < x0 + w AND lat + 0.0007 > y0 AND lat + 0.0007 < y0 + h)"


@query(f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(a, 9), id2::VARCHAR) AS k FROM {HELD}) SELECT p.id, coalesce(id2::VARCHAR, 'remainder') AS zone FROM {PLACES} p LEFT JOIN k ON k.id = p.id AND k = 1""")
def smallest_polygon(t: Tables) -> DataFrame:
    """The smallest polygon that holds a point, else the remainder."""
    return geo.assign(points(t), [(rounded(zones_of_sites(t)), "site")], "id", "zone", 0.2).select("id", "zone")


def rounded(polygons: DataFrame) -> DataFrame:
    """Corners to nine places, so that equal sizes tie."""
    return polygons.withColumn("ring", F.transform("ring", lambda p: F.struct(F.round(p["x"], 9).alias("x"), F.round(p["y"], 9).alias("y"))))


@query(f"""WITH k AS (SELECT id, max(a) AS a FROM {HELD} WHERE id2 % 2 = 0 GROUP BY id), o AS (SELECT DISTINCT id FROM {HELD} WHERE id2 % 2 = 1)
SELECT p.id, CASE WHEN k.id IS NOT NULL THEN 'even' WHEN o.id IS NOT NULL THEN 'odd' ELSE 'none' END AS layer FROM {PLACES} p LEFT JOIN k USING (id) LEFT JOIN o USING (id)""")
def layered_assignment(t: Tables) -> DataFrame:
    """The largest polygon of the first layer, else of the second, else none."""
    z = rounded(zones_of_sites(t)).withColumn("n", F.col("zone").cast("long"))
    return geo.assign(points(t), [(z.filter("n % 2 = 0").drop("n"), "even"), (z.filter("n % 2 = 1").drop("n"), "odd")], "id", "zone", 0.2, largest=True).select("id", "layer")


SHARED = f"(SELECT t.id, b.id2, (least(t.x0 + t.w, b.x0 + b.w) - greatest(t.x0, b.x0)) * (least(t.y0 + t.h, b.y0 + b.h) - greatest(t.y0, b.y0)) AS a, b.w * b.h AS area2 FROM {TILES} t JOIN {BOXES} b ON t.x0 + t.w - b.x0 > 1e-7 AND b.x0 + b.w - t.x0 > 1e-7 AND t.y0 + t.h - b.y0 > 1e-7 AND b.y0 + b.h - t.y0 > 1e-7)"


@query(f"SELECT id, id2, round(a, 6) AS overlap, round(a / sum(a) OVER (PARTITION BY id2), 6) AS share FROM {SHARED}")
def overlay_shares(t: Tables) -> DataFrame:
    """Areas that polygons share, and each zone's share of the overlaid ones."""
    met = geo.overlaps(tiles(t), boxes(t), 0.4).filter("overlap > 1e-8")
    return rel.share_of_group(met, ["id2"], "overlap", "share").select("id", "id2", r("overlap").alias("overlap"), r("share").alias("share"))


@query(f"""WITH o AS (SELECT id, id2, a / area2 AS s, 10.0 + id2 % 7 AS n, CASE WHEN id2 % 3 > 0 THEN id2 * 1.0 END AS v FROM {SHARED})
SELECT id, round(sum(n * s), 5) AS n, round(sum(v * n * s) / sum(n * s) FILTER (WHERE v IS NOT NULL), 5) AS v, round(coalesce(sum(n * s) FILTER (WHERE v IS NOT NULL) / sum(n * s), 0), 5) AS v_coverage FROM o GROUP BY id""")
def areal_interpolation(t: Tables) -> DataFrame:
    """Sums and means of areas on the zones that overlap them."""
    met = geo.overlaps(tiles(t), boxes(t), 0.4).filter("overlap > 1e-8").withColumns({"share": F.col("overlap") / geo.area(F.col("ring2")), "n": 10.0 + F.col("id2") % 7, "v": F.when(F.col("id2") % 3 > 0, F.col("id2").cast("double"))})
    return geo.interpolated(met, "id", "share", ["n"], {"v": "n"}).select("id", *[r(c, 5).alias(c) for c in ("n", "v", "v_coverage")])


@query(f"""WITH l AS (SELECT p_partkey AS line, p_type AS class, -75.1 + (p_partkey * 13 % 100) / 50.0 AS a, 40.0003 + (p_partkey * 29 % 1000) / 500.0 AS y, 0.05 + (p_partkey % 9) * 0.1 AS n FROM part)
SELECT id, class, round(sum(least(a + n, x0 + w) - greatest(a, x0)), 6) AS length FROM l JOIN {TILES} ON y > y0 AND y < y0 + h AND a < x0 + w AND a + n > x0 GROUP BY ALL HAVING sum(least(a + n, x0 + w) - greatest(a, x0)) > 1e-6""")
def clipped_lines(t: Tables) -> DataFrame:
    """Length of lines within zones by class (C20). Lines meet the zones of the cells that they cross."""
    k = F.col("p_partkey")
    # A line and a zone meet in several cells: they are kept in the first column that both have, so no pair has to be found again.
    lines = t.part.select(k.alias("line"), F.col("p_type").alias("class"), (-75.1 + (k * 13 % 100) / 50.0).alias("x"), (40.0003 + (k * 29 % 1000) / 500.0).alias("y"), (0.05 + (k % 9) * 0.1).alias("n"))
    cell = lambda x: F.floor(x / 0.4).cast("long")
    spread = lines.withColumns({"from": cell(F.col("x")), "i": F.explode(F.sequence(cell(F.col("x")), cell(F.col("x") + F.col("n")))), "j": cell(F.col("y"))})
    corner = lambda c, k_: F.element_at(F.col("ring"), k_)[c]
    z = tiles(t).withColumn("from2", cell(corner("x", 1))).withColumn("i", F.explode(F.sequence(cell(corner("x", 1)), cell(corner("x", 3))))).withColumn("j", F.explode(F.sequence(cell(corner("y", 1)), cell(corner("y", 3)))))
    met = spread.join(z, ["i", "j"]).filter(F.col("i") == F.greatest("from", "from2"))
    length = geo.clipped_length(F.col("x"), F.col("y"), F.col("x") + F.col("n"), F.col("y"), F.col("ring"))
    return met.groupBy("id", "class").agg(F.sum(length).alias("length")).filter("length > 1e-6").select("id", "class", r("length").alias("length"))


@query(f"SELECT id, id2, round(km, 6) AS km FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), id2) AS k FROM (SELECT id, id2, {KM} AS km FROM {PLACES} JOIN {SITES} ON id % 5 = id2 % 5) WHERE km <= 60) WHERE k = 1")
def nearest_within_group(t: Tables) -> DataFrame:
    """The nearest of one's own group within a radius."""
    own = lambda df, c: df.withColumn("g", F.col(c) % 5)
    return nearest_places(own(places(t), "id"), own(sites(t), "id2"), 1, ["g"], within=60.0).select("id", "id2", r("km").alias("km"))


@query(f"SELECT id2 AS zone, count(*) AS pixels, sum(id % 11)::BIGINT AS mass FROM {HELD} GROUP BY id2")
def pixel_sums(t: Tables) -> DataFrame:
    """Pixels and their weights by the zone in which their centre lies."""
    held = geo.in_polygons(summed_places(t), zones_of_sites(t), 0.2)
    return held.groupBy(F.col("zone").cast("long").alias("zone")).agg(F.sum("n").alias("pixels"), F.sum("v").alias("mass"))


@query("""WITH k AS (SELECT user_id % 12 AS place, unnest(CASE event_type WHEN 'click' THEN ['seen', 'active'] WHEN 'purchase' THEN ['active', 'paid'] ELSE ['seen'] END) AS label FROM events)
SELECT place, count(*) FILTER (WHERE label = 'seen')::DOUBLE AS n_seen, count(*) FILTER (WHERE label = 'active')::DOUBLE AS n_active, count(*) FILTER (WHERE label = 'paid')::DOUBLE AS n_paid FROM k GROUP BY place""")
def multi_label_counts(t: Tables) -> DataFrame:
    """Several labels a row, a row a label, counts by label side by side."""
    labels = F.when(F.col("event_type") == "click", F.array(F.lit("seen"), F.lit("active"))).when(F.col("event_type") == "purchase", F.array(F.lit("active"), F.lit("paid"))).otherwise(F.array(F.lit("seen")))
    k = t.events.select((F.col("user_id") % 12).alias("place"), F.explode(labels).alias("label"), F.lit(1.0).alias("one"))
    return rel.pivot_fixed(k, ["place"], "label", ["seen", "active", "paid"], "one", "n_")


@query("""WITH k AS (SELECT event_type, CAST(ts AS DATE) AS day, user_id % 9 AS tract, count(*) AS n, sum(value) AS v FROM events GROUP BY ALL)
SELECT event_type, day, tract, round(n / sum(n) OVER w, 9) AS share, round(v / sum(v) OVER w, 9) AS value_share FROM k WINDOW w AS (PARTITION BY event_type, day)""")
def city_share_surface(t: Tables) -> DataFrame:
    """Counts by period, offense and unit over their totals, with the other bases' shares."""
    k = t.events.groupBy("event_type", F.to_date("ts").alias("day"), (F.col("user_id") % 9).alias("tract")).agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    s = rel.share_of_group(rel.share_of_group(k, ["event_type", "day"], "n", "share"), ["event_type", "day"], "v", "value_share")
    return s.select("event_type", "day", "tract", r("share", 9).alias("share"), r("value_share", 9).alias("value_share"))


@query(f"""WITH k AS (SELECT 0.0066943800229007869 AS e2, 0.081819191042815792 AS e), s AS (SELECT id, lon, sin(radians(lat)) AS s, e2, e FROM {PLACES} CROSS JOIN k), q AS (SELECT *, (1 - e2) * (s / (1 - e2 * s * s) - ln((1 - e * s) / (1 + e * s)) / (2 * e)) AS q FROM s),
n AS (SELECT q.*, 6378137.0 * sqrt(1.34918203156097 - 0.60290276906576 * q) / 0.60290276906576 AS rho, 0.60290276906576 * radians(lon + 96) AS th FROM q) SELECT id, round(rho * sin(th) / 1000, 6) AS x_km, round((9928937.00425 - rho * cos(th)) / 1000, 6) AS y_km FROM n""")
def projected_places(t: Tables) -> DataFrame:
    """Degrees to an equal-area plane."""
    x, y = geo.equal_area(F.col("lat"), F.col("lon"))
    return places(t).select("id", r(x / 1000).alias("x_km"), r(y / 1000).alias("y_km"))


@query(f"SELECT id, id2, round(km, 6) AS km, CAST(k AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), id2) AS k FROM (SELECT id, id2, {KM} AS km FROM {PLACES} CROSS JOIN {SITES})) WHERE k <= 2")
def nearest_anywhere(t: Tables) -> DataFrame:
    """The two nearest sites of every place, however far."""
    return nearest_places(places(t), sites(t), 2).select("id", "id2", r("km").alias("km"), "place")


@query(f"SELECT id, id2, round(km, 6) AS km FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), id2) AS k FROM (SELECT id, id2, {KM} AS km FROM {PLACES} JOIN {SITES} ON id % 5 = id2 % 5)) WHERE k = 1")
def nearest_of_group_anywhere(t: Tables) -> DataFrame:
    """The nearest site of one's own group, however far."""
    own = lambda df, c: df.withColumn("g", F.col(c) % 5)
    return nearest_places(own(places(t), "id"), own(sites(t), "id2"), 1, ["g"]).select("id", "id2", r("km").alias("km"))


# Tiles without their upper right corner, and boxes with a hole in the middle half: areas follow from boxes by inclusion and exclusion.
NOTCHED = f"(SELECT id, x0, y0, x0 + w AS x1, y0 + h AS y1, x0 + w * 0.6 AS p0, y0 + h * 0.6 AS q0, x0 + w AS p1, y0 + h AS q1 FROM {TILES})"
HOLED = f"(SELECT id2, x0, y0, x0 + w AS x1, y0 + h AS y1, x0 + w / 4 AS p0, y0 + h / 4 AS q0, x0 + w * 3 / 4 AS p1, y0 + h * 3 / 4 AS q1 FROM {BOXES})"


def common(a: str, b: str) -> str:
    """SQL for the area that two boxes share; each given as the names of its corners."""
    side = lambda low, high: f"greatest(0, least(t.{high[0]}, b.{high[1]}) - greatest(t.{low[0]}, b.{low[1]}))"
    x, y = {"box": ("x0", "x1"), "cut": ("p0", "p1")}, {"box": ("y0", "y1"), "cut": ("q0", "q1")}
    return f"{side((x[a][0], x[b][0]), (x[a][1], x[b][1]))} * {side((y[a][0], y[b][0]), (y[a][1], y[b][1]))}"


def ring(*corners: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])


def notched(t: Tables) -> DataFrame:
    """Concave tiles of one ring."""
    p = lambda i, c: F.element_at("ring", i)[c]
    x0, y0, x1, y1 = p(1, "x"), p(1, "y"), p(3, "x"), p(3, "y")
    x, y = x0 + F.lit(0.4) * 0.6, y0 + F.lit(0.4) * 0.6
    return tiles(t).select("id", F.array(ring((x0, y0), (x1, y0), (x1, y), (x, y), (x, y1), (x0, y1))).alias("rings"))


def holed(t: Tables) -> DataFrame:
    """Boxes with a hole; outer and inner rings run the same way."""
    p = lambda i, c: F.element_at("ring2", i)[c]
    x0, y0, w, h = p(1, "x"), p(1, "y"), p(3, "x") - p(1, "x"), p(3, "y") - p(1, "y")
    hole = ring((x0 + w / 4, y0 + h / 4), (x0 + w * 3 / 4, y0 + h / 4), (x0 + w * 3 / 4, y0 + h * 3 / 4), (x0 + w / 4, y0 + h * 3 / 4))
    return boxes(t).select("id2", F.array(F.col("ring2"), hole).alias("rings"))


@query(f"""SELECT * FROM (SELECT id, id2, round({common("box", "box")} - {common("cut", "box")} - {common("box", "cut")} + {common("cut", "cut")}, 8) AS overlap FROM {NOTCHED} t CROSS JOIN {HOLED} b) WHERE overlap > 1e-5""")
def overlay_of_shapes(t: Tables) -> DataFrame:
    """Areas that concave shapes and shapes with holes share."""
    met = shapes.overlay(shapes.covers(notched(t), "id"), shapes.covers(holed(t), "id2"))
    return met.select("id", "id2", r("overlap", 8).alias("overlap")).filter("overlap > 1e-5")


@query(f"SELECT id2, round((x1 - x0) * (y1 - y0) * 0.75, 9) AS area FROM {HOLED}")
def areas_of_shapes(t: Tables) -> DataFrame:
    """Areas of shapes with holes (I4)."""
    return shapes.areas(shapes.covers(holed(t), "id2"), "id2").select("id2", r("area", 9).alias("area"))


@query(f"""SELECT id2, count(*) AS n, sum(p.id % 11)::BIGINT AS mass FROM {PLACES} p JOIN {HOLED} b ON lon + 0.0007 > x0 AND lon + 0.0007 < x1 AND lat + 0.0007 > y0 AND lat + 0.0007 < y1
AND NOT (lon + 0.0007 > p0 AND lon + 0.0007 < p1 AND lat + 0.0007 > q0 AND lat + 0.0007 < q1) GROUP BY id2""")
def points_in_shapes(t: Tables) -> DataFrame:
    """Points in shapes with holes."""
    held = shapes.held_by(summed_places(t), Scratch(t.spark, "covers").keep(shapes.covers(holed(t), "id2"), "covers"))
    return held.groupBy("id2").agg(F.sum("n").alias("n"), F.sum("v").alias("mass"))


@query(f"""WITH h AS (SELECT p.id, id2, (x1 - x0) * (y1 - y0) AS a FROM {PLACES} p JOIN {HOLED} b ON lon + 0.0007 > x0 AND lon + 0.0007 < x1 AND lat + 0.0007 > y0 AND lat + 0.0007 < y1
AND NOT (lon + 0.0007 > p0 AND lon + 0.0007 < p1 AND lat + 0.0007 > q0 AND lat + 0.0007 < q1)), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(a, 9), id2::VARCHAR) AS k FROM h)
SELECT p.id, coalesce(id2::VARCHAR, 'remainder') AS zone FROM {PLACES} p LEFT JOIN k ON k.id = p.id AND k = 1""")
def smallest_shape(t: Tables) -> DataFrame:
    """The smallest shape with a hole that holds a point, else the remainder."""
    zones_ = holed(t).select(F.col("id2").cast("string").alias("zone"), "rings")
    return shapes.assign(points(t), [(zones_, "site")], "id", "zone").select("id", "zone")


@query(f"""WITH o AS (SELECT id, id2, ({common("box", "box")} - {common("cut", "box")} - {common("box", "cut")} + {common("cut", "cut")}) / ((b.x1 - b.x0) * (b.y1 - b.y0) * 0.75) AS s FROM {NOTCHED} t CROSS JOIN {HOLED} b)
SELECT id, round(sum((10.0 + id2 % 7) * s), 5) AS n, round(sum(id2 * (10.0 + id2 % 7) * s) / sum((10.0 + id2 % 7) * s), 5) AS v FROM o WHERE s > 1e-4 GROUP BY id""")
def interpolated_shapes(t: Tables) -> DataFrame:
    """Sums and means of shapes with holes on the concave ones that they overlap."""
    right = shapes.covers(holed(t), "id2")
    met = shapes.overlay(shapes.covers(notched(t), "id"), right).join(shapes.areas(right, "id2"), "id2")
    pairs = met.withColumns({"share": F.col("overlap") / F.col("area"), "n": 10.0 + F.col("id2") % 7, "v": F.col("id2").cast("double")}).filter("share > 1e-4")
    return geo.interpolated(pairs, "id", "share", ["n"], {"v": "n"}).select("id", r("n", 5).alias("n"), r("v", 5).alias("v"))


@query(f"""WITH l AS (SELECT p_partkey AS line, -75.1 + (p_partkey * 13 % 100) / 50.0 AS a, 40.0003 + (p_partkey * 29 % 1000) / 500.0 AS y, 0.05 + (p_partkey % 9) * 0.1 AS n FROM part),
c AS (SELECT id, greatest(0, least(a + n, x1) - greatest(a, x0)) * (y > y0 AND y < y1)::INT - greatest(0, least(a + n, p1) - greatest(a, p0)) * (y > q0 AND y < q1)::INT AS d FROM l JOIN {NOTCHED} ON y > y0 AND y < y1 AND a < x1 AND a + n > x0)
SELECT id, round(2 * sum(d), 6) AS length FROM c GROUP BY id HAVING sum(d) > 1e-6""")
def lines_in_shapes(t: Tables) -> DataFrame:
    """Length of lines that go there and back within concave shapes (C20)."""
    k = F.col("p_partkey")
    x, y, n = -75.1 + (k * 13 % 100) / 50.0, 40.0003 + (k * 29 % 1000) / 500.0, 0.05 + (k % 9) * 0.1
    lines = t.part.select(k.alias("line"), ring((x, y), (x + n, y), (x, y)).alias("path"))
    inside = shapes.lengths_inside(lines, shapes.covers(notched(t), "id"), "line", "id")
    return inside.groupBy("id").agg(r(F.sum("length")).alias("length"))
