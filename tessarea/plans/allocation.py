"""Remainders, overlap lanes, displacement, support and outlier screens on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.operators import allocation, expect, rel
from tessarea.plans.publish import CUST, PARTS, parts, units
from tessarea.plans.registry import CANDIDATES, Tables, candidates, query, r

SEGS = f"(SELECT nation, seg, sum(y)::DOUBLE AS y, sum(pop) AS pop, seg = 'BUILDING' AS residual, nation % 4 = 0 AS rare FROM {CUST} GROUP BY ALL)"


def segments(t: Tables) -> DataFrame:
    g = units(t).groupBy("nation", "seg").agg(F.sum("y").cast("double").alias("y"), F.sum("pop").alias("pop"))
    return g.withColumns({"residual": F.col("seg") == "BUILDING", "rare": F.col("nation") % 4 == 0})


@query(f"""SELECT nation, seg, least(greatest(y, 0), pop / 100) AS reported_part, least(greatest(y * 0.2, 0), pop / 100 - least(greatest(y, 0), pop / 100)) AS imputed_part,
  round(pop / 100 - least(greatest(y, 0), pop / 100) - least(greatest(y * 0.2, 0), pop / 100 - least(greatest(y, 0), pop / 100)), 9) AS adjustment_part FROM {SEGS}""")
def carve_out_parts(t: Tables) -> DataFrame:
    """A target as reported, imputed and adjusted parts, nothing counted twice."""
    s = segments(t).withColumns({"target": F.col("pop") / 100, "imputed": F.col("y") * 0.2})
    parts_ = allocation.carve_out("target", "y", "imputed")
    return s.select("nation", "seg", "target", *[x.alias(n) for n, x in parts_.items()]).select("nation", "seg", "reported_part", "imputed_part", r("adjustment_part", 9).alias("adjustment_part"))


FULL = f"(SELECT n_nationkey AS nation, s.seg, coalesce(y, 0) AS y, s.seg = 'BUILDING' AS residual, n_nationkey % 4 = 0 AS rare FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment AS seg FROM customer) s LEFT JOIN {SEGS} g ON g.nation = n_nationkey AND g.seg = s.seg)"


@query(f"""WITH e AS (SELECT *, CASE WHEN NOT residual AND (NOT rare OR y >= 20) THEN y WHEN NOT residual THEN 0 ELSE y END AS e FROM {FULL}), p AS (SELECT *, CASE WHEN NOT residual THEN coalesce(1000 * e / nullif(sum(e) OVER (PARTITION BY nation), 0), 0) END AS p FROM e)
SELECT nation, seg, round(CASE WHEN residual THEN 1000 - coalesce(sum(p) OVER (PARTITION BY nation), 0) ELSE p END, 6) AS part FROM p""")
def remainder_by_evidence(t: Tables) -> DataFrame:
    """A remainder among anchored groups by evidence, rare offenses only with enough of it, the rest on the residual (J8); then no group is overdrawn."""
    skeleton = t.nation.select(F.col("n_nationkey").alias("nation")).crossJoin(t.customer.select(F.col("c_mktsegment").alias("seg")).distinct())
    g = skeleton.join(segments(t).select("nation", "seg", "y"), ["nation", "seg"], "left").fillna({"y": 0.0}).withColumn("target", F.lit(1000.0))
    out = allocation.split_remainder(g, ["nation"], "target", "y", F.col("seg") != "BUILDING", F.col("nation") % 4 == 0, 20.0)
    allocation.targets_hold(out.withColumn("each", F.col("target") / 5), ["nation"], "each", "part")
    return out.select("nation", "seg", r("part").alias("part"))


@query(f"""WITH k AS (SELECT *, CASE WHEN cust % 5 = 0 THEN 'place' WHEN cust % 3 = 0 THEN 'county' WHEN cust % 2 = 0 THEN 'custom' ELSE 'statewide' END AS kind FROM {CUST}),
g AS (SELECT *, sum(pop) OVER (PARTITION BY nation, kind) AS s, sum(y) OVER (PARTITION BY nation, kind) AS e FROM k)
SELECT cust, CASE WHEN s <= 0 OR (nation % 4 = 0 AND e < 20) THEN CASE kind WHEN 'county' THEN 'statewide' WHEN 'place' THEN 'county' ELSE kind END ELSE kind END AS kind FROM g""")
def routed_and_demoted(t: Tables) -> DataFrame:
    """The kind of group by the first flag, then down where support or evidence is lacking."""
    u = units(t).withColumns({"is_place": F.col("cust") % 5 == 0, "is_county": F.col("cust") % 3 == 0, "is_custom": F.col("cust") % 2 == 0})
    kinds = u.withColumn("kind", allocation.route([("is_place", "place"), ("is_county", "county"), ("is_custom", "custom")], "statewide"))
    return allocation.demote(kinds, "kind", ["nation"], "pop", "y", F.col("nation") % 4 == 0, {"county": "statewide", "place": "county"}, 20.0).select("cust", "kind")


@query(f"""WITH t AS (SELECT 'place' AS kind, brand AS place, 10.0 AS n FROM (SELECT DISTINCT brand FROM {PARTS} WHERE q > 0) UNION ALL SELECT 'county', substr(brand, 7, 1), 100.0 FROM (SELECT DISTINCT brand FROM {PARTS} WHERE q > 0 AND size > 10)),
w AS (SELECT 'place' AS kind, brand AS place, part AS unit, q AS w FROM {PARTS} UNION ALL SELECT 'county', substr(brand, 7, 1), part, q FROM {PARTS} WHERE size > 10), s AS (SELECT *, w / sum(w) OVER (PARTITION BY kind, place) AS s FROM w)
SELECT unit, kind AS lane, round(sum(n * s), 6) AS count FROM s JOIN t USING (kind, place) WHERE s > 0 GROUP BY ALL""")
def overlap_lanes(t: Tables) -> DataFrame:
    """Targets of places and counties on their units."""
    p = parts(t).withColumn("digit", F.substring("brand", 7, 1))
    some = p.filter("q > 0")
    targets = some.select(F.lit("place").alias("kind"), F.col("brand").alias("place")).distinct().withColumn("n", F.lit(10.0))
    targets = targets.unionByName(some.filter("size > 10").select("brand", "digit").distinct().select(F.lit("county").alias("kind"), F.col("digit").alias("place"), F.lit(100.0).alias("n")))
    out = allocation.overlap_lanes(targets, p, {"place": ("brand", F.lit(True)), "county": ("digit", F.col("size") > 10)}, "q", "part", "n")
    return out.select("unit", "lane", r("count").alias("count"))


@query(f"""WITH b AS (SELECT *, CASE WHEN brand < 'Brand#2' THEN q * price ELSE price END AS v FROM {PARTS}) SELECT part, brand, round(v / sum(v) OVER (PARTITION BY brand), 9) AS share FROM b WHERE brand IN (SELECT brand FROM {PARTS} GROUP BY brand HAVING sum(q) > 0)""")
def declared_basis_shares(t: Tables) -> DataFrame:
    """Footprint shares by the basis that is declared."""
    p = parts(t).withColumn("basis", F.when(F.col("brand") < "Brand#2", "activity").otherwise("verbatim"))
    live = rel.members(p, p.groupBy("brand").agg(F.sum("q").alias("s")).filter("s > 0"), ["brand"])
    return allocation.footprint_shares(live, ["brand"], "basis", "q", "price").select("part", "brand", r("share", 9).alias("share"))


@query(f"""WITH s AS (SELECT part, brand, price / sum(price) OVER (PARTITION BY brand) AS s FROM {PARTS}), c AS (SELECT l_partkey AS part, max(l_discount * 8) AS c FROM lineitem WHERE l_suppkey % 10 <> 0 AND l_linenumber <= 2 GROUP BY ALL),
x AS (SELECT s.part, brand, s * (1 - least(coalesce(c, 0), 1)) AS v FROM s LEFT JOIN c USING (part)) SELECT part, brand, round(v / sum(v) OVER (PARTITION BY brand), 9) AS share FROM x WHERE v > 0""")
def displaced_shares(t: Tables) -> DataFrame:
    """Covers displace by their maximum; carved-out ones don't, and no group may lose all."""
    s = rel.share_of_group(parts(t), ["brand"], "price", "share").select("part", "brand", "share")
    covers = t.lineitem.filter("l_linenumber <= 2").select(F.col("l_partkey").alias("part"), (F.col("l_discount") * 8).alias("cover"), "l_suppkey")
    return allocation.displace(s, covers, ["brand"], "part", "share", "cover", F.col("l_suppkey") % 10 == 0).select("part", "brand", r("share", 9).alias("share"))


@query("""WITH s AS (SELECT s_suppkey AS who, s_nationkey AS unit FROM supplier), c AS (SELECT s_suppkey AS who, n_nationkey AS unit FROM supplier JOIN nation ON n_regionkey = s_suppkey % 5 WHERE s_suppkey % 4 = 0)
SELECT who, unit FROM s WHERE who % 4 <> 0 UNION SELECT who, unit FROM c WHERE unit % 6 <> 0""")
def consolidated_footprints(t: Tables) -> DataFrame:
    """Principals that take over a county hold it but for excluded places."""
    s = t.supplier.select(F.col("s_suppkey").alias("who"), F.col("s_nationkey").alias("unit"))
    county = s.filter("who % 4 = 0").join(t.nation, F.col("n_regionkey") == F.col("who") % 5).select("who", F.col("n_nationkey").alias("unit"))
    return allocation.consolidated(s, county, county.filter("unit % 6 = 0"), "who", "unit")


@query(f"""WITH p AS (SELECT part, brand, q, CASE WHEN size > 20 THEN price ELSE 0 END AS d FROM {PARTS}), g AS (SELECT *, sum(CASE WHEN d > 0 THEN 0 ELSE q END) OVER w AS m, sum(CASE WHEN d > 0 THEN q ELSE 0 END) OVER w AS c, sum(CASE WHEN d > 0 THEN d ELSE 0 END) OVER w AS dd FROM p WINDOW w AS (PARTITION BY brand))
SELECT part, brand, round(CASE WHEN d > 0 THEN q + m * CASE WHEN c > 0 THEN q / c ELSE d / dd END WHEN dd > 0 THEN 0 ELSE q END, 6) AS q FROM g""")
def moved_from_empty(t: Tables) -> DataFrame:
    """Mass on units without a denominator goes to those with one."""
    p = parts(t).withColumn("d", F.when(F.col("size") > 20, F.col("price")).otherwise(0.0))
    return allocation.move_from_empty(p, ["brand"], "q", "d").select("part", "brand", r("q").alias("q"))


@query(f"""SELECT cust, coalesce(sum(n) FILTER (WHERE prio = '1-URGENT'), 0)::DOUBLE AS n_urgent, coalesce(sum(n) FILTER (WHERE prio = '5-LOW'), 0)::DOUBLE AS n_low FROM (SELECT cust, prio, sum(n) AS n FROM {CANDIDATES} GROUP BY ALL) GROUP BY cust""")
def components_to_wide(t: Tables) -> DataFrame:
    """Components summed, then side by side."""
    sums = candidates(t).groupBy("cust", F.when(F.col("prio") == "1-URGENT", "urgent").when(F.col("prio") == "5-LOW", "low").alias("prio")).agg(F.sum("n").cast("double").alias("n"))
    return rel.pivot_fixed(sums, ["cust"], "prio", ["urgent", "low"], "n", "n_")


@query(f"""WITH h AS (SELECT cust, prio, min(yr) AS a, max(yr) AS b, sum(n) FILTER (WHERE lane = 'F') AS n FROM {CANDIDATES} GROUP BY ALL)
SELECT cust, CASE WHEN max(n) FILTER (WHERE prio = '1-URGENT') > 0 THEN 'observed' WHEN count(*) FILTER (WHERE prio = '1-URGENT') > 0 THEN 'covered' ELSE 'model_only' END AS urgent_support,
  max(a) FILTER (WHERE prio = '1-URGENT') AS urgent_first, max(b) FILTER (WHERE prio = '1-URGENT') AS urgent_last, coalesce(max(n) FILTER (WHERE prio = '1-URGENT'), 0)::BIGINT AS urgent_count FROM h GROUP BY cust""")
def direct_support(t: Tables) -> DataFrame:
    """Where counts are observed, covered or modelled only."""
    c = candidates(t)
    return allocation.direct_support(c, c.filter("lane = 'F'"), "cust", "prio", {"1-URGENT": "urgent"}, "yr", "n")


@query(f"""WITH s AS (SELECT cust, sum(n) AS a, sum(n) FILTER (WHERE lane = 'F') AS d FROM {CANDIDATES} GROUP BY cust) SELECT cust, round(coalesce(d, 0) / a, 9) AS direct_share, CASE WHEN coalesce(d, 0) / a >= 0.6 THEN 'direct' WHEN 1 - coalesce(d, 0) / a >= 0.6 THEN 'modeled' ELSE 'mixed' END AS mode_mix FROM s""")
def source_mode_mix(t: Tables) -> DataFrame:
    """Whether a unit's mass is direct, modelled or mixed."""
    out = allocation.mode_mix(candidates(t), ["cust"], "lane", "n", "F")
    return out.withColumn("direct_share", r("direct_share", 9))


@query(f"""SELECT part, brand, CASE WHEN brand < 'Brand#3' THEN NULL ELSE q END AS unit_count, round(sum(q) OVER (PARTITION BY brand) * price / sum(price) OVER (PARTITION BY brand), 6) AS parent_count FROM {PARTS}""")
def rare_policy(t: Tables) -> DataFrame:
    """Rare offenses are published for the parent alone, whose count is spread by exposure."""
    out = rel.with_totals(parts(t), ["brand"], tq=F.sum("q"), tp=F.sum("price"))
    return out.select("part", "brand", F.when(F.col("brand") >= "Brand#3", F.col("q")).alias("unit_count"), r(F.col("tq") * F.col("price") / F.col("tp")).alias("parent_count"))


@query(f"""WITH t AS (SELECT 'q' AS screen, part, q AS x, row_number() OVER (ORDER BY q DESC, part) AS k FROM {PARTS} UNION ALL SELECT 'ratio', part, q / price, row_number() OVER (ORDER BY q / price DESC, part) FROM {PARTS} WHERE q / price > 0.1)
SELECT screen, part, round(x, 9) AS x FROM t WHERE k <= 5""")
def outlier_screens(t: Tables) -> DataFrame:
    """The largest by each screen; a screen whose column is all NULL is left out."""
    p = parts(t).withColumns({"ratio": F.when(F.col("q") / F.col("price") > 0.1, F.col("q") / F.col("price")), "nothing": F.lit(None).cast("double")})
    return rel.largest(p, ["q", "ratio", "nothing"], "part", 5).select("screen", "part", r("x", 9).alias("x"))


@query(f"""WITH b AS (SELECT cust FROM {CUST} ORDER BY pop DESC, cust LIMIT 40) SELECT b.cust, o.prio FROM b CROSS JOIN (SELECT DISTINCT o_orderpriority AS prio FROM orders) o
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = b.cust AND o_orderpriority = o.prio)""")
def expected_keys(t: Tables) -> DataFrame:
    """What the largest units lack."""
    top = units(t).orderBy(F.desc("pop"), "cust").limit(40).select("cust")
    every = top.crossJoin(t.orders.select(F.col("o_orderpriority").alias("prio")).distinct())
    return rel.members(every, t.orders.select(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("prio")), ["cust", "prio"], inside=False)


@query("SELECT DISTINCT CASE WHEN event_type = 'purchase' THEN event_type || ':' || event_id || ':' || user_id ELSE event_type || ':' || coalesce(nullif(trim(CASE WHEN user_id % 2 = 0 THEN ' ' ELSE user_id::VARCHAR END), ''), 'e' || event_id % 50) END AS identity FROM events")
def offense_identity(t: Tables) -> DataFrame:
    """Identity by victim for some offenses, by the first id that isn't blank for others."""
    blank = F.when(F.col("user_id") % 2 == 0, " ").otherwise(F.col("user_id").cast("string"))
    event = F.coalesce(F.nullif(F.trim(blank), F.lit("")), F.concat(F.lit("e"), (F.col("event_id") % 50).cast("string")))
    key = F.when(F.col("event_type") == "purchase", F.concat_ws(":", "event_type", "event_id", "user_id")).otherwise(F.concat_ws(":", "event_type", event))
    return t.events.select(key.alias("identity")).distinct()


@query(f"SELECT brand, count(*) AS n FROM {PARTS} GROUP BY brand")
def checked_vocabulary(t: Tables) -> DataFrame:
    """Parents with all of their vocabulary, references, lanes and residuals checked (L)."""
    p, c = parts(t), candidates(t)
    expect.referential(c, t.customer.select(F.col("c_custkey").alias("cust")), ["cust"])
    expect.vocabulary(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])
    expect.exclusive(p, ["part"], "brand")
    # What the parts of a brand hold is what its order lines hold, summed another way.
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("brand")).agg(F.sum("l_quantity").cast("double").alias("residual"))
    expect.within_residual(p.join(lines, "brand"), ["brand"], "q", "residual")
    expect.count_is(t.region, F.col("r_regionkey") >= 0, 5)
    return p.groupBy("brand").agg(F.count("*").alias("n"))
