"""Shares, raking, rates, indices, tiers, suppression and distribution statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.functions import case_first, clip, ratio
from tessarea.operators import distributed, rel
from tessarea.plans.registry import Tables, query, r

PARTS = "(SELECT p_partkey AS part, p_brand AS brand, p_size AS size, p_retailprice AS price, coalesce(q, 0) AS q, coalesce(k, 0) AS k FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q, count(*) AS k FROM lineitem GROUP BY ALL) ON l_partkey = p_partkey)"


def parts(t: Tables) -> DataFrame:
    """Units (parts) within parents (brands), with mass."""
    q = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("q"), F.count("*").alias("k"))
    rows = t.part.join(q, "p_partkey", "left")
    return rows.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"), F.coalesce("q", F.lit(0.0)).alias("q"), F.coalesce("k", F.lit(0)).alias("k"))


CUST = """(SELECT c_custkey AS cust, c_nationkey AS nation, c_mktsegment AS seg, 1000.0 + c_custkey % 977 AS pop, coalesce(y, 0) AS y FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS y FROM orders GROUP BY ALL) ON o_custkey = c_custkey)"""


def units(t: Tables) -> DataFrame:
    """Units (customers) with an exposure and a count."""
    y = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("y"))
    return t.customer.join(y, "c_custkey", "left").select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg"), (1000.0 + F.col("c_custkey") % 977).alias("pop"), F.coalesce("y", F.lit(0)).alias("y"))


@query(f"SELECT part, brand, round(q / sum(q) OVER (PARTITION BY brand), 9) AS share FROM {PARTS}")
def share_of_group(t: Tables) -> DataFrame:
    """x over its group's sum, with fallbacks."""
    return rel.share_of_group(parts(t), ["brand"], "q", "share", "size").select("part", "brand", r("share", 9).alias("share"))


@query(f"""WITH p AS (SELECT *, CASE WHEN sum(q) FILTER (WHERE size > 25) OVER (PARTITION BY brand) > 0 THEN CASE WHEN size > 25 THEN q ELSE 0 END WHEN sum(q) OVER (PARTITION BY brand) > 0 THEN q ELSE 1 END AS base FROM {PARTS}),
s AS (SELECT *, base / sum(base) OVER (PARTITION BY brand) AS s0 FROM p), f AS (SELECT *, CASE WHEN s0 < 0.02 AND max(s0) OVER (PARTITION BY brand) >= 0.02 THEN 0 ELSE s0 END AS s1 FROM s)
SELECT part, brand, round(s1 / sum(s1) OVER (PARTITION BY brand), 9) AS share FROM f""")
def share_basis_ladder_floor(t: Tables) -> DataFrame:
    """One basis per parent, slivers under 2 % to zero unless all are slivers, then renormalised."""
    large = F.when(F.col("size") > 25, F.col("q")).otherwise(0.0)
    shares = rel.basis_shares(parts(t).withColumn("large", large), ["brand"], ["large", "q"], "share", 0.02)
    return shares.select("part", "brand", r("share", 9).alias("share"))


@query(f"WITH c AS (SELECT brand, sum(price) AS target FROM {PARTS} GROUP BY brand) SELECT part, brand, round(target * q / sum(q) OVER (PARTITION BY brand), 6) AS v FROM {PARTS} JOIN c USING (brand)")
def rake_to_control(t: Tables) -> DataFrame:
    """Control times share."""
    out = rel.with_totals(parts(t), ["brand"], target=F.sum("price"), mass=F.sum("q"))
    return out.select("part", "brand", r(F.col("target") * F.col("q") / F.col("mass")).alias("v"))


@query(f"""WITH s AS (SELECT *, q / sum(q) OVER (PARTITION BY brand) AS s FROM {PARTS}), e AS (SELECT *, s * exp(least(greatest(0.5 * (size - 25) / 10.0, -50), 50)) AS x FROM s)
SELECT part, brand, round(x / sum(x) OVER (PARTITION BY brand), 9) AS share FROM e""")
def tempered_share(t: Tables) -> DataFrame:
    """share x exp(clip(tau eta)), renormalised."""
    s = rel.share_of_group(parts(t), ["brand"], "q", "s").withColumn("x", F.col("s") * F.exp(clip(0.5 * (F.col("size") - 25) / 10.0, -50.0, 50.0)))
    return rel.share_of_group(s, ["brand"], "x", "share").select("part", "brand", r("share", 9).alias("share"))


@query(f"""WITH g AS (SELECT *, q / sum(q) OVER (PARTITION BY brand) AS prior, sum(k) OVER (PARTITION BY brand) AS n, sum(price) OVER (PARTITION BY brand) AS control, sum(q) OVER (PARTITION BY brand) AS feed FROM {PARTS}),
a AS (SELECT *, exp(-abs(ln(feed / control))) * (1 - 25.0 / (n + 25)) AS p FROM g), b AS (SELECT *, greatest(least(1 - p, 0.999) / greatest(p, 0.001) * n, 0.001) AS alpha FROM a)
SELECT part, brand, round((k + alpha * prior) / (n + alpha), 9) AS share FROM b""")
def posterior_blend(t: Tables) -> DataFrame:
    """Counts blended with a prior whose weight grows with the mismatch of feed and control."""
    g = rel.with_totals(rel.share_of_group(parts(t), ["brand"], "q", "prior"), ["brand"], n=F.sum("k"), control=F.sum("price"), feed=F.sum("q"))
    trust = F.exp(-F.abs(F.log(F.col("feed") / F.col("control")))) * (1 - 25.0 / (F.col("n") + 25))
    alpha = F.greatest(F.least(1 - trust, F.lit(0.999)) / F.greatest(trust, F.lit(0.001)) * F.col("n"), F.lit(0.001))
    return g.withColumn("alpha", alpha).select("part", "brand", r((F.col("k") + F.col("alpha") * F.col("prior")) / (F.col("n") + F.col("alpha")), 9).alias("share"))


@query(f"""WITH g AS (SELECT nation, seg, sum(y) AS y, sum(pop) AS pop FROM {CUST} GROUP BY ALL), s AS (SELECT *, round(y * 1.0 / sum(y) OVER (PARTITION BY nation), 6) AS s, row_number() OVER (PARTITION BY nation ORDER BY y DESC, seg) AS k FROM g)
SELECT nation, seg, round(s + CASE WHEN k = 1 THEN 1 - sum(s) OVER (PARTITION BY nation) ELSE 0 END, 6)::DOUBLE AS share FROM s""")
def remainder_split_plug(t: Tables) -> DataFrame:
    """Rounded shares, the residual added to the largest row."""
    g = units(t).groupBy("nation", "seg").agg(F.sum("y").alias("y"))
    return rel.plug_residual(rel.share_of_group(g, ["nation"], "y", "share"), ["nation"], "share", [F.desc("y"), F.asc("seg")]).select("nation", "seg", "share")


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, max(l_discount * 8) AS cover FROM lineitem GROUP BY ALL) SELECT l_suppkey, round(greatest(0, 1 - max(cover)), 6) AS keep, count(*) AS k FROM c GROUP BY l_suppkey""")
def displacement_max_union(t: Tables) -> DataFrame:
    """Overlapping covers displace by their maximum, not their sum."""
    c = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.max(F.col("l_discount") * 8).alias("cover"))
    return c.groupBy("l_suppkey").agg(r(F.greatest(F.lit(0.0), 1 - F.max("cover"))).alias("keep"), F.count("*").alias("k"))


@query(f"""WITH b AS (SELECT brand, sum(q) AS total FROM {PARTS} GROUP BY brand) SELECT part, brand, round(total * coalesce(nullif(price, 0) / sum(price) OVER (PARTITION BY brand), 0), 6) AS v FROM {PARTS} JOIN b USING (brand)""")
def rollup_then_redistribute(t: Tables) -> DataFrame:
    """Up to the parent, then down by another weight; the mass stays (J17, J18). One aggregate does both."""
    out = rel.with_totals(parts(t), ["brand"], mass=F.sum("q"), weight=F.sum("price"))
    return out.select("part", "brand", r(F.col("mass") * F.coalesce(ratio("price", "weight"), F.lit(0.0))).alias("v"))


@query(f"SELECT cust, round(1e5 * y / pop, 6) AS rate, round(100 * (1e5 * y / pop) / (1e5 * sum(y) OVER () / sum(pop) OVER ()), 6) AS idx FROM {CUST}")
def rate_index_national(t: Tables) -> DataFrame:
    """Rate per 100,000 and index to the national rate (K1). The national rate is a one-row aggregate, not a window over all."""
    u = units(t)
    national = u.agg((1e5 * F.sum("y") / F.sum("pop")).alias("national"))
    rate = 1e5 * F.col("y") / F.col("pop")
    return u.crossJoin(F.broadcast(national)).select("cust", r(rate).alias("rate"), r(100 * rate / F.col("national")).alias("idx"))


@query(f"""WITH u AS (SELECT *, sum(y) OVER (PARTITION BY nation) AS ny, sum(pop) OVER (PARTITION BY nation) AS np, sum(y) OVER () AS ty, sum(pop) OVER () AS tp FROM {CUST}),
s AS (SELECT *, ((ny - y) + 5000 * ((ty - y) / (tp - pop))) / ((np - pop) + 5000) AS rs FROM u) SELECT cust, round(1e5 * (y + 2000 * rs) / (pop + 2000), 6) AS rate FROM s""")
def loo_hierarchical_eb(t: Tables) -> DataFrame:
    """Each unit is shrunk to its state's rate without itself, and that to the national one without it (K4)."""
    u = units(t)
    total = u.agg(F.sum("y").alias("ty"), F.sum("pop").alias("tp"))
    x = rel.with_totals(u, ["nation"], ny=F.sum("y"), np=F.sum("pop")).crossJoin(F.broadcast(total))
    rs = ((F.col("ny") - F.col("y")) + 5000 * ((F.col("ty") - F.col("y")) / (F.col("tp") - F.col("pop")))) / ((F.col("np") - F.col("pop")) + 5000)
    return x.select("cust", r(1e5 * (F.col("y") + 2000 * rs) / (F.col("pop") + 2000)).alias("rate"))


WIDE = """(SELECT c_nationkey AS nation, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS b, sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS c FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def wide(t: Tables) -> DataFrame:
    x = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation"))
    return x.agg(*[F.count_if(F.col("o_orderpriority") == p).alias(n) for n, p in (("a", "1-URGENT"), ("b", "2-HIGH"), ("c", "3-MEDIUM"))])


@query(f"SELECT nation, round(CASE WHEN nation % 6 <> 2 THEN (0.5 * a + 0.3 * b + 0.2 * c) / 1.0 END, 6)::DOUBLE AS composite FROM {WIDE}")
def composite_all_or_null(t: Tables) -> DataFrame:
    """Weighted composite, NULL if a component is (K5, K8)."""
    a = F.when(F.col("nation") % 6 != 2, F.col("a"))
    return wide(t).select("nation", r(0.5 * a + 0.3 * F.col("b") + 0.2 * F.col("c")).alias("composite"))


@query(f"WITH w AS (SELECT 10.0 * sum(a) / sum(a + b + c) AS wa, 3.0 * sum(b) / sum(a + b + c) AS wb, 1.0 * sum(c) / sum(a + b + c) AS wc FROM {WIDE}) SELECT nation, round(a * wa + b * wb + c * wc, 6)::DOUBLE AS harm FROM {WIDE} CROSS JOIN w")
def harm_weighted_index(t: Tables) -> DataFrame:
    """Harm times national weight times count (K6, K7)."""
    x = wide(t)
    all_ = F.sum(F.col("a") + F.col("b") + F.col("c"))
    w = x.agg((10.0 * F.sum("a") / all_).alias("wa"), (3.0 * F.sum("b") / all_).alias("wb"), (1.0 * F.sum("c") / all_).alias("wc"))
    return x.crossJoin(F.broadcast(w)).select("nation", r(F.col("a") * F.col("wa") + F.col("b") * F.col("wb") + F.col("c") * F.col("wc")).alias("harm"))


@query(f"SELECT cust, CASE WHEN y = 0 THEN 'no_events' WHEN pop < 1100 THEN 'small_base' WHEN y < 4 THEN 'few_events' WHEN 1e5 * y / pop > 1500 THEN 'extreme' END AS reason, NOT (y = 0 OR pop < 1100 OR y < 4 OR 1e5 * y / pop > 1500) AS shown FROM {CUST}")
def suppression_precedence(t: Tables) -> DataFrame:
    """The first reason that holds (K9)."""
    reason = case_first([(F.col("y") == 0, "no_events"), (F.col("pop") < 1100, "small_base"), (F.col("y") < 4, "few_events"), (1e5 * F.col("y") / F.col("pop") > 1500, "extreme")])
    return units(t).select("cust", reason.alias("reason"), reason.isNull().alias("shown"))


@query(f"SELECT cust, CASE WHEN y < 6 THEN 'low' WHEN y >= 14 AND 2 * 1.96 / sqrt(y) < 1.0 THEN 'high' WHEN y >= 9 THEN 'medium' ELSE 'low' END AS tier FROM {CUST}")
def reliability_tier(t: Tables) -> DataFrame:
    """Tier by support and width of the interval, low before high before medium."""
    width = 2 * 1.96 / F.sqrt("y")
    return units(t).select("cust", case_first([(F.col("y") < 6, "low"), ((F.col("y") >= 14) & (width < 1.0), "high"), (F.col("y") >= 9, "medium")], "low").alias("tier"))


@query(f"SELECT cust, array_to_string(list_filter([CASE WHEN y < 6 THEN 'few' END, CASE WHEN pop < 1200 THEN 'small' END, CASE WHEN nation < 5 THEN 'border' END], lambda x: x IS NOT NULL), '|') AS reasons FROM {CUST}")
def reason_string(t: Tables) -> DataFrame:
    """All reasons that hold, joined."""
    return units(t).select("cust", F.concat_ws("|", F.when(F.col("y") < 6, "few"), F.when(F.col("pop") < 1200, "small"), F.when(F.col("nation") < 5, "border")).alias("reasons"))


@query(f"SELECT q AS quintile, count(*) AS n, round(avg(y), 6) AS mean_y FROM (SELECT y, ntile(5) OVER (PARTITION BY seg ORDER BY pop, cust) AS q FROM {CUST}) GROUP BY q")
def quintile_gradient(t: Tables) -> DataFrame:
    """Means by fifths of the exposure within strata."""
    return distributed.buckets(units(t), ["pop", "cust"], 5, "quintile", ["seg"]).groupBy("quintile").agg(F.count("*").alias("n"), r(F.avg("y")).alias("mean_y"))


@query(f"""WITH g AS (SELECT nation, pop AS x, sum(y + 1) AS w FROM {CUST} GROUP BY ALL), c AS (SELECT *, (sum(w) OVER (PARTITION BY nation ORDER BY x) - w / 2.0) / sum(w) OVER (PARTITION BY nation) AS p FROM g),
b AS (SELECT nation, max(p) FILTER (WHERE p <= 0.5) AS p0, arg_max(x, p) FILTER (WHERE p <= 0.5) AS x0, min(p) FILTER (WHERE p > 0.5) AS p1, arg_min(x, p) FILTER (WHERE p > 0.5) AS x1 FROM c GROUP BY nation)
SELECT nation, round(CASE WHEN p0 IS NULL THEN x1 WHEN p1 IS NULL THEN x0 ELSE x0 + (x1 - x0) * (0.5 - p0) / (p1 - p0) END, 6)::DOUBLE AS median FROM b""")
def weighted_quantile(t: Tables) -> DataFrame:
    """Midpoint distribution function with linear interpolation."""
    w = Window.partitionBy("nation")
    g = units(t).groupBy("nation", F.col("pop").alias("x")).agg(F.sum(F.col("y") + 1).alias("w"))
    c = g.withColumn("p", (F.sum("w").over(w.orderBy("x")) - F.col("w") / 2.0) / F.sum("w").over(w))
    low, high = F.when(F.col("p") <= 0.5, F.col("p")), F.when(F.col("p") > 0.5, F.col("p"))
    b = c.groupBy("nation").agg(F.max(low).alias("p0"), F.max_by("x", low).alias("x0"), F.min(high).alias("p1"), F.min_by("x", high).alias("x1"))
    value = F.when(F.col("p0").isNull(), F.col("x1")).when(F.col("p1").isNull(), F.col("x0")).otherwise(F.col("x0") + (F.col("x1") - F.col("x0")) * (0.5 - F.col("p0")) / (F.col("p1") - F.col("p0")))
    return b.select("nation", r(value).alias("median"))


@query(f"SELECT part, brand, round(q / nullif(m, 0), 6) AS ratio FROM (SELECT *, median(q) OVER (PARTITION BY brand) AS m FROM {PARTS}) WHERE q / nullif(m, 0) > 1.5")
def group_median_outlier(t: Tables) -> DataFrame:
    """Units far above their group's median."""
    p = parts(t)
    medians = distributed.quantiles(p, ["brand"], "q", [0.5], ["median"])
    x = p.join(medians, "brand").withColumn("ratio", ratio("q", "median"))
    return x.filter("ratio > 1.5").select("part", "brand", r("ratio").alias("ratio"))


@query(f"SELECT nation, round(sum(CASE WHEN y > 8 THEN pop ELSE 0 END) / sum(pop), 6)::DOUBLE AS over_8, round(sum(CASE WHEN y > 12 THEN pop ELSE 0 END) / sum(pop), 6)::DOUBLE AS over_12, round(sum(CASE WHEN y > 16 THEN pop ELSE 0 END) / sum(pop), 6)::DOUBLE AS over_16 FROM {CUST} GROUP BY nation")
def share_above_breaks(t: Tables) -> DataFrame:
    """Share of the exposure above each break."""
    return units(t).groupBy("nation").agg(*[r(F.sum(F.when(F.col("y") > b, F.col("pop")).otherwise(0.0)) / F.sum("pop")).alias(f"over_{b}") for b in (8, 12, 16)])


@query(f"SELECT code, code & 2 > 0 AS outlier, count(*) AS n FROM (SELECT CAST((CASE WHEN y < 6 THEN 1 ELSE 0 END) + (CASE WHEN pop > 1900 THEN 2 ELSE 0 END) AS INTEGER) AS code FROM {CUST}) GROUP BY ALL")
def bitflag_classes(t: Tables) -> DataFrame:
    """Two flags in one code, tested by its bits."""
    code = F.when(F.col("y") < 6, 1).otherwise(0) + F.when(F.col("pop") > 1900, 2).otherwise(0)
    return units(t).groupBy(code.alias("code")).agg(F.count("*").alias("n")).select("code", (F.col("code").bitwiseAND(2) > 0).alias("outlier"), "n")


@query(f"""WITH s AS (SELECT part, brand, q / sum(q) OVER (PARTITION BY brand) AS s, price / sum(price) OVER (PARTITION BY brand) AS m FROM {PARTS}) SELECT brand, round(0.5 * sum(abs(s - m)), 9) AS tvd FROM s GROUP BY brand""")
def tvd_by_group(t: Tables) -> DataFrame:
    """Total variation distance of two share vectors."""
    s = rel.share_of_group(rel.share_of_group(parts(t), ["brand"], "q", "s"), ["brand"], "price", "m")
    return s.groupBy("brand").agg(r(0.5 * F.sum(F.abs(F.col("s") - F.col("m"))), 9).alias("tvd"))


@query(f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY q DESC, part) AS pos, count(*) OVER (PARTITION BY brand) AS n FROM {PARTS}) SELECT brand, round(sum(CASE WHEN pos <= ceil(n * 0.1) THEN q ELSE 0 END) / sum(q), 9) AS captured FROM s GROUP BY brand""")
def top_fraction_capture(t: Tables) -> DataFrame:
    """Mass in the top tenth of units."""
    p = parts(t).withColumn("less", -F.col("q"))
    s = rel.with_totals(distributed.positions(p, ["less", "part"], "pos", ["brand"]), ["brand"], n=F.count("*"))
    return s.groupBy("brand").agg(r(F.sum(F.when(F.col("pos") < F.ceil(F.col("n") * 0.1), F.col("q")).otherwise(0.0)) / F.sum("q"), 9).alias("captured"))


@query(f"SELECT decile, count(*) AS n, round(avg(size), 6) AS predicted, round(avg(q), 6) AS observed FROM (SELECT *, ntile(10) OVER (PARTITION BY brand ORDER BY size, part) AS decile FROM {PARTS}) GROUP BY decile")
def decile_calibration(t: Tables) -> DataFrame:
    """Predicted and observed means by tenth within groups."""
    return distributed.buckets(parts(t), ["size", "part"], 10, "decile", ["brand"]).groupBy("decile").agg(F.count("*").alias("n"), r(F.avg("size")).alias("predicted"), r(F.avg("q")).alias("observed"))


@query(f"""WITH k AS (SELECT brand, rank() OVER (PARTITION BY brand ORDER BY size) + (count(*) OVER (PARTITION BY brand, size) - 1) / 2.0 AS a, rank() OVER (PARTITION BY brand ORDER BY k) + (count(*) OVER (PARTITION BY brand, k) - 1) / 2.0 AS b FROM {PARTS})
SELECT brand, round(corr(a, b), 6) AS rho FROM k GROUP BY brand""")
def spearman_tie_avg(t: Tables) -> DataFrame:
    """Rank correlation with average ranks for ties."""
    out = distributed.average_ranks(distributed.average_ranks(parts(t), "size", "a", ["brand"]), "k", "b", ["brand"])
    return out.groupBy("brand").agg(r(F.corr("a", "b")).alias("rho"))


@query(f"""WITH m AS (SELECT seg, count(*) AS n, avg(y) AS g FROM {CUST} GROUP BY seg), u AS (SELECT avg(y) AS a, var_pop(y) * count(*) AS total FROM {CUST}) SELECT round(sum(n * (g - a) * (g - a)) / max(total), 9) AS eta2 FROM m CROSS JOIN u""")
def eta_squared(t: Tables) -> DataFrame:
    """Between over total sum of squares."""
    x = units(t)
    u = x.agg(F.avg("y").alias("a"), (F.var_pop("y") * F.count("*")).alias("total"))
    m = x.groupBy("seg").agg(F.count("*").alias("n"), F.avg("y").alias("g")).crossJoin(F.broadcast(u))
    return m.agg(r(F.sum(F.col("n") * (F.col("g") - F.col("a")) * (F.col("g") - F.col("a"))) / F.max("total"), 9).alias("eta2"))


@query("SELECT l_returnflag, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{int(p * 100)}" for p in (0.01, 0.05, 0.5, 0.95, 0.99)) + ", count(*) AS n, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY ALL")
def describe_quantiles(t: Tables) -> DataFrame:
    """Exact quantiles by group (M18), without a buffer of a group's values."""
    shares = (0.01, 0.05, 0.5, 0.95, 0.99)
    names = [f"p{int(p * 100)}" for p in shares]
    q = distributed.quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", shares, names)
    means = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), r(F.avg("l_extendedprice"), 4).alias("mean"))
    return q.join(means, "l_returnflag").select("l_returnflag", *[r(n, 4).alias(n) for n in names], "n", "mean")


@query(f"SELECT brand, part, q, round(sum(q) OVER (PARTITION BY brand ORDER BY q DESC, part ROWS UNBOUNDED PRECEDING) / sum(q) OVER (PARTITION BY brand), 9) AS cumulative, round(row_number() OVER (PARTITION BY brand ORDER BY q, part) * 1.0 / count(*) OVER (PARTITION BY brand), 9)::DOUBLE AS pct FROM {PARTS}")
def running_share_and_percent_rank(t: Tables) -> DataFrame:
    """Cumulative share after a total order, and row number over count."""
    p = rel.with_totals(parts(t).withColumn("less", -F.col("q")), ["brand"], n=F.count("*"), mass=F.sum("q"))
    p = distributed.running(p, ["less", "part"], ["brand"], before=F.col("q"))
    p = distributed.positions(p, ["q", "part"], "pos", ["brand"])
    return p.select("brand", "part", "q", r((F.col("before") + F.col("q")) / F.col("mass"), 9).alias("cumulative"), r((F.col("pos") + 1) / F.col("n"), 9).alias("pct"))


@query(f"WITH d AS (SELECT *, size - avg(size) OVER (PARTITION BY brand) AS dx, q - avg(q) OVER (PARTITION BY brand) AS dy FROM {PARTS}) SELECT round(sum(dx * dy) / sum(dx * dx), 6) AS slope FROM d")
def demeaned_slope(t: Tables) -> DataFrame:
    """OLS slope within groups."""
    d = rel.with_totals(parts(t), ["brand"], mx=F.avg("size"), my=F.avg("q")).select((F.col("size") - F.col("mx")).alias("dx"), (F.col("q") - F.col("my")).alias("dy"))
    return d.agg(r(F.sum(F.col("dx") * F.col("dy")) / F.sum(F.col("dx") * F.col("dx"))).alias("slope"))


@query(f"SELECT part, brand, q FROM (SELECT *, greatest(quantile_cont(q, 0.95) OVER (PARTITION BY brand), 700) AS cut FROM {PARTS}) WHERE q > cut")
def group_threshold_floor(t: Tables) -> DataFrame:
    """Above the greater of the group's quantile and a floor."""
    p = parts(t)
    cuts = distributed.quantiles(p, ["brand"], "q", [0.95], ["cut"]).withColumn("cut", F.greatest("cut", F.lit(700.0)))
    return p.join(cuts, "brand").filter("q > cut").select("part", "brand", "q")
