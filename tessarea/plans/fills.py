"""Gap detection, the fill ladder, crosswalk controls and capped imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.functions import case_first, clip, ratio
from tessarea.operators import rel
from tessarea.plans.registry import PANEL, Tables, panel, query, r


def nation_panel(t: Tables) -> DataFrame:
    return panel(t).join(t.customer.select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("nation")), "cust")


NATION_PANEL = f"(SELECT p.*, c_nationkey AS nation FROM {PANEL} p JOIN customer ON cust = c_custkey)"


@query(f"""WITH p AS {NATION_PANEL} SELECT b.nation, b.yr AS base_yr, count(*) AS matched, round(sum(g.n) * 1.0 / sum(b.n), 6) AS ratio
FROM p b JOIN p g ON b.cust = g.cust AND g.yr = 2000 AND b.yr < 2000 GROUP BY ALL""")
def matched_panel_trend(t: Tables) -> DataFrame:
    """Target over base mass of the keys that report in both years, for all base years in one join (F1)."""
    p = nation_panel(t)
    target = p.filter("yr = 2000").select("cust", F.col("n").alias("target"))
    return p.filter("yr < 2000").join(target, "cust").groupBy("nation", F.col("yr").alias("base_yr")).agg(F.count("*").alias("matched"), r(ratio(F.sum("target"), F.sum("n"))).alias("ratio"))


@query(f"""WITH p AS {NATION_PANEL}, m AS (SELECT b.nation, b.yr, b.n AS base, g.n AS target FROM p b JOIN p g ON b.cust = g.cust AND g.yr = 2000 AND b.yr = 1999),
s AS (SELECT nation, sum(target) * 1.0 / sum(base) AS q FROM m GROUP BY nation HAVING count(*) >= 10 AND sum(base) >= 12), u AS (SELECT sum(target) * 1.0 / sum(base) AS q FROM m)
SELECT n_nationkey AS nation, round(coalesce(s.q, u.q, 1.0), 6)::DOUBLE AS ratio, CASE WHEN s.q IS NOT NULL THEN 'state' WHEN u.q IS NOT NULL THEN 'national' ELSE 'default' END AS ratio_source
FROM nation LEFT JOIN s ON n_nationkey = s.nation CROSS JOIN u""")
def trend_ratio_fallback(t: Tables) -> DataFrame:
    """State ratio if admitted, else national, else 1, with its label (F2, F3, C24). The national ratio has no gate."""
    p = nation_panel(t)
    m = p.filter("yr = 1999").select("cust", "nation", F.col("n").alias("base")).join(p.filter("yr = 2000").select("cust", F.col("n").alias("target")), "cust")
    q = ratio(F.sum("target"), F.sum("base")).alias("q")
    state = m.groupBy("nation").agg(q, F.count("*").alias("k"), F.sum("base").alias("mass")).filter("k >= 10 AND mass >= 12").select("nation", "q")
    out = rel.lookup_chain(t.nation.select(F.col("n_nationkey").alias("nation")), [(state, ["nation"], "q", "state"), (m.agg(q), [], "q", "national")], "ratio", 1.0)
    return out.select("nation", r("ratio").alias("ratio"), "ratio_source")


@query(f"""WITH p AS {PANEL} SELECT c.cust, c.yr, CASE WHEN p1.months - c.months >= 2 AND c.n < 0.75 * p1.n THEN 'months_drop' WHEN c.n < 0.5 * greatest(p1.n, p2.n, p3.n) THEN 'collapse' END AS kind
FROM p c LEFT JOIN p p1 ON c.cust = p1.cust AND p1.yr = c.yr - 1 LEFT JOIN p p2 ON c.cust = p2.cust AND p2.yr = c.yr - 2 LEFT JOIN p p3 ON c.cust = p3.cust AND p3.yr = c.yr - 3
WHERE (p1.months - c.months >= 2 AND c.n < 0.75 * p1.n) OR c.n < 0.5 * greatest(p1.n, p2.n, p3.n)""")
def masked_gap_flags(t: Tables) -> DataFrame:
    """A fall in months, or below the best of the three years before; the first kind wins (F4, F5, F7). A range window stands for the self-joins."""
    w = Window.partitionBy("cust").orderBy("yr")
    before = w.rangeBetween(-1, -1)
    rows = panel(t).withColumns({"m1": F.max("months").over(before), "n1": F.max("n").over(before), "best": F.max("n").over(w.rangeBetween(-3, -1))})
    kind = case_first([((F.col("m1") - F.col("months") >= 2) & (F.col("n") < 0.75 * F.col("n1")), "months_drop"), (F.col("n") < 0.5 * F.col("best"), "collapse")])
    return rows.select("cust", "yr", kind.alias("kind")).filter("kind IS NOT NULL")


@query(f"SELECT cust, count(*) AS flags, min(n) AS least FROM (SELECT *, lag(n) OVER (PARTITION BY cust ORDER BY yr) AS before FROM {PANEL}) WHERE n < before GROUP BY cust HAVING count(*) >= 2 OR min(n * 1.0 / before) < 0.25")
def flag_admission_having(t: Tables) -> DataFrame:
    """Keys with two flags or one deep fall (F8)."""
    rows = panel(t).withColumn("before", F.lag("n").over(Window.partitionBy("cust").orderBy("yr"))).filter("n < before")
    return rows.groupBy("cust").agg(F.count("*").alias("flags"), F.min("n").alias("least"), F.min(ratio("n", "before")).alias("q")).filter("flags >= 2 OR q < 0.25").drop("q")


@query(f"""WITH h AS (SELECT cust, count(*) AS k, max(yr) AS last, avg(yr) AS my, avg(ln(1 + n)) AS mn, CASE WHEN count(*) > 1 THEN coalesce(regr_slope(ln(1 + n), yr), 0) ELSE 0 END AS b FROM {PANEL} WHERE yr < 2001 GROUP BY cust)
SELECT cust, round(greatest(0, exp(mn + b * (2001 - my)) - 1), 6) AS projected FROM h""")
def log_linear_projection(t: Tables) -> DataFrame:
    """OLS of log(1 + count) on the year, one point projecting itself."""
    h = panel(t).filter("yr < 2001").groupBy("cust").agg(F.avg("yr").alias("my"), F.avg(F.log1p("n")).alias("mn"), F.coalesce(F.regr_slope(F.log1p("n"), F.col("yr")), F.lit(0.0)).alias("b"))
    return h.select("cust", r(F.greatest(F.lit(0.0), F.exp(F.col("mn") + F.col("b") * (2001 - F.col("my"))) - 1)).alias("projected"))


@query(f"""WITH h AS (SELECT cust, count(*) AS k, max(yr) AS last, arg_max(n, yr) AS latest, median(n) AS mid, avg(yr) AS my, avg(ln(1 + n)) AS mn, CASE WHEN count(*) > 1 THEN coalesce(regr_slope(ln(1 + n), yr), 0) ELSE 0 END AS b FROM {PANEL} WHERE yr < 2001 GROUP BY cust),
c AS (SELECT cust, n AS now FROM {PANEL} WHERE yr = 2001),
e AS (SELECT h.cust, coalesce(now, 0) AS now, CASE WHEN last < 1999 THEN 'stale' WHEN k >= 3 AND last >= 2000 THEN 'log_linear' WHEN last = 2000 THEN 'latest' ELSE 'median' END AS rung, latest, mid, greatest(0, exp(mn + b * (2001 - my)) - 1) AS ll FROM h LEFT JOIN c USING (cust))
SELECT cust, rung, round(greatest(now, CASE rung WHEN 'stale' THEN now WHEN 'log_linear' THEN ll WHEN 'latest' THEN latest * 1.1 ELSE mid END), 6)::DOUBLE AS estimate FROM e""")
def fill_ladder(t: Tables) -> DataFrame:
    """The first rung whose conditions hold; no estimate falls below what is reported."""
    p = panel(t)
    h = p.filter("yr < 2001").groupBy("cust").agg(
        F.count("*").alias("k"), F.max("yr").alias("last"), F.max_by("n", "yr").alias("latest"), F.median("n").alias("mid"), F.avg("yr").alias("my"),
        F.avg(F.log1p("n")).alias("mn"), F.coalesce(F.regr_slope(F.log1p("n"), F.col("yr")), F.lit(0.0)).alias("b"),
    )
    rows = h.join(p.filter("yr = 2001").select("cust", F.col("n").alias("reported")), "cust", "left").withColumn("now", F.coalesce("reported", F.lit(0)).cast("double"))
    rung = case_first([(F.col("last") < 1999, "stale"), ((F.col("k") >= 3) & (F.col("last") >= 2000), "log_linear"), (F.col("last") == 2000, "latest")], "median")
    line = F.greatest(F.lit(0.0), F.exp(F.col("mn") + F.col("b") * (2001 - F.col("my"))) - 1)
    value = case_first([(rung == "stale", F.col("now")), (rung == "log_linear", line), (rung == "latest", F.col("latest") * 1.1)], F.col("mid"))
    return rows.select("cust", rung.alias("rung"), r(F.greatest("now", value)).alias("estimate"))


@query("""WITH b AS (SELECT s_suppkey, s_nationkey AS region, 0.6 AS w FROM supplier UNION ALL SELECT s_suppkey, (s_nationkey + 1) % 25, 0.4 FROM supplier)
SELECT region, l_returnflag, round(sum(l_extendedprice * w), 2) AS total FROM lineitem JOIN b ON l_suppkey = s_suppkey GROUP BY ALL""")
def bridge_rollup(t: Tables) -> DataFrame:
    """Facts through a weighted crosswalk whose weights sum to 1 per key."""
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n"))
    bridge = s.select("l_suppkey", F.col("n").alias("region"), F.lit(0.6).alias("weight")).unionByName(s.select("l_suppkey", ((F.col("n") + 1) % 25).alias("region"), F.lit(0.4).alias("weight")))
    # Facts are summed by key first: the crosswalk multiplies sums, not rows.
    facts = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_extendedprice").alias("value"))
    return rel.rollup_via_bridge(facts, bridge, "l_suppkey", ["region", "l_returnflag"], "value").select("region", "l_returnflag", r("value", 2).alias("total"))


@query("""SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END), 6) AS reported, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 6) AS returned,
round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END), 6) AS accepted, round(sum(l_quantity), 6) AS total,
CASE WHEN sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) >= 0.6 * sum(l_quantity) THEN 'reported' ELSE 'mixed' END AS source FROM lineitem GROUP BY l_suppkey""")
def classed_components(t: Tables) -> DataFrame:
    """Sums split by class, and the label that their mix gives."""
    part = lambda f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity")).otherwise(0.0))
    s = t.lineitem.groupBy("l_suppkey").agg(part("N").alias("reported"), part("R").alias("returned"), part("A").alias("accepted"), F.sum("l_quantity").alias("total"))
    return s.select("l_suppkey", *[r(c).alias(c) for c in ("reported", "returned", "accepted", "total")], F.when(F.col("reported") >= 0.6 * F.col("total"), "reported").otherwise("mixed").alias("source"))


@query("""SELECT p_brand, p_type, round(w, 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY w DESC, p_type) AS k
FROM (SELECT p_brand, p_type, sum(l_quantity) AS w FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)) WHERE k = 1""")
def dominant_label(t: Tables) -> DataFrame:
    """The label with most weight, the smaller label on ties."""
    return rel.dominant_label(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["p_brand"], "p_type", "l_quantity").select("p_brand", "p_type", r("weight").alias("weight"))


@query("""SELECT p_brand, round(sum(CASE WHEN p_size % 5 <> 0 THEN p_size * l_quantity END) / sum(CASE WHEN p_size % 5 <> 0 THEN l_quantity END), 6) AS mean_size FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def weighted_mean_nullsafe(t: Tables) -> DataFrame:
    """Weighted mean whose denominator counts known values alone."""
    size = F.when(F.col("p_size") % 5 != 0, F.col("p_size"))
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(r(rel.weighted_mean(size, F.col("l_quantity"))).alias("mean_size"))


@query("""WITH f AS (SELECT c_nationkey, c_mktsegment, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND year(o_orderdate) = 1997 GROUP BY ALL)
SELECT k.n_nationkey, k.seg, round(coalesce(v, 0), 2)::DOUBLE AS v, v IS NULL AS missing FROM (SELECT n_nationkey, seg FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment AS seg FROM customer)) k LEFT JOIN f ON n_nationkey = c_nationkey AND seg = c_mktsegment""")
def skeleton_left_join(t: Tables) -> DataFrame:
    """The universe comes from ownership, not from the facts."""
    facts = t.orders.filter((F.col("o_orderstatus") == "P") & (F.year("o_orderdate") == 1997)).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("seg")).agg(F.sum("o_totalprice").alias("v"))
    skeleton = t.nation.select("n_nationkey").crossJoin(t.customer.select(F.col("c_mktsegment").alias("seg")).distinct())
    return skeleton.join(facts, ["n_nationkey", "seg"], "left").select("n_nationkey", "seg", r(F.coalesce("v", F.lit(0.0)), 2).alias("v"), F.col("v").isNull().alias("missing"))


@query("""SELECT o_custkey AS cust, round(sum(o_totalprice), 2) AS mass, CASE WHEN count(*) < 5 THEN 'few' ELSE 'negative_balance' END AS reason FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey, c_acctbal HAVING count(*) < 5 OR c_acctbal < 0""")
def exclusion_anti(t: Tables) -> DataFrame:
    """Excluded units with reason and mass."""
    g = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("o_custkey").alias("cust"), "c_acctbal").agg(r(F.sum("o_totalprice"), 2).alias("mass"), F.count("*").alias("k"))
    return g.filter("k < 5 OR c_acctbal < 0").select("cust", "mass", F.when(F.col("k") < 5, "few").otherwise("negative_balance").alias("reason"))


@query("""WITH a AS (SELECT l_returnflag AS f, l_linestatus AS s, sum(l_quantity) AS x FROM lineitem WHERE l_discount > 0.02 GROUP BY ALL), b AS (SELECT l_returnflag AS f, l_linestatus AS s, sum(l_quantity) AS y FROM lineitem WHERE l_tax > 0.02 GROUP BY ALL)
SELECT coalesce(a.f, b.f) AS f, coalesce(a.s, b.s) AS s, round(coalesce(x, 0) - coalesce(y, 0), 6) AS gap, abs(coalesce(x, 0) - coalesce(y, 0)) <= 5000 AS ok FROM a FULL JOIN b ON a.f = b.f AND a.s = b.s""")
def mass_reconciliation(t: Tables) -> DataFrame:
    """Two aggregates side by side with their gap (G9, C8). One scan: both sums are conditional."""
    side = lambda c: F.sum(F.when(c, F.col("l_quantity")).otherwise(0.0))
    g = t.lineitem.filter("l_discount > 0.02 OR l_tax > 0.02").groupBy(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).agg(side(F.col("l_discount") > 0.02).alias("x"), side(F.col("l_tax") > 0.02).alias("y"))
    return g.select("f", "s", r(F.col("x") - F.col("y")).alias("gap"), (F.abs(F.col("x") - F.col("y")) <= 5000).alias("ok"))


@query("""SELECT coalesce(r_name, 'ALL') AS region, coalesce(n_name, 'ALL') AS nation, round(sum(o_totalprice), 2) AS v, count(*) AS n, CAST(grouping(r_name, n_name) AS BIGINT) AS level
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def multi_level_totals(t: Tables) -> DataFrame:
    """Totals at every level in one pass."""
    per = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"), F.count("*").alias("n")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    named = per.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    g = named.rollup("r_name", "n_name").agg(r(F.sum("v"), 2).alias("v"), F.sum("n").alias("n"), F.grouping_id().alias("level"))
    return g.select(F.coalesce("r_name", F.lit("ALL")).alias("region"), F.coalesce("n_name", F.lit("ALL")).alias("nation"), "v", "n", "level")


@query("SELECT l_suppkey, kind, round(v, 6) AS v FROM (UNPIVOT (SELECT l_suppkey, sum(l_quantity) AS quantity, sum(l_discount) AS discount, sum(l_tax) AS tax FROM lineitem GROUP BY ALL) ON quantity, discount, tax INTO NAME kind VALUE v)")
def unpivot_wide(t: Tables) -> DataFrame:
    """Wide to long."""
    wide = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"), F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"))
    return rel.unpivot_fixed(wide, ["l_suppkey"], ["quantity", "discount", "tax"], "kind", "v").withColumn("v", r("v"))


@query("""SELECT p_brand, round(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0), 6) AS a, round(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0), 6) AS n,
round(sum(l_quantity) - coalesce(sum(l_quantity) FILTER (WHERE l_returnflag IN ('A', 'N')), 0), 6) AS rest FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def pivot_lane_masses(t: Tables) -> DataFrame:
    """Lane masses as columns, the residual beside them."""
    rows = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("q")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    wide = rel.pivot_fixed(rows.withColumn("lane", F.when(F.col("l_returnflag").isin("A", "N"), F.col("l_returnflag")).otherwise("rest")), ["p_brand"], "lane", ["A", "N", "rest"], "q")
    return wide.select("p_brand", *[r(c).alias(c) for c in ("a", "n", "rest")])


@query("""WITH c AS (SELECT c_nationkey AS nation, c_mktsegment AS seg, count(o_orderkey) AS y, count(DISTINCT c_custkey) AS e FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY ALL),
u AS (SELECT sum(y) * 1.0 / sum(e) AS rn FROM c), s AS (SELECT nation, (sum(y) + 20 * max(rn)) / (sum(e) + 20) AS rs FROM c CROSS JOIN u GROUP BY nation)
SELECT nation, seg, round((y + 20 * rs) / (e + 20), 6)::DOUBLE AS rate FROM c JOIN s USING (nation)""")
def shrunk_rate_two_level(t: Tables) -> DataFrame:
    """Cell rates shrunk to the state's, which are shrunk to the national one (H1)."""
    orders = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    c = t.customer.join(orders, "c_custkey", "left").groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg")).agg(F.sum(F.coalesce("k", F.lit(0))).alias("y"), F.count("*").alias("e"))
    national = c.agg(ratio(F.sum("y"), F.sum("e")).alias("rn"))
    s = c.groupBy("nation").agg(F.sum("y").alias("ys"), F.sum("e").alias("es")).crossJoin(F.broadcast(national)).select("nation", ((F.col("ys") + 20 * F.col("rn")) / (F.col("es") + 20)).alias("rs"))
    return c.join(s, "nation").select("nation", "seg", r((F.col("y") + 20 * F.col("rs")) / (F.col("e") + 20)).alias("rate"))


CONFLICT = "CASE WHEN ext IS NULL THEN 'no_benchmark' WHEN pool = 0 AND ext > locked THEN 'unfilled_gap' WHEN ext < locked THEN 'over_benchmark' WHEN pool > ext - locked THEN 'capped' WHEN pool > 0 THEN 'headroom' ELSE 'exact' END"
POOL = """(SELECT c_nationkey AS nation, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS locked, sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 3 ELSE 0 END) AS pool,
CASE WHEN c_nationkey % 7 <> 3 THEN sum(o_totalprice) * (0.4 + 0.02 * c_nationkey) END AS ext FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)"""


def pools(t: Tables) -> DataFrame:
    s = lambda c: F.sum(F.when(c, F.col("o_totalprice")).otherwise(0.0))
    g = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation")).agg(s(F.col("o_orderstatus") == "F").alias("locked"), (3 * s(F.col("o_orderstatus") == "P")).alias("pool"), F.sum("o_totalprice").alias("all"))
    return g.select("nation", "locked", "pool", F.when(F.col("nation") % 7 != 3, F.col("all") * (0.4 + 0.02 * F.col("nation"))).alias("ext"))


@query(f"SELECT nation, round(greatest(0, ext - locked), 2) AS residual, round(CASE WHEN ext IS NULL THEN 1.0 WHEN pool > 0 THEN least(1, greatest(0, ext - locked) / pool) END, 6) AS scale, round(pool * CASE WHEN ext IS NULL THEN 1.0 WHEN pool > 0 THEN least(1, greatest(0, ext - locked) / pool) END, 2) AS imputed FROM (SELECT nation, locked, pool, ext FROM {POOL}) WHERE ext IS NOT NULL OR pool >= 0")
def residual_cap_imputation(t: Tables) -> DataFrame:
    """Modelled mass scaled down to what the external benchmark leaves (H8)."""
    residual = clip(F.col("ext") - F.col("locked"), 0.0)
    scale = F.when(F.col("ext").isNull(), 1.0).when(F.col("pool") > 0, clip(ratio(residual, F.col("pool")), None, 1.0))
    rows = pools(t).withColumns({"residual": residual, "scale": scale})
    return rows.select("nation", r(F.coalesce("residual", F.lit(0.0)), 2).alias("residual"), r("scale").alias("scale"), r(F.col("pool") * F.col("scale"), 2).alias("imputed"))


@query(f"SELECT nation, {CONFLICT} AS kind FROM {POOL}")
def conflict_kind(t: Tables) -> DataFrame:
    """Six kinds, the first that holds (H9)."""
    e, lo, p = F.col("ext"), F.col("locked"), F.col("pool")
    return pools(t).select("nation", case_first([(e.isNull(), "no_benchmark"), ((p == 0) & (e > lo), "unfilled_gap"), (e < lo, "over_benchmark"), (p > e - lo, "capped"), (p > 0, "headroom")], "exact").alias("kind"))


@query("""WITH c AS (SELECT c_custkey % 5 AS fold, c_nationkey AS nation, c_custkey, count(o_orderkey) AS y FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
f AS (SELECT fold, nation, sum(y) AS y, count(*) AS e FROM c GROUP BY ALL), tr AS (SELECT a.fold, a.nation, sum(b.y) AS y, sum(b.e) AS e FROM (SELECT fold, nation FROM f) a JOIN f b ON a.nation = b.nation AND a.fold <> b.fold GROUP BY ALL),
u AS (SELECT fold, sum(y) * 1.0 / sum(e) AS rn FROM tr GROUP BY fold), g AS (SELECT unnest([1.0, 5.0, 25.0, 125.0]) AS k)
SELECT k::DOUBLE AS k, round(sum(2 * (CASE WHEN f.y > 0 THEN f.y * ln(f.y / greatest(1e-9, f.e * (tr.y + k * rn) / (tr.e + k))) ELSE 0 END - (f.y - greatest(1e-9, f.e * (tr.y + k * rn) / (tr.e + k))))), 6)::DOUBLE AS deviance
FROM f JOIN tr ON f.fold = tr.fold AND f.nation = tr.nation JOIN u ON u.fold = f.fold CROSS JOIN g GROUP BY k""")
def poisson_deviance_grid(t: Tables) -> DataFrame:
    """Held-out Poisson deviance of each shrinkage constant of a grid, folds by key (H3, H4)."""
    k = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    f = t.customer.join(k, "c_custkey", "left").groupBy((F.col("c_custkey") % 5).alias("fold"), F.col("c_nationkey").alias("nation")).agg(F.sum(F.coalesce("k", F.lit(0))).alias("y"), F.count("*").alias("e"))
    w = Window.partitionBy("nation")
    tr = f.withColumns({"ty": F.sum("y").over(w) - F.col("y"), "te": F.sum("e").over(w) - F.col("e")})
    u = tr.groupBy("fold").agg(ratio(F.sum("ty"), F.sum("te")).alias("rn"))
    rows = tr.filter("te > 0").join(u, "fold").withColumn("k", F.explode(F.array(*[F.lit(x) for x in (1.0, 5.0, 25.0, 125.0)])))
    mu = F.greatest(F.lit(1e-9), F.col("e") * (F.col("ty") + F.col("k") * F.col("rn")) / (F.col("te") + F.col("k")))
    dev = 2 * (F.when(F.col("y") > 0, F.col("y") * F.log(F.col("y") / mu)).otherwise(0.0) - (F.col("y") - mu))
    return rows.groupBy("k").agg(r(F.sum(dev)).alias("deviance"))
