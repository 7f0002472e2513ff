"""Lane selection, candidate deduplication, completion and quality ladders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.functions import case_first, case_last, clip, ratio
from tessarea.operators import distributed, rel
from tessarea.plans.registry import CANDIDATES, PANEL, Tables, candidates, panel, query, r


def lane_order():
    return [F.desc("months"), F.desc("n"), F.desc("amount"), F.asc("lane")]


LANE_ORDER = "months DESC, n DESC, amount DESC, lane"


@query(f"SELECT cust, yr, prio, lane, n, amount, months FROM (SELECT *, row_number() OVER (PARTITION BY cust, yr, prio ORDER BY {LANE_ORDER}) AS k FROM {CANDIDATES}) WHERE k = 1")
def lane_top1_selection(t: Tables) -> DataFrame:
    """One lane per customer, year and priority, by a total composite priority."""
    return rel.top1(candidates(t), ["cust", "yr", "prio"], lane_order())


@query(f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY cust, yr, prio ORDER BY {LANE_ORDER}) AS k FROM {CANDIDATES})
SELECT a.cust, a.yr, a.prio, a.lane, b.lane AS runner_up, CASE WHEN b.lane IS NULL THEN 'only_lane' WHEN a.months <> b.months THEN 'months'
  WHEN a.n <> b.n THEN 'count' WHEN a.amount <> b.amount THEN 'amount' ELSE 'lane_name' END AS reason
FROM k a LEFT JOIN k b ON a.cust = b.cust AND a.yr = b.yr AND a.prio = b.prio AND b.k = 2 WHERE a.k = 1""")
def lane_reason_vs_runner_up(t: Tables) -> DataFrame:
    """Why rank 0 beat rank 1: the first criterion that differs (E5). One window instead of a self-join."""
    w = Window.partitionBy("cust", "yr", "prio").orderBy(*lane_order())
    nxt = {f"next_{c}": F.lead(c).over(w) for c in ("lane", "months", "n", "amount")}
    rows = rel.ranked(candidates(t).withColumns(nxt), ["cust", "yr", "prio"], lane_order(), "k").filter("k = 0")
    reason = case_first([(F.col("next_lane").isNull(), "only_lane"), (F.col("months") != F.col("next_months"), "months"), (F.col("n") != F.col("next_n"), "count"), (F.col("amount") != F.col("next_amount"), "amount")], "lane_name")
    return rows.select("cust", "yr", "prio", "lane", F.col("next_lane").alias("runner_up"), reason.alias("reason"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_quantity DESC, l_extendedprice DESC, l_partkey, l_suppkey) AS k FROM lineitem) WHERE k = 1""")
def candidate_dedupe_best(t: Tables) -> DataFrame:
    """The best of the rows that share a key (D14); all columns returned take part in the order."""
    best = rel.top1(t.lineitem, ["l_orderkey", "l_linenumber"], [F.desc("l_quantity"), F.desc("l_extendedprice"), F.asc("l_partkey"), F.asc("l_suppkey")])
    return best.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS yr, round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0), 2) AS f,
  round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 0), 2) AS o, round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 0), 2) AS p FROM orders GROUP BY ALL""")
def lane_outer_pivot(t: Tables) -> DataFrame:
    """Lanes side by side on one key (C3), by conditional aggregation in one shuffle instead of a chain of full joins."""
    wide = rel.pivot_fixed(t.orders.withColumns({"cust": F.col("o_custkey"), "yr": F.year("o_orderdate")}), ["cust", "yr"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return wide.select("cust", "yr", *[r(c, 2).alias(c) for c in "fop"])


@query("""WITH k AS (SELECT DISTINCT o_custkey AS cust FROM orders), d AS (SELECT DISTINCT o_orderpriority AS prio FROM orders),
c AS (SELECT o_custkey AS cust, o_orderpriority AS prio, count(*) AS n FROM orders GROUP BY ALL) SELECT k.cust, d.prio, coalesce(n, 0) AS n FROM k CROSS JOIN d LEFT JOIN c ON k.cust = c.cust AND d.prio = c.prio""")
def zero_completion(t: Tables) -> DataFrame:
    """Each customer with all priorities, missing counts as 0."""
    counts = t.orders.groupBy(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("prio")).agg(F.count("*").alias("n"))
    return rel.complete(counts, ["cust"], t.orders.select(F.col("o_orderpriority").alias("prio")).distinct(), {"n": 0})


@query(f"SELECT cust, yr, n, months FROM (SELECT *, max(months) OVER (PARTITION BY cust) AS most, sum(n) OVER (PARTITION BY cust) AS total FROM {PANEL}) WHERE most >= 2 AND total >= 5")
def non_report_removal(t: Tables) -> DataFrame:
    """Groups that never reported enough go as a whole."""
    w = Window.partitionBy("cust")
    return panel(t).withColumns({"most": F.max("months").over(w), "total": F.sum("n").over(w)}).filter("most >= 2 AND total >= 5").select("cust", "yr", "n", "months")


@query(f"""WITH p AS {PANEL}, m AS (SELECT cust, median(n) FILTER (WHERE months >= 3) AS usual FROM p GROUP BY cust)
SELECT p.cust, yr, n, months, usual FROM p JOIN m USING (cust) WHERE months <= 2 AND n > 0 AND (n >= 5 OR n >= 0.6 * usual)""")
def batch_detector(t: Tables) -> DataFrame:
    """Few months but a usual year's count: an annual batch."""
    usual = F.median(F.when(F.col("months") >= 3, F.col("n"))).over(Window.partitionBy("cust"))
    return panel(t).withColumn("usual", usual).filter("months <= 2 AND n > 0 AND (n >= 5 OR n >= 0.6 * usual)").select("cust", "yr", "n", "months", "usual")


@query(f"""WITH p AS {PANEL}, q AS (SELECT *, CASE WHEN months >= 6 THEN 'high' WHEN months >= 4 THEN 'medium' WHEN months >= 2 THEN 'low' WHEN months >= 1 THEN 'sparse' ELSE 'unknown' END AS tier0, n >= 2 * months AS lumpy FROM p)
SELECT cust, yr, months, CASE WHEN lumpy AND tier0 IN ('high', 'medium') THEN 'low' ELSE tier0 END AS tier,
 CASE CASE WHEN lumpy AND tier0 IN ('high', 'medium') THEN 'low' ELSE tier0 END WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.8 WHEN 'low' THEN 0.5 WHEN 'sparse' THEN 0.25 ELSE 0.1 END::DOUBLE AS weight FROM q""")
def tier_ladder(t: Tables) -> DataFrame:
    """Quality tier and weight, with the demotion cascade: high to medium, then medium to low, in sequence."""
    tier = case_first([(F.col("months") >= 6, "high"), (F.col("months") >= 4, "medium"), (F.col("months") >= 2, "low"), (F.col("months") >= 1, "sparse")], "unknown")
    rows = panel(t).withColumns({"tier": tier, "lumpy": F.col("n") >= 2 * F.col("months")})
    for high, low in (("high", "medium"), ("medium", "low")):
        rows = rows.withColumn("tier", F.when(F.col("lumpy") & (F.col("tier") == high), low).otherwise(F.col("tier")))
    weight = case_first([(F.col("tier") == k, v) for k, v in (("high", 1.0), ("medium", 0.8), ("low", 0.5), ("sparse", 0.25))], 0.1)
    return rows.select("cust", "yr", "months", "tier", weight.alias("weight"))


@query(f"SELECT cust, yr, CASE WHEN amount > 500000 THEN 'major' WHEN months >= 4 THEN 'regular' WHEN n >= 3 THEN 'clustered' WHEN months = 1 THEN 'single' ELSE 'other' END AS regime FROM {PANEL}")
def regime_ladder(t: Tables) -> DataFrame:
    """Masks in order, a later one overwriting an earlier one."""
    rungs = [(F.col("months") == 1, "single"), (F.col("n") >= 3, "clustered"), (F.col("months") >= 4, "regular"), (F.col("amount") > 500000, "major")]
    return panel(t).select("cust", "yr", case_last(rungs, "other").alias("regime"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) >= 2000)")
def dead_key_anti_join(t: Tables) -> DataFrame:
    """Keys without any recent report."""
    return t.customer.join(t.orders.filter(F.year("o_orderdate") >= 2000), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""SELECT c_nationkey, c_mktsegment, count(*) AS members, bool_and(k.o_custkey IS NULL) AS all_dead, count(*) FILTER (WHERE k.o_custkey IS NULL) AS dead
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) k ON c_custkey = k.o_custkey GROUP BY ALL""")
def all_members_dead(t: Tables) -> DataFrame:
    """A group is dead if every member is."""
    live = t.orders.select("o_custkey").distinct()
    dead = F.col("o_custkey").isNull()
    return t.customer.join(live, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("members"), F.bool_and(dead).alias("all_dead"), F.count_if(dead).alias("dead"))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) FILTER (WHERE l_discount > 0.05) AS parts, count(DISTINCT l_partkey) AS all_parts FROM lineitem GROUP BY ALL")
def conditional_distinct_filter(t: Tables) -> DataFrame:
    """Distinct count under a condition."""
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct(F.when(F.col("l_discount") > 0.05, F.col("l_partkey"))).alias("parts"), F.countDistinct("l_partkey").alias("all_parts"))


@query("""WITH c AS (SELECT greatest(quantile_cont(l_quantity, 0.95) FILTER (WHERE l_quantity < 50), 30) AS cap FROM lineitem)
SELECT l_returnflag, round(sum(CASE WHEN l_quantity >= 50 THEN cap ELSE least(l_quantity, cap) END), 6) AS capped, max(cap) AS cap FROM lineitem CROSS JOIN c GROUP BY ALL""")
def percentile_cap(t: Tables) -> DataFrame:
    """Sentinel and cap from a one-row aggregate."""
    cap = distributed.quantiles(t.lineitem.filter("l_quantity < 50"), [], "l_quantity", [0.95], ["cap"]).select(F.greatest("cap", F.lit(30.0)).alias("cap"))
    value = F.when(F.col("l_quantity") >= 50, F.col("cap")).otherwise(F.least("l_quantity", "cap"))
    return t.lineitem.crossJoin(F.broadcast(cap)).groupBy("l_returnflag").agg(r(F.sum(value)).alias("capped"), F.max("cap").alias("cap"))


@query("""WITH i AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_r, max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS has_a, max(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) AS deep FROM lineitem GROUP BY l_orderkey)
SELECT o_orderpriority, CASE WHEN has_r = 1 THEN 'returned' WHEN has_a = 1 THEN 'accepted' WHEN deep = 1 THEN 'discounted' ELSE 'plain' END AS kind, count(*) AS n FROM i JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def hierarchy_counts(t: Tables) -> DataFrame:
    """Per incident the highest rule alone counts."""
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    i = t.lineitem.groupBy("l_orderkey").agg(flag(F.col("l_returnflag") == "R").alias("has_r"), flag(F.col("l_returnflag") == "A").alias("has_a"), flag(F.col("l_discount") > 0.08).alias("deep"))
    kind = case_first([(F.col("has_r") == 1, "returned"), (F.col("has_a") == 1, "accepted"), (F.col("deep") == 1, "discounted")], "plain")
    return i.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority", kind.alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT o_custkey AS cust, c_nationkey AS nation, string_agg(n::VARCHAR, ',' ORDER BY prio) AS vec, sum(n) AS total FROM (SELECT o_custkey, o_orderpriority AS prio, count(*) AS n FROM orders GROUP BY ALL) JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT a.cust AS first_cust, b.cust AS second_cust, a.nation, a.vec FROM v a JOIN v b ON a.nation = b.nation AND a.vec = b.vec AND a.cust < b.cust WHERE a.total >= 12""")
def twin_vector_match(t: Tables) -> DataFrame:
    """Keys of one group with equal vectors of counts (C10, D17): an equi-join on the vector as text."""
    n = t.orders.groupBy("o_custkey", F.col("o_orderpriority").alias("prio")).agg(F.count("*").alias("n"))
    vec = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("prio", "n"))), lambda x: x["n"].cast("string")), ",")
    v = n.groupBy("o_custkey").agg(vec.alias("vec"), F.sum("n").alias("total")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).filter("total >= 12")
    side = lambda name: v.select(F.col("o_custkey").alias(name), F.col("c_nationkey").alias("nation"), "vec")
    return side("first_cust").join(side("second_cust"), ["nation", "vec"]).filter("first_cust < second_cust").select("first_cust", "second_cust", "nation", "vec")


@query(f"""WITH s AS (SELECT cust, min(yr) AS first_yr, max(yr) AS last_yr FROM {PANEL} GROUP BY cust), c AS (SELECT s.*, c_nationkey AS nation, c_mktsegment AS seg FROM s JOIN customer ON cust = c_custkey)
SELECT d.cust AS dead, l.cust AS live, d.nation, d.seg FROM c d JOIN c l ON d.nation = l.nation AND d.seg = l.seg AND d.cust <> l.cust WHERE d.last_yr < 1998 AND l.first_yr > d.last_yr""")
def succession_pairs(t: Tables) -> DataFrame:
    """A key that ended and one that began later on the same footprint."""
    s = panel(t).groupBy("cust").agg(F.min("yr").alias("first_yr"), F.max("yr").alias("last_yr")).join(t.customer, F.col("cust") == F.col("c_custkey"))
    dead = s.filter("last_yr < 1998").select(F.col("cust").alias("dead"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg"), "last_yr")
    live = s.select(F.col("cust").alias("live"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("seg"), "first_yr")
    return dead.join(live, ["nation", "seg"]).filter("dead <> live AND first_yr > last_yr").select("dead", "live", "nation", "seg")


@query(f"SELECT cust, yr, array_to_string(list_sort(list(DISTINCT prio)), '+') AS mask, count(DISTINCT prio) AS k FROM {CANDIDATES} GROUP BY ALL")
def month_mask_detail(t: Tables) -> DataFrame:
    """The sorted distinct set of a key as one string."""
    return candidates(t).groupBy("cust", "yr").agg(F.array_join(F.array_sort(F.collect_set("prio")), "+").alias("mask"), F.countDistinct("prio").alias("k"))


@query(f"SELECT cust, yr, n, months, round(CASE WHEN months > 0 AND months < 12 THEN greatest(n, n * 12.0 / months) ELSE n END, 6)::DOUBLE AS annual, least(greatest(12 - months, 0), 12) AS missing FROM {PANEL}")
def partial_year_annualise(t: Tables) -> DataFrame:
    """max(c, 12 c / m) for a year with months missing."""
    up = F.when((F.col("months") > 0) & (F.col("months") < 12), F.greatest(F.col("n").cast("double"), ratio(F.col("n") * 12.0, F.col("months")))).otherwise(F.col("n").cast("double"))
    return panel(t).select("cust", "yr", "n", "months", r(up).alias("annual"), clip(12 - F.col("months"), F.lit(0), F.lit(12)).alias("missing"))
