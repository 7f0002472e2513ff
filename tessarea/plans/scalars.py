"""Scalar operators on the test tables: keys, text, time, lists, exposures and guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.functions import case_first, rates, ratio, text
from tessarea.operators import expect, rel
from tessarea.plans.publish import CUST, PARTS, parts, units
from tessarea.plans.registry import CANDIDATES, PANEL, Tables, candidates, panel, query, r


@query(f"SELECT o_orderkey FROM orders WHERE (o_custkey, CAST(year(o_orderdate) AS INTEGER)) IN (SELECT (cust, yr) FROM {PANEL} WHERE n >= 4)")
def multi_key_membership(t: Tables) -> DataFrame:
    """Rows whose several keys stand together in a set."""
    chosen = panel(t).filter("n >= 4").select(F.col("cust").alias("o_custkey"), "yr")
    return rel.members(t.orders.withColumn("yr", F.year("o_orderdate")), chosen, ["o_custkey", "yr"]).select("o_orderkey")


@query("SELECT n_nationkey, CASE n_nationkey WHEN 3 THEN 103 WHEN 7 THEN 107 ELSE n_nationkey END AS now, n_regionkey || ':' || n_nationkey AS key FROM nation WHERE n_regionkey NOT IN (1, 4)")
def scoped_remapped_keys(t: Tables) -> DataFrame:
    """Scope, retired keys to present ones, and a composite key."""
    inside = t.nation.filter(~F.col("n_regionkey").isin(1, 4))
    return inside.select("n_nationkey", text.remap("n_nationkey", {3: 103, 7: 107}).alias("now"), F.concat_ws(":", "n_regionkey", "n_nationkey").alias("key"))


@query(f"""WITH w AS (SELECT cust, sum(amount) FILTER (WHERE yr = 1996) AS a, sum(amount) FILTER (WHERE yr = 2000) AS b FROM {PANEL} GROUP BY cust)
SELECT cust, round(pow(b / a, 1 / 4.0), 9) AS factor, round(b * pow(b / a, 1 / 4.0), 2) AS projected, round(b * 313.7 / 172.2, 2) AS inflated FROM w WHERE a > 0 AND b > 0""")
def growth_and_inflation(t: Tables) -> DataFrame:
    """Yearly growth, the next year by it, and money of one year in that of another."""
    sums = [F.sum(F.when(F.col("yr") == y, F.col("amount"))).alias(n) for y, n in ((1996, "a"), (2000, "b"))]
    w = panel(t).groupBy("cust").agg(*sums).withColumn("factor", rates.growth("a", "b", F.lit(4.0))).filter("factor IS NOT NULL")
    return w.select("cust", r("factor", 9).alias("factor"), r(F.col("b") * F.col("factor"), 2).alias("projected"), r(F.col("b") * 313.7 / 172.2, 2).alias("inflated"))


@query(r"""SELECT p_partkey, regexp_matches(p_name, '^[a-z]{5} [a-z]+$') AS five, nullif(regexp_extract(p_brand, '#(\d+)$', 1), '') AS number, split_part(p_name, ' ', 1) AS head,
  CASE WHEN contains(p_name, ' ') THEN substr(p_name, strpos(p_name, ' ') + 1) END AS tail, regexp_matches(upper(p_name), '\b(RING|BOLT)\b') AS worded, p_type LIKE 'PROMO%' AS promo,
  trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS slug, coalesce(nullif(CASE WHEN p_size > 25 THEN p_type ELSE '' END, ''), 'none') AS filled FROM part""")
def text_patterns(t: Tables) -> DataFrame:
    """Whole matches, groups, a split at the first blank, words, prefixes, slugs and blanks."""
    head, tail = text.split_once("p_name", " ")
    return t.part.select(
        "p_partkey", text.fullmatch("p_name", "[a-z]{5} [a-z]+").alias("five"), text.extract("p_brand", r"#(\d+)$").alias("number"), head.alias("head"), tail.alias("tail"),
        text.has_word("p_name", ["ring", "bolt"]).alias("worded"), F.col("p_type").startswith("PROMO").alias("promo"), text.slug("p_brand").alias("slug"),
        text.or_if_blank(F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(""), "none").alias("filled"),
    )


@query(r"""WITH v AS (SELECT p_partkey, p_name AS a, trim(regexp_replace(p_name, '^[a-z]+ ', '')) AS b, trim(regexp_replace(p_name, 'g$', '')) AS c FROM part)
SELECT p_partkey, a AS name, 0::BIGINT AS tier FROM v UNION ALL SELECT p_partkey, b, 1 FROM v WHERE b <> a AND b <> '' UNION ALL SELECT p_partkey, c, 2 FROM v WHERE c <> a AND c <> b AND c <> ''""")
def name_variant_tiers(t: Tables) -> DataFrame:
    """Candidate names by tier, a row each."""
    return t.part.select("p_partkey", F.explode(text.name_variants("p_name", [("^[a-z]+ ", ""), ("g$", "")])).alias("v")).select("p_partkey", "v.name", "v.tier")


@query("SELECT o_orderkey, CASE trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') WHEN '1_urgent' THEN 'urgent' WHEN '2_high' THEN 'high' WHEN '3_medium' THEN 'medium' WHEN '4_not_specified' THEN 'unknown' WHEN '5_low' THEN 'low' END AS label FROM orders")
def alias_canonical(t: Tables) -> DataFrame:
    """Aliases to canonical names; a slug that the list lacks stops the job."""
    names = {"1_urgent": "urgent", "2_high": "high", "3_medium": "medium", "4_not_specified": "unknown", "5_low": "low"}
    rows = t.orders.select("o_orderkey", text.slug("o_orderpriority").alias("slug"))
    expect.all_hold(rows, known=F.col("slug").isin(*names))
    return rows.select("o_orderkey", text.remap("slug", names).alias("label"))


@query(f"""WITH y AS (SELECT cust, yr, yr - row_number() OVER (PARTITION BY cust ORDER BY yr) AS g FROM {PANEL}), i AS (SELECT cust, min(yr) AS lo, max(yr) AS hi FROM y GROUP BY cust, g)
SELECT cust, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ',' ORDER BY lo) AS years FROM i GROUP BY cust""")
def year_ranges(t: Tables) -> DataFrame:
    """Years as runs."""
    return panel(t).groupBy("cust").agg(text.ranges(F.collect_set("yr")).alias("years"))


@query("SELECT CAST(p_retailprice AS VARCHAR) AS key, count(*) AS n FROM part GROUP BY ALL")
def float_as_key(t: Tables) -> DataFrame:
    """The exact text of a number as a key."""
    return t.part.groupBy(F.col("p_retailprice").cast("string").alias("key")).agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%m/%d/%Y') ELSE 'unknown' END AS x FROM events)
SELECT event_id, coalesce(try_strptime(x, '%Y-%m-%d %H:%M:%S'), try_strptime(x, '%m/%d/%Y')) AS ts, CAST(year(coalesce(try_strptime(x, '%Y-%m-%d %H:%M:%S'), try_strptime(x, '%m/%d/%Y'))) AS INTEGER) AS yr FROM s""")
def timestamp_fallback(t: Tables) -> DataFrame:
    """The first format that parses, NULL if none does."""
    x = case_first([(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), (F.col("event_id") % 3 == 1, F.date_format("ts", "MM/dd/yyyy"))], "unknown")
    rows = t.events.select("event_id", x.alias("x")).withColumn("ts", text.first_timestamp(("x", "yyyy-MM-dd HH:mm:ss"), ("x", "MM/dd/yyyy")))
    return rows.select("event_id", "ts", F.year("ts").alias("yr"))


@query("""WITH s AS (SELECT event_type, event_id, CASE WHEN event_type = 'click' THEN epoch_ms(ts) // 1000 ELSE epoch_ms(ts) END AS x FROM events),
m AS (SELECT event_type, median(year(make_timestamp(CAST(x AS BIGINT) * 1000))) < 1990 AS seconds FROM s GROUP BY event_type)
SELECT event_id, CAST(CASE WHEN seconds THEN x * 1000 ELSE x END AS BIGINT) // 86400000 AS day FROM s JOIN m USING (event_type)""")
def epoch_autodetect(t: Tables) -> DataFrame:
    """Numbers that as milliseconds lie before 1990 in the median are seconds."""
    s = t.events.select("event_type", "event_id", F.when(F.col("event_type") == "click", F.unix_seconds(F.col("ts").cast("timestamp"))).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("x"))
    m = s.groupBy("event_type").agg((F.median(F.year(F.timestamp_millis("x"))) >= 1990).alias("ms"))
    return s.join(m, "event_type").select("event_id", F.floor(F.unix_millis(text.epoch("x", F.col("ms"))) / 86400000).alias("day"))


@query("SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY ALL")
def month_names(t: Tables) -> DataFrame:
    """Months back from their names, long or short."""
    name = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "MMMM")).otherwise(F.upper(F.date_format("o_orderdate", "MMM")))
    return t.orders.groupBy(text.month_number(name).alias("month")).agg(F.count("*").alias("n"))


@query(f"SELECT cust, yr, json_object('n', n, 'months', months)::VARCHAR AS diagnostics FROM {PANEL}")
def json_diagnostics(t: Tables) -> DataFrame:
    """Diagnostics of a row as JSON."""
    return panel(t).select("cust", "yr", F.to_json(F.struct("n", "months")).alias("diagnostics"))


@query(f"SELECT cust, yr, arg_max(lane, (months, n, amount, lane)) AS first_lane, count(*) AS lanes FROM {CANDIDATES} GROUP BY cust, yr, prio HAVING prio = '1-URGENT'")
def first_of_structs(t: Tables) -> DataFrame:
    """The first struct of a sorted array."""
    lanes = F.sort_array(F.collect_list(F.struct("months", "n", "amount", "lane")), asc=False)
    return candidates(t).filter("prio = '1-URGENT'").groupBy("cust", "yr").agg(F.element_at(lanes, 1)["lane"].alias("first_lane"), F.count("*").alias("lanes"))


@query("""WITH a AS (SELECT s_suppkey, nullif(s_suppkey % 4, 0) AS k FROM supplier), b AS (SELECT nullif(n_nationkey % 4, 0) AS k, count(*) AS n FROM nation GROUP BY ALL)
SELECT s_suppkey, a.k, n FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def null_key_join(t: Tables) -> DataFrame:
    """A join in which a NULL key meets a NULL key."""
    a = t.supplier.select("s_suppkey", F.nullif(F.col("s_suppkey") % 4, F.lit(0)).alias("k"))
    b = t.nation.groupBy(F.nullif(F.col("n_nationkey") % 4, F.lit(0)).cast("long").alias("k")).agg(F.count("*").alias("n"))
    return rel.null_safe_join(a, b, ["k"], "left")


@query("SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS nation FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier")
def schema_aligned_union(t: Tables) -> DataFrame:
    """A union by name, columns that a side lacks as NULL."""
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")), allowMissingColumns=True)


@query("SELECT c_custkey, greatest(c_acctbal, 0) AS balance, CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE 0 END AS clamped FROM customer")
def negative_clamp(t: Tables) -> DataFrame:
    """Negative values to 0, the amount kept in a column of its own."""
    return rel.clamp_negative(t.customer, "c_acctbal", "clamped").select("c_custkey", F.col("c_acctbal").alias("balance"), "clamped")


@query("""SELECT c_custkey, greatest(coalesce(max(n) FILTER (WHERE lane = 'F'), 0), coalesce(max(n) FILTER (WHERE lane = 'O'), 0), 1)::BIGINT AS most FROM customer LEFT JOIN """ + CANDIDATES + """ ON cust = c_custkey GROUP BY c_custkey""")
def greatest_of_nullable(t: Tables) -> DataFrame:
    """The greatest of several that may be NULL, at least 1."""
    lanes = candidates(t).groupBy(F.col("cust").alias("c_custkey")).agg(*[F.max(F.when(F.col("lane") == x, F.col("n"))).alias(x) for x in "FO"])
    return t.customer.select("c_custkey").join(lanes, "c_custkey", "left").select("c_custkey", F.greatest(*[F.coalesce(x, F.lit(0)) for x in "FO"], F.lit(1)).cast("long").alias("most"))


@query(f"SELECT cust, arg_min(CASE WHEN months >= 3 THEN n END, yr) AS n, min(yr) FILTER (WHERE months >= 3) AS yr FROM {PANEL} GROUP BY cust")
def first_known_value(t: Tables) -> DataFrame:
    """The first value that is known, in order of the year."""
    known = F.when(F.col("months") >= 3, F.col("n"))
    return panel(t).groupBy("cust").agg(F.min_by(known, F.when(known.isNotNull(), F.col("yr"))).alias("n"), F.min(F.when(known.isNotNull(), F.col("yr"))).alias("yr"))


@query(f"""WITH d AS (SELECT cust, y, pop, nation, CASE WHEN nation > 0 THEN pop / (nation * nation) END AS d FROM {CUST}) SELECT cust, round(d, 6) AS density, round(ln(1 + d), 6) AS log_density, y > 0 AS present,
  CASE WHEN d >= 100 THEN 'urban' WHEN d >= 10 THEN 'suburban' ELSE 'rural' END AS band FROM d""")
def density_bands(t: Tables) -> DataFrame:
    """Density, its log, a presence flag and bands of it, an area of 0 being rural."""
    d = units(t).withColumn("d", rates.density("pop", F.col("nation") * F.col("nation")))
    return d.select("cust", r("d").alias("density"), r(F.log1p("d")).alias("log_density"), (F.col("y") > 0).alias("present"), rates.band("d", [(100, "urban"), (10, "suburban")], "rural").alias("band"))


@query(f"""SELECT cust, greatest(pop + 40.0 * y - 300, pop) AS daytime, coalesce(CASE WHEN nation % 2 = 0 THEN pop * 0.5 END, 0.0 * y + 1.0 * y + 2.0 * y) AS vehicles,
  CASE WHEN 500.0 * y >= 5000 THEN least(pop + 400 * y, 3.0 * pop) ELSE pop + 400 * y END AS exposure FROM {CUST}""")
def exposures(t: Tables) -> DataFrame:
    """Daytime population, vehicles, and the cap at places with many registered jobs."""
    u = units(t)
    return u.select(
        "cust", rates.daytime("pop", 40.0 * F.col("y"), F.lit(300)).alias("daytime"), rates.vehicles(F.when(F.col("nation") % 2 == 0, F.col("pop") * 0.5), ["y", "y", "y"]).alias("vehicles"),
        rates.capped_exposure(F.col("pop") + 400 * F.col("y"), "pop", 500.0 * F.col("y")).alias("exposure"),
    )


@query("""SELECT o_orderpriority AS offense, o_orderstatus = 'F' AS covered, CASE WHEN o_orderstatus = 'F' THEN 1.0 WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0.0 WHEN o_orderpriority = '3-MEDIUM' THEN 0.5 ELSE 1.0 END::DOUBLE AS tau, count(*) AS n FROM orders GROUP BY ALL""")
def temper_policy(t: Tables) -> DataFrame:
    """How far shares are tilted, by offense and coverage."""
    rows = t.orders.withColumns({"offense": F.col("o_orderpriority"), "covered": F.col("o_orderstatus") == "F"})
    return rows.withColumn("tau", rates.temper("offense", "covered", ["1-URGENT", "2-HIGH"], ["3-MEDIUM"])).groupBy("offense", "covered", "tau").agg(F.count("*").alias("n"))


@query(f"SELECT brand, round(sum(price), 4) AS target, sum(q) AS reported, round(greatest(sum(price) - sum(q), 0), 4) AS gap, round(sum(q) / nullif(sum(price), 0), 9) AS ratio FROM {PARTS} GROUP BY brand")
def target_gap(t: Tables) -> DataFrame:
    """What is missing to a target, and the ratio."""
    g = parts(t).groupBy("brand").agg(F.sum("price").alias("target"), F.sum("q").alias("reported"))
    return g.select("brand", r("target", 4).alias("target"), "reported", r(rates.gap("target", "reported"), 4).alias("gap"), r(ratio("reported", "target"), 9).alias("ratio"))


@query(f"SELECT cust, round((exp(greatest(least(ln(1 + 1e5 * y / pop), 12), 0)) - 1) / 1e5 * pop, 6) AS prior FROM {CUST}")
def prior_from_log_rate(t: Tables) -> DataFrame:
    """Counts from a log rate."""
    return units(t).select("cust", r(rates.from_log_rate(F.log1p(1e5 * F.col("y") / F.col("pop")), "pop")).alias("prior"))


@query(f"""WITH n AS (SELECT 1e5 * sum(y) / sum(pop) AS nat FROM {CUST}), u AS (SELECT *, 1e5 * y / pop AS rate, 100 * (1e5 * y / pop) / nat AS idx FROM {CUST} CROSS JOIN n)
SELECT cust, pop / 300 >= 5 AND idx >= 150 AS transient, nation % 2 / 1.0 > 0.5 AND NOT (seg = 'BUILDING') AND rate * 0.9 >= 1.2 * nat AS blind FROM u""")
def publication_guards(t: Tables) -> DataFrame:
    """Places of transients, and places whose model sees no ambient population."""
    u = units(t)
    nat = u.agg((1e5 * F.sum("y") / F.sum("pop")).alias("nat"))
    x = u.crossJoin(F.broadcast(nat)).withColumn("rate", 1e5 * F.col("y") / F.col("pop"))
    return x.select(
        "cust", rates.transient("pop", F.lit(300), 100 * F.col("rate") / F.col("nat"), 5.0, 150.0).alias("transient"),
        rates.ambient_blind(F.col("nation") % 2, F.col("seg") == "BUILDING", 0.9 * F.col("rate"), "nat", 0.5, 1.2).alias("blind"),
    )
