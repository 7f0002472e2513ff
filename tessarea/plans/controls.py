"""Controls, exposure partitions, silent units, feature blocks and coverage on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.operators import controls, expect, rel
from tessarea.plans.publish import CUST, PARTS, parts, units
from tessarea.plans.registry import CANDIDATES, Tables, candidates, query, r

UNITS = f"(SELECT cust, nation, seg, pop, y, CASE WHEN cust % 3 = 0 THEN 0.25 ELSE 0.75 END AS share FROM {CUST})"


@query(f"""SELECT 'municipal' AS unit_kind, nation::VARCHAR AS unit_id, round(sum(share * pop), 6)::DOUBLE AS population FROM {UNITS} WHERE seg = 'BUILDING' GROUP BY nation
UNION ALL SELECT 'county', (nation % 5)::VARCHAR, round(sum(share * pop), 6) FROM {UNITS} WHERE seg <> 'BUILDING' GROUP BY nation % 5""")
def exposure_partition(t: Tables) -> DataFrame:
    """Municipal units and county remainders that together hold the population (H5)."""
    u = units(t).withColumns({"kind": F.when(F.col("seg") == "BUILDING", "municipal").otherwise("other"), "county": F.col("nation") % 5, "share": F.when(F.col("cust") % 3 == 0, 0.25).otherwise(0.75)})
    return controls.exposure_partition(u, "nation", "kind", "county", "share", "pop").withColumn("population", r("population"))


@query(f"SELECT nation, seg, count(*) AS silent_agencies FROM {CUST} GROUP BY ALL HAVING NOT bool_or(y > 22) AND NOT bool_or(pop > 1970) AND NOT bool_or(cust % 97 = 0)")
def silent_ledger(t: Tables) -> DataFrame:
    """Units in which nothing is reported, filled or exempt (H7)."""
    return controls.silent_units(units(t), ["nation", "seg"], F.col("y") > 22, F.col("pop") > 1970, F.col("cust") % 97 == 0)


@query(f"""WITH c AS (SELECT nation, seg, sum(y)::DOUBLE AS n FROM {CUST} GROUP BY ALL), i AS (SELECT nation, seg, round(sum(pop) * 0.01, 6) AS m FROM {CUST} WHERE seg = 'BUILDING' GROUP BY ALL)
SELECT nation, seg, round(n + coalesce(m, 0), 6) AS n, CASE WHEN m > 0 THEN 'imputed' ELSE 'reported' END AS label, coalesce(m, 0) AS landed FROM c LEFT JOIN i USING (nation, seg)""")
def landed_controls(t: Tables) -> DataFrame:
    """Imputed mass on the controls of its key, each row's parts and the sums checked (G8, H10, L)."""
    u = units(t)
    held = u.groupBy("nation", "seg").agg(F.sum("y").cast("double").alias("n")).withColumns({"label": F.lit("reported"), "before": F.col("n")})
    imputed = u.filter("seg = 'BUILDING'").groupBy("nation", "seg").agg(r(F.sum("pop") * 0.01).alias("m"))
    out = controls.land_on_controls(held, imputed, ["nation", "seg"], "n", "m", "label")
    expect.all_hold(out, identity=F.abs(F.col("n") - F.col("before") - F.col("landed")) < 1e-9)
    return out.select("nation", "seg", r("n").alias("n"), "label", "landed")


@query(f"""WITH a AS (SELECT nation, seg, sum(y) / sum(pop) AS q FROM {CUST} GROUP BY ALL HAVING count(*) >= 3), b AS (SELECT sum(y) / sum(pop) AS q, least(greatest(median(pop), 1200), 1400) AS p FROM {CUST})
SELECT cust, round(1e5 * (y + coalesce(a.q, b.q) * p) / (pop + p), 6) AS rate, CASE WHEN a.q IS NULL THEN 'national' ELSE 'peers' END AS prior_source FROM {CUST} LEFT JOIN a USING (nation, seg) CROSS JOIN b""")
def pooled_sparse_rate(t: Tables) -> DataFrame:
    """Sparse targets pooled with the most specific prior."""
    out = controls.pooled_sparse_rate(units(t), [(["nation", "seg"], 3, "peers"), ([], 1, "national")], "y", "pop", 1200.0, 1400.0)
    return out.select("cust", r(1e5 * F.col("pooled_rate")).alias("rate"), "prior_source")


@query("""WITH a AS (SELECT l_returnflag AS k, sum(l_quantity) AS own FROM lineitem GROUP BY ALL), b AS (SELECT l_returnflag AS k, sum(l_quantity) * 1.1 AS other FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL)
SELECT l_suppkey, k, round(q * coalesce(other / own, 1), 6) AS calibrated FROM (SELECT l_suppkey, l_returnflag AS k, sum(l_quantity) AS q FROM lineitem GROUP BY ALL) LEFT JOIN a USING (k) LEFT JOIN b USING (k)""")
def calibration_twin(t: Tables) -> DataFrame:
    """Counts scaled to another source's totals."""
    x = t.lineitem.withColumnRenamed("l_returnflag", "k")
    own = x.groupBy("k").agg(F.sum("l_quantity").alias("total"))
    other = x.filter("k <> 'N'").groupBy("k").agg((F.sum("l_quantity") * 1.1).alias("total"))
    out = controls.calibrated(x.groupBy("l_suppkey", "k").agg(F.sum("l_quantity").alias("q")), own, other, ["k"], "q", "total")
    return out.select("l_suppkey", "k", r("calibrated").alias("calibrated"))


@query(f"WITH s AS (SELECT brand, sum(q) AS s FROM {PARTS} GROUP BY brand) SELECT part, brand, round_even(q * CASE WHEN brand <> 'Brand#1' THEN 2001.0 / s ELSE 1 END, 1) AS scaled FROM {PARTS} JOIN s USING (brand)")
def half_even_control(t: Tables) -> DataFrame:
    """Scaled to a control and rounded half to even; a parent without control stays."""
    p = parts(t)
    control = p.filter("brand <> 'Brand#1'").select("brand").distinct().withColumn("target", F.lit(2001.0))
    return controls.scale_to_control(p, control, ["brand"], "q", "target", 1).select("part", "brand", "scaled")


@query("""WITH a AS (SELECT c_nationkey AS k, count(*)::DOUBLE AS customers FROM customer WHERE c_nationkey % 3 > 0 GROUP BY ALL), b AS (SELECT s_nationkey AS k, count(*)::DOUBLE AS suppliers FROM supplier GROUP BY ALL)
SELECT k, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM a FULL JOIN b USING (k)""")
def feature_merge(t: Tables) -> DataFrame:
    """Features of several sources on one key, lacking ones 0."""
    a = t.customer.filter("c_nationkey % 3 > 0").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    return controls.outer_merge([a, t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))], ["k"])


@query("SELECT c_custkey, CASE WHEN c_nationkey >= 20 THEN '9' || c_nationkey ELSE c_nationkey::VARCHAR END AS geo FROM customer UNION ALL SELECT NULL, (n_nationkey + 500)::VARCHAR FROM nation")
def relabelled_and_backfilled(t: Tables) -> DataFrame:
    """Old keys to new, their coarser keys one to one, and registry rows that are lacking."""
    walk = t.nation.filter("n_nationkey >= 20").select(F.col("n_nationkey").cast("string").alias("old"), F.concat(F.lit("9"), F.col("n_nationkey").cast("string")).alias("new"))
    rows = controls.relabel(t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("geo")), walk, "geo", "old", "new", 1)
    return controls.backfill(rows, t.nation.select((F.col("n_nationkey") + 500).cast("string").alias("geo")), ["geo"])


@query(f"SELECT cust, round(least(greatest(y / nullif(pop, 0), 0), 1), 9) AS busy, round(pop / nullif(y, 0), 6) AS per_event, round(ln(1 + pop), 9) AS log_pop FROM {CUST}")
def derived_shares(t: Tables) -> DataFrame:
    """Ratios and logs, each only if its inputs are there (I16)."""
    out = controls.share_block(units(t), {"busy": ("y", "pop", True), "per_event": ("pop", "y", False), "other": ("lacking", "pop", True)}, ["pop", "absent"])
    return out.select("cust", r("busy", 9).alias("busy"), r("per_event").alias("per_event"), r("log_pop", 9).alias("log_pop"))


@query(f"""WITH u AS (SELECT *, CASE WHEN cust % 4 > 0 THEN y * 10 / pop END AS own FROM {CUST}), c AS (SELECT nation, sum(y) * 10 / sum(pop) AS county FROM u WHERE seg = 'BUILDING' GROUP BY nation), n AS (SELECT sum(y) * 10 / sum(pop) AS nat FROM u)
SELECT cust, round(CASE WHEN nation % 3 = 0 THEN coalesce(county, own, nat) ELSE coalesce(own, nat) END, 9) AS share FROM u LEFT JOIN c USING (nation) CROSS JOIN n""")
def commute_share_ladder(t: Tables) -> DataFrame:
    """The county's ratio, else one's own, else the nation's."""
    u = units(t).withColumn("own", F.when(F.col("cust") % 4 > 0, F.col("y") * 10 / F.col("pop")))
    county = u.filter("seg = 'BUILDING' AND nation % 3 = 0").groupBy("nation").agg((F.sum("y") * 10 / F.sum("pop")).alias("county"))
    nat = u.agg((F.sum("y") * 10 / F.sum("pop")).alias("nat"))
    return u.join(county, "nation", "left").crossJoin(nat).select("cust", r(F.coalesce("county", "own", "nat"), 9).alias("share"))


@query("SELECT unnest(['l_quantity', 'l_tax', 'l_discount']) AS feature")
def useful_features(t: Tables) -> DataFrame:
    """Features that are known, vary and aren't twice there; ones of unknown class would stop the job."""
    x = t.lineitem.withColumns({"constant": F.lit(1.0), "l_quantity_again": F.col("l_quantity"), "never": F.lit(None).cast("double"), "row": F.col("l_orderkey") * 8 + F.col("l_linenumber")})
    names = ["l_quantity_again", "l_quantity", "l_tax", "l_discount", "constant", "never", "l_extendedprice"]
    names = controls.useful_features(x, names, protected=["l_extendedprice"])
    names = controls.by_policy(controls.distinct_columns(x, names, "row"), dict.fromkeys(names, "shared"), ["shared"])
    return t.spark.createDataFrame([(n,) for n in names], "feature string")


@query(f"SELECT cust, yr, round(sum(n) FILTER (WHERE lane = 'F'), 6)::DOUBLE AS mu_f, round(sum(n) FILTER (WHERE lane <> 'F'), 6)::DOUBLE AS co_n, coalesce(sum(n), 0)::DOUBLE AS total FROM {CANDIDATES} GROUP BY cust, yr")
def prefixed_split(t: Tables) -> DataFrame:
    """Two kinds side by side under prefixes."""
    lane = F.col("lane") == "F"
    return candidates(t).groupBy("cust", "yr").agg(F.sum(F.when(lane, F.col("n"))).cast("double").alias("mu_f"), F.sum(F.when(~lane, F.col("n"))).cast("double").alias("co_n"), F.sum("n").cast("double").alias("total"))


@query("SELECT l_suppkey AS supp, count(DISTINCT l_partkey % 4) AS kinds, round(sum(w), 6)::DOUBLE AS total FROM (SELECT *, 1.0 / count(*) OVER (PARTITION BY l_suppkey) AS w FROM lineitem) GROUP BY ALL")
def weight_partition(t: Tables) -> DataFrame:
    """A bridge whose weights sum to 1 for each key, as is checked before it is used (G10, L)."""
    bridge = t.lineitem.groupBy(F.col("l_suppkey").alias("supp"), (F.col("l_partkey") % 4).alias("kind")).agg(F.count("*").alias("n"))
    bridge = rel.share_of_group(bridge, ["supp"], "n", "w")
    expect.sums_to(bridge, ["supp"], "w")
    return bridge.groupBy("supp").agg(F.count("*").alias("kinds"), r(F.sum("w")).alias("total"))


@query("""WITH e AS (SELECT event_id, event_type, user_id % 20 AS place, CASE WHEN user_id % 20 IN (3, 7) AND event_type = 'click' THEN true WHEN user_id % 20 = 5 THEN true ELSE false END AS bad FROM events)
SELECT event_id, CASE WHEN event_type = 'view' AND place < 10 THEN 'deny' WHEN place = 4 THEN 'deny' ELSE 'allow' END AS texture FROM e WHERE NOT bad""")
def quarantine_and_texture(t: Tables) -> DataFrame:
    """Quarantined points by place, for one offense or any; then allow or deny by row, place or default."""
    e = t.events.select("event_id", "event_type", (F.col("user_id") % 20).alias("place"))
    bad = t.spark.createDataFrame([(3, "click"), (7, "click"), (5, "any")], "place long, event_type string")
    clean = rel.members(rel.members(e, bad, ["place", "event_type"], inside=False), bad.filter("event_type = 'any'"), ["place"], inside=False)
    rows = t.spark.createDataFrame([(i, "view", "deny") for i in range(10)], "place long, event_type string, by_row string")
    places = t.spark.createDataFrame([(4, "deny")], "place long, by_place string")
    return clean.join(rows, ["place", "event_type"], "left").join(places, "place", "left").select("event_id", F.coalesce("by_row", "by_place", F.lit("allow")).alias("texture"))


@query("""WITH w AS (SELECT upper(trim(unnest(string_split(v, '|')))) AS code, label, inc FROM (VALUES ('click|view', 'seen', true), (' purchase ', 'bought', true), ('error', 'fault', false)) AS x(v, label, inc))
SELECT event_id, label FROM events JOIN w ON upper(event_type) = code WHERE inc""")
def value_list_crosswalk(t: Tables) -> DataFrame:
    """Codes listed in one field, matched in upper case, with an include flag."""
    walk = t.spark.createDataFrame([("click|view", "seen", True), (" purchase ", "bought", True), ("error", "fault", False)], "v string, label string, inc boolean")
    codes = walk.filter("inc").select(F.explode(F.split("v", r"\|")).alias("code"), "label").select(F.upper(F.trim("code")).alias("code"), "label")
    return t.events.withColumn("code", F.upper("event_type")).join(codes, "code").select("event_id", "label")
