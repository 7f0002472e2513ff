"""Lanes with supplements, twin and succession ledgers, overrides and usability on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.operators import expect, ledgers, rel
from tessarea.plans.registry import CANDIDATES, PANEL, Tables, candidates, panel, query, r


@query(f"""WITH l AS (SELECT cust, yr, lane, max(months) AS m, sum(n) AS s FROM {CANDIDATES} GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY cust, yr ORDER BY m DESC, s DESC, lane) - 1 AS rk FROM l)
SELECT cust, yr, prio, arg_min(c.lane, rk) AS lane, arg_min(n, rk) AS n, min(rk) > 0 AS supplement FROM {CANDIDATES} c JOIN k USING (cust, yr, lane) GROUP BY cust, yr, prio""")
def lane_supplement_walk(t: Tables) -> DataFrame:
    """One lane per customer and year; priorities that it lacks from the next ranked lane that has them."""
    signals = {"m": F.max("months"), "s": F.sum("n")}
    out = ledgers.supplement_walk(candidates(t), ["cust", "yr"], "prio", "lane", "n", signals, [F.desc("m"), F.desc("s"), F.asc("lane")])
    # Within a customer and year only supplements may come from a second lane.
    expect.functional(out.filter("NOT supplement").select(F.concat_ws(":", "cust", "yr").alias("entity"), "lane"), "entity", "lane")
    return out


WIDE_LANES = f"(SELECT cust, yr, sum(n) FILTER (WHERE lane = 'F') AS f, sum(n) FILTER (WHERE lane = 'O') AS o, max(months) AS months, arg_max(lane, (n, lane)) AS chosen FROM {CANDIDATES} GROUP BY cust, yr)"


def wide_lanes(t: Tables) -> DataFrame:
    lane = lambda x: F.sum(F.when(F.col("lane") == x, F.col("n")))
    return candidates(t).groupBy("cust", "yr").agg(lane("F").alias("f"), lane("O").alias("o"), F.max("months").alias("months"), F.max_by("lane", F.struct("n", "lane")).alias("chosen"))


@query(f"""SELECT cust, yr, chosen, CAST(CASE chosen WHEN 'F' THEN f WHEN 'O' THEN o END AS BIGINT) AS value, coalesce(f = o AND months >= 2 AND (f IS NULL OR f <> yr % 3), false) AS equal_lanes FROM {WIDE_LANES}""")
def value_of_chosen_lane(t: Tables) -> DataFrame:
    """The column that the chosen lane names, and a witness by the other lane."""
    w = wide_lanes(t)
    witness = ledgers.corroborated(F.col("f"), F.col("o"), F.col("months") + 10, F.when(F.col("f") != F.col("yr") % 3, F.lit(None).cast("long")).otherwise(F.col("f")))
    return w.select("cust", "yr", "chosen", ledgers.by_label("chosen", {"F": "f", "O": "o"}).alias("value"), witness.alias("equal_lanes"))


@query(f"SELECT cust, yr, n > 0 AS supported, months * 3 BETWEEN 1 AND 11 AND n >= months AS true_partial, months * 3 >= 12 AS usable FROM {PANEL}")
def reporting_support_flags(t: Tables) -> DataFrame:
    """Supported, partly and wholly reported years, the last two never together."""
    out = panel(t).select("cust", "yr", *[x.alias(n) for n, x in ledgers.support_flags(F.col("months") * 3, F.col("n"), F.col("n") >= F.col("months")).items()])
    expect.all_hold(out, exclusive=~(F.col("true_partial") & F.col("usable")))
    return out


VECTORS = """(SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS yr, o_custkey // 100 AS stem, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS vec FROM orders GROUP BY ALL)"""


def vectors(t: Tables) -> DataFrame:
    vec = F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|")
    return t.orders.groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yr"), F.floor(F.col("o_custkey") / 100).alias("stem")).agg(vec.alias("vec"))


TWINS = f"""(WITH g AS (SELECT stem, yr, vec, min(cust) AS canonical FROM {VECTORS} GROUP BY ALL)
SELECT cust AS variant, canonical, count(*) AS years FROM {VECTORS} JOIN g USING (stem, yr, vec) WHERE cust <> canonical GROUP BY ALL HAVING count(*) >= 2)"""


@query(f"SELECT variant, canonical, years FROM {TWINS}")
def twin_ledger(t: Tables) -> DataFrame:
    """Entities whose vectors equal another's in two years or more."""
    return ledgers.twin_ledger(vectors(t), "cust", "yr", ["stem"], "vec", 2)


@query(f"""WITH l AS (SELECT variant, min(canonical) AS canonical FROM {TWINS} GROUP BY variant), k AS (SELECT coalesce(l.canonical, p.cust) AS cust, p.yr, p.n, p.months, p.amount, p.cust AS was FROM {PANEL} p LEFT JOIN l ON p.cust = l.variant)
SELECT cust, yr, n, months, was <> cust AS rekeyed FROM (SELECT *, row_number() OVER (PARTITION BY cust, yr ORDER BY months DESC, n DESC, amount DESC, was) AS k FROM k) WHERE k = 1""")
def rekey_and_dedupe(t: Tables) -> DataFrame:
    """Keys by the ledger, each with one canonical entity, then the best row of each key."""
    ledger = ledgers.twin_ledger(vectors(t), "cust", "yr", ["stem"], "vec", 2).groupBy("variant").agg(F.min("canonical").alias("canonical"))
    rows = ledgers.rekey(panel(t).withColumn("was", F.col("cust")), ledger, "cust")
    return rel.top1(rows, ["cust", "yr"], [F.desc("months"), F.desc("n"), F.desc("amount"), F.asc("was")]).select("cust", "yr", "n", "months", "rekeyed")


@query("SELECT s_suppkey // 2 AS case_id, count(DISTINCT s_nationkey % 3) = 1 AS applies FROM supplier GROUP BY ALL")
def adjudicated_merges(t: Tables) -> DataFrame:
    """Merges whose members share a footprint apply, others are set aside."""
    return ledgers.mass_neutral(t.supplier.select(F.floor(F.col("s_suppkey") / 2).alias("case_id"), (F.col("s_nationkey") % 3).alias("footprint")), "case_id", "footprint")


@query("""WITH a AS (SELECT c_custkey AS k, c_custkey // 10 AS v FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT c_custkey AS k, c_custkey // 10 AS v FROM customer WHERE c_custkey % 3 = 0)
SELECT k, coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NULL THEN 'registry' WHEN b.v IS NULL THEN 'rule' ELSE 'both' END AS source FROM a FULL JOIN b USING (k)""")
def combined_ledgers(t: Tables) -> DataFrame:
    """A rule's and a registry's ledger as one; disagreement would stop the job."""
    rows = t.customer.select(F.col("c_custkey").alias("k"), F.floor(F.col("c_custkey") / 10).alias("v"))
    return ledgers.combine(rows.filter("k % 2 = 0"), rows.filter("k % 3 = 0"), "k", "v")


@query(f"""WITH g AS (SELECT c_custkey AS cust, 2000 AS yr, 6::BIGINT AS months FROM customer WHERE c_custkey % 5 = 0) SELECT p.cust, p.yr, p.n, coalesce(g.months, p.months) AS months, g.months IS NOT NULL AS overridden FROM {PANEL} p LEFT JOIN g ON p.cust = g.cust AND p.yr = g.yr""")
def regime_overrides(t: Tables) -> DataFrame:
    """A registry's values over those found."""
    registry = t.customer.filter("c_custkey % 5 = 0").select(F.col("c_custkey").alias("cust"), F.lit(2000).alias("yr"), F.lit(6).cast("long").alias("months"))
    return ledgers.override(panel(t), registry, ["cust", "yr"], ["months"]).select("cust", "yr", "n", "months", "overridden")


@query(f"""WITH d AS (SELECT cust, CASE WHEN cust % 7 = 0 THEN 'reject' WHEN cust % 11 = 0 THEN 'months' END AS directive FROM (SELECT DISTINCT cust FROM {PANEL}))
SELECT cust, yr, CASE WHEN directive = 'months' THEN least(months, 2) ELSE months END AS months, coalesce(directive <> 'reject', true) AND CASE WHEN directive = 'months' THEN least(months, 2) ELSE months END >= 3 AS usable FROM {PANEL} JOIN d USING (cust)""")
def usability_directives(t: Tables) -> DataFrame:
    """Directives that reject a year or say how many months are believable."""
    rows = panel(t).withColumn("directive", F.when(F.col("cust") % 7 == 0, "reject").when(F.col("cust") % 11 == 0, "months"))
    months = F.when(F.col("directive") == "months", F.least("months", F.lit(2))).otherwise(F.col("months"))
    return rows.select("cust", "yr", months.alias("months"), (F.coalesce(F.col("directive") != "reject", F.lit(True)) & (months >= 3)).alias("usable"))


@query(f"""WITH s AS (SELECT cust, max(yr) AS last FROM {PANEL} GROUP BY cust), f AS (SELECT DISTINCT o_custkey AS cust, o_orderkey % 40 AS unit FROM orders), u AS (SELECT f.*, last < 2001 - 2 AS dead FROM f JOIN s USING (cust)),
c AS (SELECT a.cust AS dead, b.cust AS live, count(*) AS shared FROM u a JOIN u b ON a.unit = b.unit AND a.dead AND NOT b.dead GROUP BY ALL), z AS (SELECT cust AS dead, count(*) AS size FROM u WHERE dead GROUP BY cust)
SELECT dead, min(live) AS live FROM c JOIN z USING (dead) WHERE shared = size GROUP BY dead""")
def exclusive_succession(t: Tables) -> DataFrame:
    """Silent entities whose whole footprint a live one covers."""
    footprint = t.orders.select(F.col("o_custkey").alias("cust"), (F.col("o_orderkey") % 40).alias("unit")).distinct()
    return ledgers.succession(panel(t).groupBy("cust").agg(F.max("yr").alias("last")), footprint, "cust", "unit", 2001)


ANNUAL = f"(SELECT *, n * 12.0 / months AS annual, max(n) OVER (PARTITION BY cust) AS most FROM {PANEL})"


@query(f"""WITH t AS (SELECT cust, sum(annual - n) AS up, max(most) AS m FROM {ANNUAL} GROUP BY cust) SELECT cust, yr, round(CASE WHEN up > 12 * m THEN n * 2.0 ELSE annual END, 6) AS value, up > 12 * m AS capped FROM {ANNUAL} JOIN t USING (cust)""")
def uplift_sanity_cap(t: Tables) -> DataFrame:
    """Entities whose uplift is out of proportion take the ladder's estimate."""
    p = panel(t)
    rows = p.join(p.groupBy("cust").agg(F.max("n").alias("most")), "cust").withColumns({"annual": F.col("n") * 12.0 / F.col("months"), "ladder": F.col("n") * 2.0})
    return ledgers.sane_or_ladder(rows, ["cust"], "n", "annual", "ladder", "most", 12.0).select("cust", "yr", r("value").alias("value"), "capped")


@query(f"""WITH b AS (SELECT cust, yr, n, n >= 3 AND months <= 1 AS batch FROM {PANEL}), h AS (SELECT cust, median(n) AS ref, count(*) AS years FROM b WHERE NOT batch AND yr < 2000 GROUP BY cust), c AS (SELECT cust, n FROM b WHERE yr = 2000)
SELECT cust, n, ref, CASE WHEN n < 0.75 * ref THEN 'ladder' WHEN ref IS NULL THEN 'no_history' ELSE 'keep' END AS step FROM c LEFT JOIN h USING (cust)""")
def reference_hygiene(t: Tables) -> DataFrame:
    """Years that the batch detector flags are no reference; a year far below the clean reference goes to the ladder."""
    b = panel(t).withColumn("batch", (F.col("n") >= 3) & (F.col("months") <= 1))
    clean = rel.members(b.filter("yr < 2000"), b.filter("batch"), ["cust", "yr"], inside=False)
    h = clean.groupBy("cust").agg(F.median("n").alias("ref"))
    step = F.when(F.col("n") < 0.75 * F.col("ref"), "ladder").when(F.col("ref").isNull(), "no_history").otherwise("keep")
    return b.filter("yr = 2000").join(h, "cust", "left").select("cust", "n", "ref", step.alias("step"))


@query(f"""WITH p AS (SELECT c_custkey AS cust, coalesce(max(n) FILTER (WHERE yr < 2000), 0) AS history, coalesce(sum(n) FILTER (WHERE yr = 2000), 0) AS now FROM customer LEFT JOIN {PANEL} ON cust = c_custkey GROUP BY c_custkey)
SELECT cust, history, now::BIGINT AS now, CASE WHEN now = 0 THEN history END AS fill FROM p WHERE NOT (history = 0 AND now = 0) AND cust NOT IN (SELECT variant FROM {TWINS})""")
def silent_and_superseded(t: Tables) -> DataFrame:
    """Rows without history or report, and superseded ones, go; a fill stands only where nothing is reported."""
    old, new = F.when(F.col("yr") < 2000, F.col("n")), F.when(F.col("yr") == 2000, F.col("n"))
    p = panel(t).groupBy("cust").agg(F.coalesce(F.max(old), F.lit(0)).alias("history"), F.coalesce(F.sum(new), F.lit(0)).alias("now"))
    superseded = ledgers.twin_ledger(vectors(t), "cust", "yr", ["stem"], "vec", 2).select(F.col("variant").alias("cust"))
    out = rel.members(p.filter("history > 0 OR now > 0"), superseded, ["cust"], inside=False).withColumn("fill", F.when(F.col("now") == 0, F.col("history")))
    ledgers.no_fill_where_reported(out, F.col("fill").isNotNull(), F.col("now") > 0, F.lit(False))
    return out


@query(f"""WITH u AS (SELECT c_custkey AS cust, c_nationkey AS st, c_custkey % 3 AS band, count(o_orderkey) AS y, 1000.0 + c_custkey % 977 AS pop FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
a AS (SELECT st, band, sum(y) / sum(pop) AS q FROM u GROUP BY ALL HAVING count(*) >= 3), b AS (SELECT st, sum(y) / sum(pop) AS q FROM u GROUP BY ALL HAVING count(*) >= 5), c AS (SELECT sum(y) / sum(pop) AS q FROM u)
SELECT cust, round(pop * coalesce(a.q, b.q, c.q), 6) AS expected, CASE WHEN a.q IS NOT NULL THEN 'band' WHEN b.q IS NOT NULL THEN 'state' ELSE 'national' END AS source FROM u LEFT JOIN a USING (st, band) LEFT JOIN b USING (st) CROSS JOIN c""")
def peer_rate_fallback(t: Tables) -> DataFrame:
    """The rate of the most specific peers that are enough: state and band, state, nation."""
    y = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("y"))
    u = t.customer.join(y, "c_custkey", "left").select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("st"), (F.col("c_custkey") % 3).alias("band"), F.coalesce("y", F.lit(0)).alias("y"), (1000.0 + F.col("c_custkey") % 977).alias("pop"))
    out = rel.most_specific_rate(u, [(["st", "band"], 3, "band"), (["st"], 5, "state"), ([], 1, "national")], "y", "pop", "rate")
    return out.select("cust", r(F.col("pop") * F.col("rate")).alias("expected"), F.col("rate_source").alias("source"))


RULINGS = "(SELECT c_custkey // 10 AS case_id, c_custkey AS old, c_custkey - 3 AS new, CASE WHEN c_custkey % 40 = 3 THEN 'keep' ELSE 'merge' END AS verdict FROM customer WHERE c_custkey % 10 = 3)"
SAME = f"(SELECT r.*, CASE WHEN verdict = 'keep' THEN 'kept' WHEN old % 7 % 3 = new % 7 % 3 THEN 'applied' ELSE 'set aside' END AS status FROM {RULINGS} r)"


def rulings(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.filter("c_custkey % 10 = 3").select(F.floor(k / 10).alias("case_id"), k.alias("old"), (k - 3).alias("new"), F.when(k % 40 == 3, "keep").otherwise("merge").alias("verdict"))


def ruled(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Each customer's places follow from its key, so that some merges move mass between places and are set aside."""
    places = t.customer.select(F.col("c_custkey").alias("cust"), F.explode(F.array(F.col("c_custkey") % 7 % 3, F.col("c_custkey") % 7 % 3 + 10)).alias("place"))
    rows = t.orders.groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yr")).agg(F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).cast("double").alias("amount"))
    return ledgers.adjudicate(rows, places, rulings(t), "cust", ["yr"], ["n", "amount"], "place")


@query(f"""WITH g AS (SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n, round(sum(o_totalprice), 2)::DOUBLE AS amount FROM orders GROUP BY ALL)
SELECT coalesce(s.new, g.cust) AS cust, yr, sum(n)::BIGINT AS n, round(sum(amount), 2) AS amount, count(DISTINCT s.old) AS merged FROM g LEFT JOIN {SAME} s ON s.old = g.cust AND s.status = 'applied' GROUP BY 1, 2""")
def adjudicated_rows(t: Tables) -> DataFrame:
    """Rulings consumed: mass moved where it stays in its places, sums kept."""
    return ruled(t)[0].select("cust", "yr", "n", r("amount", 2).alias("amount"), "merged")


@query(f"""WITH g AS (SELECT o_custkey AS old, count(*) AS n, sum(o_totalprice) AS amount FROM orders GROUP BY ALL)
SELECT case_id, s.old, new, verdict, status, CASE WHEN status = 'applied' THEN coalesce(n, 0) ELSE 0 END::DOUBLE AS n, round(CASE WHEN status = 'applied' THEN coalesce(amount, 0) ELSE 0 END, 2)::DOUBLE AS amount FROM {SAME} s LEFT JOIN g ON g.old = s.old""")
def adjudicated_cases(t: Tables) -> DataFrame:
    """What became of each ruling, and what it moved."""
    return ruled(t)[1].select("case_id", "old", "new", "verdict", "status", "n", r("amount", 2).alias("amount"))


@query(f"""WITH g AS (SELECT DISTINCT cust, yr, cust % 11 = 0 AS part FROM {PANEL} WHERE cust % 7 = 0 OR cust % 11 = 0)
SELECT p.cust, p.yr, CASE WHEN g.cust IS NULL THEN p.months WHEN part THEN least(p.months, 2) ELSE 0 END::BIGINT AS months, p.months >= 3 AND g.cust IS NULL AS usable,
  CASE WHEN part THEN 'partial_year' WHEN g.cust IS NOT NULL THEN 'reads_missing' END AS directive FROM {PANEL} p LEFT JOIN g ON p.cust = g.cust AND p.yr = g.yr""")
def believable_months(t: Tables) -> DataFrame:
    """A registry of directives over the months reported."""
    rows = panel(t).withColumn("usable", F.col("months") >= 3)
    part = F.col("cust") % 11 == 0
    registry = panel(t).filter("cust % 7 = 0 OR cust % 11 = 0").select("cust", "yr", F.when(part, "partial_year").otherwise("reads_missing").alias("directive"), F.when(part, 2).cast("long").alias("believable_months"))
    return ledgers.believable(rows, registry, ["cust", "yr"], "months", "usable").select("cust", "yr", F.col("months").cast("long").alias("months"), "usable", "directive")
