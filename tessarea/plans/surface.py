"""The SQL surface: temporary views, common table expressions, rule sweeps, user functions and streams in batch form."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.functions import clip, text
from tessarea.operators import distributed, rel
from tessarea.plans.registry import CANDIDATES, PANEL, Tables, candidates, panel, query, r
from tessarea.streaming import events as streams


INCIDENTS = """WITH i AS (SELECT l_orderkey, year(min(l_shipdate)) AS yr, array_agg(l_returnflag) AS flags, max(l_quantity) AS most, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS victims, count(*) AS lines FROM {lineitem} GROUP BY l_orderkey),
c AS (SELECT greatest(percentile(most, 0.95) FILTER (WHERE most < 50), 30) AS cap FROM i),
k AS (SELECT l_orderkey, yr, CASE WHEN array_contains(flags, 'R') THEN 'violent' WHEN array_contains(flags, 'A') AND victims > 1 THEN 'persons' WHEN array_contains(flags, 'A') THEN 'property' ELSE 'other' END AS kind,
  CASE WHEN array_contains(flags, 'R') THEN victims WHEN most >= 50 THEN cap ELSE least(most, cap) END AS weight FROM i CROSS JOIN c WHERE NOT (lines = 1 AND most < 3))
SELECT yr, kind, count(*) AS n, round(sum(weight), 6) AS weight FROM k GROUP BY yr, kind HAVING sum(weight) > 0"""


@query(INCIDENTS.replace("{lineitem}", "lineitem").replace("year(min(l_shipdate))", "CAST(year(min(l_shipdate)) AS INTEGER)").replace("percentile(most, 0.95)", "quantile_cont(most, 0.95)").replace("array_contains", "list_contains"))
def incident_annual_counts(t: Tables) -> DataFrame:
    """Incidents to yearly counts in SQL: flags by array, victims for persons, a capped count for others, some suppressed (A2, D1, D2, D3; CTEs, scalar subquery, HAVING)."""
    return t.spark.sql(INCIDENTS, lineitem=t.lineitem)


SWEEP = """SELECT cust, yr, n >= 2 AND months >= 2 AS strict, n >= 2 OR months >= 2 AS loose, CASE WHEN months >= 6 THEN 'whole' WHEN n > 3 THEN 'busy' ELSE 'thin' END AS variant FROM {panel}"""


@query(SWEEP.replace("{panel}", PANEL))
def rule_variant_sweep(t: Tables) -> DataFrame:
    """Variants of a rule side by side in a view."""
    name = "tessarea_rule_variants"
    t.spark.sql(SWEEP, panel=panel(t)).createOrReplaceTempView(name)
    return t.spark.table(name)


@query(f"SELECT cust, yr, n, amount, row_number() OVER (ORDER BY n DESC NULLS LAST, amount ASC NULLS LAST, cust, yr) AS place FROM (SELECT cust, yr, CASE WHEN n > 1 THEN n END AS n, amount FROM {PANEL})")
def nulls_last_sort(t: Tables) -> DataFrame:
    """A total order over several keys, NULLs last both ways (2.N)."""
    # Amounts order the rows, so they are added one by one as the orders are numbered: equal orders give equal sums, however tasks meet them.
    w = Window.partitionBy("cust", "yr").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = t.orders.select(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yr"), "o_orderkey", "o_totalprice").withColumns({"n": F.count("*").over(w), "amount": F.sum("o_totalprice").over(w)})
    exact = summed.groupBy("cust", "yr").agg(F.max("n").alias("n"), F.max_by("amount", "n").alias("amount"))
    rows = exact.select("cust", "yr", F.when(F.col("n") > 1, F.col("n")).alias("n"), "amount")
    # Ranks of the whole table by ranges; descending and NULLs last are columns of their own, those of the keys too: SQL puts them last.
    keys = rows.withColumns({"_down": -F.col("n")} | {f"_no_{c}": F.col(c).isNull().cast("int") for c in ("n", "amount", "cust", "yr")})
    placed = distributed.positions(keys, ["_no_n", "_down", "_no_amount", "amount", "_no_cust", "cust", "_no_yr", "yr"], "place")
    return placed.select("cust", "yr", "n", "amount", (F.col("place") + 1).alias("place"))


@query("SELECT p_brand AS brand, count(*) AS n, round(avg(jaro_winkler_similarity(lower(p_name), lower(p_type))), 9) AS likeness, round(max(jaro_winkler_similarity(lower(p_name), lower(p_type))), 9) AS most FROM part GROUP BY p_brand")
def pandas_function(t: Tables) -> DataFrame:
    """A vectorised function that Spark lacks, the likeness of two names, on Arrow batches (2.N, UDF)."""
    s = t.part.select("p_brand", text.jaro_winkler(F.lower("p_name"), F.lower("p_type")).alias("s"))
    return s.groupBy(F.col("p_brand").alias("brand")).agg(F.count("*").alias("n"), r(F.avg("s"), 9).alias("likeness"), r(F.max("s"), 9).alias("most"))


@query("""WITH RECURSIVE e AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
w AS (SELECT user_id, i, 1 AS batch, value AS held FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.i, CASE WHEN w.held >= 100 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.held >= 100 THEN e.value ELSE w.held + e.value END FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1)
SELECT user_id, batch::BIGINT AS batch, count(*) AS n, round(max(held), 6) AS held FROM w GROUP BY user_id, batch""")
def table_function(t: Tables) -> DataFrame:
    """A table function with state over sorted partitions: a batch of a user's events closes when its values reach 100. No window has a sum that begins anew (2.N, UDTF)."""

    @F.udtf(returnType="user_id bigint, batch bigint, n bigint, held double")
    class Batches:
        def __init__(self):
            self.user, self.batch, self.n, self.held = None, 1, 0, 0.0

        def eval(self, row) -> Iterator[tuple[int, int, int, float]]:
            self.user, self.n, self.held = row["user_id"], self.n + 1, self.held + row["value"]
            if self.held >= 100:
                yield self.user, self.batch, self.n, self.held
                self.batch, self.n, self.held = self.batch + 1, 0, 0.0

        def terminate(self) -> Iterator[tuple[int, int, int, float]]:
            if self.n:
                yield self.user, self.batch, self.n, self.held

    t.spark.udtf.register("tessarea_batches", Batches)
    t.events.select("user_id", "ts", "event_id", "value").createOrReplaceTempView("tessarea_events")
    found = t.spark.sql("SELECT * FROM tessarea_batches(TABLE(tessarea_events) PARTITION BY user_id ORDER BY (ts, event_id))")
    return found.select("user_id", "batch", "n", r("held").alias("held"))


@query("""WITH m AS (SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS yr, month(o_orderdate) AS mo, count(*) AS n FROM orders GROUP BY ALL), a AS (SELECT cust, yr, sum(n) AS total, count(*) AS seen, count(*) FILTER (WHERE n > 1) AS busy, max(n) AS top FROM m GROUP BY ALL)
SELECT cust, yr, total::BIGINT AS total, seen, busy, top, CAST(CASE WHEN cust % 3 > 0 THEN seen ELSE least(greatest(12 - busy, 0), 12) END AS BIGINT) AS months, total >= 3 AND (busy <= 1 OR top * 1.0 / total >= 0.4) AS lumpy FROM a""")
def annual_from_months(t: Tables) -> DataFrame:
    """Years from months: sums, months seen, the resolution of months reported, and lumpiness."""
    m = t.orders.groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo")).agg(F.count("*").alias("n"))
    a = m.groupBy("cust", "yr").agg(F.sum("n").alias("total"), F.count("*").alias("seen"), F.count_if(F.col("n") > 1).alias("busy"), F.max("n").alias("top"))
    measured = F.when(F.col("cust") % 3 > 0, F.col("seen"))
    return a.withColumns({"months": F.coalesce(measured, clip(12 - F.col("busy"), 0, 12)), "lumpy": (F.col("total") >= 3) & ((F.col("busy") <= 1) | (F.col("top") / F.col("total") >= 0.4))})


@query(f"""WITH l AS (SELECT cust // 10 AS unit, lane, sum(amount) AS w FROM {CANDIDATES} GROUP BY ALL), d AS (SELECT unit, lane AS dominant FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY w DESC, lane) AS k FROM l) WHERE k = 1)
SELECT unit, dominant, round(sum(months * amount) / sum(amount), 6) AS months, round(sum(CASE WHEN n > 1 THEN n * amount END) / sum(CASE WHEN n > 1 THEN amount END), 6) AS n FROM (SELECT *, cust // 10 AS unit FROM {CANDIDATES}) JOIN d USING (unit) GROUP BY unit, dominant""")
def jurisdiction_rollup(t: Tables) -> DataFrame:
    """Weighted means, unknown values left out of both sums, and the dominant label of larger units."""
    c = candidates(t).withColumns({"unit": F.floor(F.col("cust") / 10), "known": F.when(F.col("n") > 1, F.col("n"))})
    means = c.groupBy("unit").agg(r(rel.weighted_mean(F.col("months"), F.col("amount"))).alias("months"), r(rel.weighted_mean(F.col("known"), F.col("amount"))).alias("n"))
    label = rel.dominant_label(c, ["unit"], "lane", "amount").select("unit", F.col("lane").alias("dominant"))
    return means.join(label, "unit").select("unit", "dominant", "months", "n")


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def user_sessions(t: Tables) -> DataFrame:
    """Sessions by the function that streams use (extension)."""
    out = streams.sessions(t.events, "6 hours")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY ALL")
def first_seen_events(t: Tables) -> DataFrame:
    """Repeats of a day dropped by the function that streams use (extension)."""
    rows = t.events.withColumn("day", F.to_date("ts"))
    return streams.first_seen(rows, "1 day", ["user_id", "event_type", "day"]).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag AS lane, l_linestatus AS status, CAST(width_bucket AS INTEGER) AS bucket, count(*) AS n FROM (SELECT *, CASE WHEN l_quantity < 1 THEN 0 WHEN l_quantity >= 51 THEN 6 ELSE floor((l_quantity - 1) / 10) + 1 END AS width_bucket FROM lineitem) GROUP BY ROLLUP (lane, status, bucket)")
def rollup_by_bucket(t: Tables) -> DataFrame:
    """Totals at several levels in one pass over buckets (B15, G12; extension)."""
    return t.spark.sql("SELECT l_returnflag AS lane, l_linestatus AS status, CAST(width_bucket(l_quantity, 1, 51, 5) AS INT) AS bucket, count(*) AS n FROM {l} GROUP BY ROLLUP (l_returnflag, l_linestatus, CAST(width_bucket(l_quantity, 1, 51, 5) AS INT))", l=t.lineitem)
