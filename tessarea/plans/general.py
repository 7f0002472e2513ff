"""Set operations, ordering, windows, text, JSON, arrays, rules and spatial joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.functions import normalise_name, zfill
from tessarea.operators import distributed, entities, geo, rel
from tessarea.operators.neighbours import nearest_places
from tessarea.operators.rules import first_match
from tessarea.plans.entities import nation_match
from tessarea.plans.registry import Tables, query, r


@query("""SELECT c_nationkey AS k, 'both' AS kind FROM (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT c_nationkey, 'customers_only' FROM (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT k, 'any' FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def union_intersect_except(t: Tables) -> DataFrame:
    """The set operations on keys."""
    a = t.customer.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    b = t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    kind = lambda df, name: df.withColumn("kind", F.lit(name))
    return kind(a.intersect(b), "both").unionByName(kind(a.subtract(b), "customers_only")).unionByName(kind(a.union(b).distinct(), "any"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 500")
def topk_order_limit(t: Tables) -> DataFrame:
    """The 500 largest, a report of that size; each task keeps 500."""
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(500)


@query("SELECT c_nationkey, c_custkey, c_acctbal, k FROM (SELECT *, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS k FROM customer) WHERE k <= 3")
def topk_per_group(t: Tables) -> DataFrame:
    """Three largest of each group."""
    k = F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey"))
    return t.customer.withColumn("k", k).filter("k <= 3").select("c_nationkey", "c_custkey", "c_acctbal", "k")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events")
def ffill_window(t: Tables) -> DataFrame:
    """The last known value carried forward."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.events.select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("value")), ignorenulls=True).over(w).alias("last_purchase"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def last_per_key(t: Tables) -> DataFrame:
    """The last row of each key."""
    return rel.top1(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def json_prop_extract(t: Tables) -> DataFrame:
    """A value from JSON by a schema."""
    return t.events.groupBy("event_type", F.from_json("props", "k long")["k"].alias("k")).agg(F.count("*").alias("n"))


@query("SELECT label, count(*) AS n, count(*) FILTER (WHERE list_contains(list_transform(embedding, lambda x: x > 0.4), true)) AS peaked, round(avg(len(list_filter(embedding, lambda x: x > 0))), 6) AS positive FROM embeddings GROUP BY label")
def array_contains_nullsafe(t: Tables) -> DataFrame:
    """Array predicates that stay false on a NULL element."""
    x = F.col("embedding")
    peaked = F.coalesce(F.exists(x, lambda v: v > F.lit(0.4).cast("float")), F.lit(False))
    return t.embeddings.groupBy("label").agg(F.count("*").alias("n"), F.count_if(peaked).alias("peaked"), r(F.avg(F.size(F.filter(x, lambda v: v > 0)))).alias("positive"))


@query("SELECT token, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(string_split(lower(text), ' ')) AS token FROM documents) WHERE length(token) BETWEEN 3 AND 8 GROUP BY token HAVING count(*) >= 20")
def token_explode_distinct(t: Tables) -> DataFrame:
    """Distinct tokens of each row, then rows per token."""
    token = F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("token")
    return t.documents.select(token).filter(F.length("token").between(3, 8)).groupBy("token").agg(F.count("*").alias("docs")).filter("docs >= 20")


@query("SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(p_name), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS name, CASE WHEN length(p_partkey::VARCHAR) < 9 THEN lpad(p_partkey::VARCHAR, 9, '0') ELSE p_partkey::VARCHAR END AS code FROM part")
def name_normalise_chain(t: Tables) -> DataFrame:
    """A chain of rewrites, and zero padding that never cuts."""
    return t.part.select("p_partkey", normalise_name("p_name").alias("name"), zfill("p_partkey", 9).alias("code"))


@query("""WITH a AS (SELECT c_custkey, right(c_name, 3) AS key FROM customer), u AS (SELECT key, min(c_custkey) AS id, count(*) AS n FROM a GROUP BY key)
SELECT s_suppkey, CASE WHEN n = 1 THEN id END AS matched, coalesce(n, 0) AS candidates FROM supplier LEFT JOIN u ON right(s_name, 3) = key""")
def alias_unique_match(t: Tables) -> DataFrame:
    """A match counts if the alias names one entity alone."""
    u = t.customer.groupBy(F.right("c_name", F.lit(3)).alias("key")).agg(F.min("c_custkey").alias("id"), F.count("*").alias("n"))
    s = t.supplier.select("s_suppkey", F.right("s_name", F.lit(3)).alias("key"))
    return s.join(u, "key", "left").select("s_suppkey", F.when(F.col("n") == 1, F.col("id")).alias("matched"), F.coalesce("n", F.lit(0)).alias("candidates"))


@query("""WITH p AS (SELECT s_suppkey, c_custkey, CASE WHEN s_suppkey % 10 = c_custkey % 10 THEN 0 ELSE 1 END AS pri, CAST(abs(s_acctbal - c_acctbal) / 1000 AS INTEGER) AS gap FROM supplier JOIN customer ON s_nationkey = c_nationkey),
k AS (SELECT *, rank() OVER (PARTITION BY s_suppkey ORDER BY pri, gap) AS k FROM p), b AS (SELECT s_suppkey, min(c_custkey) AS c_custkey, count(*) AS n FROM k WHERE k = 1 GROUP BY s_suppkey)
SELECT s_suppkey, c_custkey FROM b WHERE n = 1""")
def scored_unique_best_match(t: Tables) -> DataFrame:
    """The best score tuple is accepted if one entity alone holds it."""
    return nation_match(t.supplier, t.customer, lambda a, b: F.bround(F.abs(a - b) / 1000).cast("int"))


@query("""WITH b AS (SELECT item_id, list_distinct(string_split(lower(text), ' ')) AS ws FROM benchmark) SELECT a.item_id AS a, b.item_id AS b, len(list_intersect(a.ws, b.ws)) AS common FROM b a JOIN b ON a.item_id < b.item_id WHERE len(list_intersect(a.ws, b.ws)) > 0""")
def token_overlap(t: Tables) -> DataFrame:
    """Common tokens of all pairs of names that have any."""
    return rel.token_pairs(t.benchmark.select("item_id", F.array_distinct(F.split(F.lower("text"), " ")).alias("ws")), "item_id", "ws")


RULES = [
    {"label": "promo_small", "all": [{"field": "p_type", "contains": "PROMO"}, {"field": "p_size", "in": list(range(1, 16))}]},
    {"label": "branded", "all": [{"field": "p_brand", "regex": "^Brand#[12]"}], "none": [{"field": "p_size", "eq": 50}]},
    {"label": "large", "all": [{"field": "p_size", "ge": 40}]},
]


@query("""SELECT p_partkey, CASE WHEN contains(p_type, 'PROMO') AND p_size BETWEEN 1 AND 15 THEN 'promo_small' WHEN regexp_matches(p_brand, '^Brand#[12]') AND p_size <> 50 THEN 'branded' WHEN p_size >= 40 THEN 'large' ELSE 'other' END AS label FROM part""")
def rules_dsl_first_match(t: Tables) -> DataFrame:
    """Rules as data; the first that matches names the row."""
    return t.part.select("p_partkey", first_match(RULES, "other").alias("label"))


@query("SELECT substr(CAST(l_partkey AS VARCHAR), 1, 1) AS home, substr(CAST(l_suppkey AS VARCHAR), 1, 1) AS work, count(*) AS flows, count(*) FILTER (WHERE substr(CAST(l_partkey AS VARCHAR), 1, 1) = substr(CAST(l_suppkey AS VARCHAR), 1, 1)) AS same FROM lineitem GROUP BY ALL")
def od_flow_prefix(t: Tables) -> DataFrame:
    """Origin and destination by the prefix of their keys."""
    p = lambda c: F.substring(F.col(c).cast("string"), 1, 1)
    return t.lineitem.groupBy(p("l_partkey").alias("home"), p("l_suppkey").alias("work")).agg(F.count("*").alias("flows"), F.count_if(p("l_partkey") == p("l_suppkey")).alias("same"))


@query("SELECT p_brand, class, n, round(n * 1.0 / sum(n) OVER (PARTITION BY p_brand), 9)::DOUBLE AS share, mean FROM (SELECT p_brand, CAST(p_size // 10 AS INTEGER) AS class, count(*) AS n, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY ALL)")
def zonal_histogram(t: Tables) -> DataFrame:
    """Class shares by zone (I8)."""
    g = t.part.groupBy("p_brand", F.floor(F.col("p_size") / 10).cast("int").alias("class")).agg(F.count("*").alias("n"), r(F.avg("p_retailprice")).alias("mean"))
    return rel.share_of_group(g, ["p_brand"], "n", "share").withColumn("share", r("share", 9))


@query("""WITH v AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM v WHERE label < 5 GROUP BY i),
d AS (SELECT vec_id, any_value(label) AS label, sqrt(avg(((x - m) / s) ** 2)) AS d FROM v JOIN m USING (i) GROUP BY vec_id), s AS (SELECT quantile_cont(d, 0.9) AS s FROM d WHERE label < 5)
SELECT vec_id, round(exp(-0.5 * (d / s) ** 2), 6) AS score FROM d CROSS JOIN s""")
def domain_overlap_score(t: Tables) -> DataFrame:
    """Distance from the training domain over all components, scaled by its 90th percentile."""
    v = t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    # One row: the mean and spread of each component.
    each = v.filter("label < 5").select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    frame = each.agg(F.array_sort(F.collect_list(F.struct("i", "m", "s"))).alias("f"))
    z = F.zip_with("v", "f", lambda x, f: F.pow((x - f["m"]) / f["s"], 2))
    d = v.crossJoin(F.broadcast(frame)).select("vec_id", "label", F.sqrt(F.aggregate(z, F.lit(0.0), lambda a, b: a + b) / F.size("v")).alias("d"))
    s = distributed.quantiles(d.filter("label < 5"), [], "d", [0.9], ["s"])
    return d.crossJoin(F.broadcast(s)).select("vec_id", r(F.exp(-0.5 * F.pow(F.col("d") / F.col("s"), 2))).alias("score"))


def places(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), (40 + (F.col("p_partkey") * 37 % 1000) / 500.0).alias("lat"), (-75 + (F.col("p_partkey") * 91 % 1000) / 500.0).alias("lon"))


def sites(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("id2"), (40 + (F.col("s_suppkey") * 53 % 1000) / 500.0).alias("lat2"), (-75 + (F.col("s_suppkey") * 71 % 1000) / 500.0).alias("lon2"))


PLACES = "(SELECT p_partkey AS id, 40 + (p_partkey * 37 % 1000) / 500.0 AS lat, -75 + (p_partkey * 91 % 1000) / 500.0 AS lon FROM part)"
SITES = "(SELECT s_suppkey AS id2, 40 + (s_suppkey * 53 % 1000) / 500.0 AS lat2, -75 + (s_suppkey * 71 % 1000) / 500.0 AS lon2 FROM supplier)"
KM = "2 * 6371.0088 * asin(sqrt(least(1, sin(radians(lat2 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(lat2)) * sin(radians(lon2 - lon) / 2) ** 2)))"


@query(f"SELECT id, id2, round(km, 6) AS km FROM (SELECT id, id2, {KM} AS km FROM {PLACES} CROSS JOIN {SITES}) WHERE km <= 5")
def haversine_within_radius(t: Tables) -> DataFrame:
    """Pairs within a radius by cells and an exact distance (C14)."""
    return geo.within_km(places(t), sites(t), 5.0).select("id", "id2", r("km").alias("km"))


@query(f"SELECT id, id2, round(km, 6) AS km FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), id2) AS k FROM (SELECT id, id2, {KM} AS km FROM {PLACES} CROSS JOIN {SITES}) WHERE km <= 20) WHERE k <= 2")
def knn_pairs(t: Tables) -> DataFrame:
    """The two nearest within a radius."""
    return nearest_places(places(t), sites(t), 2, within=20.0).select("id", "id2", r("km").alias("km"))


@query(f"SELECT id FROM {PLACES} WHERE lat BETWEEN 40.5 AND 41.2 AND lon BETWEEN -74.8 AND -74.1")
def bbox_filter(t: Tables) -> DataFrame:
    """A bounding box."""
    return places(t).filter("lat BETWEEN 40.5 AND 41.2 AND lon BETWEEN -74.8 AND -74.1").select("id")


@query(f"SELECT id, zone FROM {PLACES} JOIN (SELECT n_nationkey AS zone, 40 + (n_nationkey % 5) * 0.4 AS y0, -75 + (n_nationkey // 5) * 0.4 AS x0 FROM nation) ON lat > y0 + 0.011 AND lat < y0 + 0.391 AND lon > x0 + 0.011 AND lon < x0 + 0.391")
def point_in_rect(t: Tables) -> DataFrame:
    """Points in polygons by cells and rays."""
    return geo.in_polygons(places(t), zones(t), 0.2, "lon", "lat").select("id", "zone")


def zones(t: Tables) -> DataFrame:
    y0, x0 = 40 + (F.col("n_nationkey") % 5) * 0.4, -75 + F.floor(F.col("n_nationkey") / 5) * 0.4
    corner = lambda dx, dy: F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y"))
    return t.nation.select(F.col("n_nationkey").alias("zone"), F.array(corner(0.011, 0.011), corner(0.391, 0.011), corner(0.391, 0.391), corner(0.011, 0.391)).alias("ring"))


@query("""WITH p AS (SELECT event_type, user_id % 40 AS point, count(DISTINCT event_id) AS n FROM events GROUP BY ALL) SELECT event_type, max(n) AS top, round(max(n) * 1.0 / sum(n), 6)::DOUBLE AS share FROM p GROUP BY event_type""")
def exact_point_concentration(t: Tables) -> DataFrame:
    """The share of the largest exact point."""
    p = t.events.groupBy("event_type", (F.col("user_id") % 40).alias("point")).agg(F.countDistinct("event_id").alias("n"))
    return p.groupBy("event_type").agg(F.max("n").alias("top"), r(F.max("n") / F.sum("n")).alias("share"))


@query("""WITH m AS (SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS wk, count(*) AS n FROM events GROUP BY ALL), k AS (SELECT *, median(n) OVER (PARTITION BY event_type) AS md FROM m)
SELECT event_type, sum(n) FILTER (WHERE n >= 0.25 * md)::BIGINT AS pooled, count(*) FILTER (WHERE n < 0.25 * md) AS dropped FROM k GROUP BY event_type""")
def pooled_city_share(t: Tables) -> DataFrame:
    """Periods far below the median are left out of the pool."""
    m = t.events.groupBy("event_type", F.date_trunc("week", "ts").alias("wk")).agg(F.count("*").alias("n")).withColumn("md", F.median("n").over(Window.partitionBy("event_type")))
    whole = F.col("n") >= 0.25 * F.col("md")
    return m.groupBy("event_type").agg(F.sum(F.when(whole, F.col("n"))).alias("pooled"), F.count_if(~whole).alias("dropped"))


@query("""SELECT event_type, count(*) AS raw, count(*) FILTER (WHERE user_id >= 0) AS mapped, count(*) FILTER (WHERE user_id >= 0 AND value > 5) AS geocoded, count(*) FILTER (WHERE user_id >= 0 AND value > 5 AND json_extract_string(props, '$.k') IS NOT NULL) AS matched FROM events GROUP BY event_type""")
def reconciliation_funnel(t: Tables) -> DataFrame:
    """How many rows each step keeps, in one pass."""
    a = F.col("user_id") >= 0
    b = a & (F.col("value") > 5)
    c = b & F.get_json_object("props", "$.k").isNotNull()
    return t.events.groupBy("event_type").agg(F.count("*").alias("raw"), F.count_if(a).alias("mapped"), F.count_if(b).alias("geocoded"), F.count_if(c).alias("matched"))


@query("""WITH a AS (SELECT l_suppkey, sum(l_quantity) AS v FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL), b AS (SELECT l_suppkey, sum(l_quantity) AS v FROM lineitem WHERE l_linenumber <= 4 AND l_suppkey % 7 <> 0 GROUP BY ALL)
SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, a.v AS left_value, b.v AS right_value, CASE WHEN a.v IS NULL THEN 'right_only' WHEN b.v IS NULL THEN 'left_only' ELSE 'differs' END AS kind FROM a FULL JOIN b ON a.l_suppkey = b.l_suppkey WHERE a.v IS NULL OR b.v IS NULL OR abs(a.v - b.v) > 2000""")
def frame_diff_tolerance(t: Tables) -> DataFrame:
    """Two frames aligned on a key, with a tolerance."""
    a = t.lineitem.filter("l_linenumber <= 3").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("v"))
    b = t.lineitem.filter("l_linenumber <= 4 AND l_suppkey % 7 <> 0").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("v"))
    return rel.frame_diff(a, b, ["l_suppkey"], "v", 2000.0)


@query("SELECT CAST(time_bucket(INTERVAL 1 DAY, ts) AS TIMESTAMP) AS start, event_type, count(*) AS n, round(sum(value), 6) AS v FROM events GROUP BY ALL")
def windowed_event_counts(t: Tables) -> DataFrame:
    """The batch form of the streaming aggregate, an extension."""
    from tessarea.streaming.events import windowed_counts

    return windowed_counts(t.events, "1 day")
