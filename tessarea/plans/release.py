"""Release checks on the test tables: jumps at boundaries, seams, flat groups, implausible rates, hotspots on thin exposure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.operators import release
from tessarea.operators.neighbours import neighbour_graph
from tessarea.plans.general import KM, PLACES, places
from tessarea.plans.registry import Tables, query, r
from tessarea.plans.spatial import TILES, tiles

OTHERS = "(SELECT id AS id2, lat AS lat2, lon AS lon2 FROM " + PLACES + ")"
GRAPH = f"(SELECT id, id2, km FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), id2) AS k FROM (SELECT id, id2, {KM} AS km FROM {PLACES} JOIN {OTHERS} ON id <> id2)) WHERE k <= 4)"
PAIRS = f"(SELECT DISTINCT least(id, id2) AS a, greatest(id, id2) AS b FROM {GRAPH} WHERE km <= 30)"


def surface(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("maker"), F.col("p_retailprice").cast("double").alias("v"), F.col("p_size").cast("double").alias("n"))


def seams(t: Tables) -> DataFrame:
    """The check itself, on the pairs of near places."""
    differ = lambda c: F.col(f"a_{c}") != F.col(f"b_{c}")
    kinds = {"same brand": ~differ("brand"), "other brand": differ("brand"), "other maker": differ("maker")}
    pairs = release.each_once(neighbour_graph(places(t), 4), 30.0)
    return release.jumps("jumps", release.pair_gaps(surface(t), pairs, "v", kinds, ["brand", "maker"]), "same brand", 1.02, 0.01, 30, 3)


@query(f"""WITH g AS (SELECT p.p_brand AS pb, q.p_brand AS qb, p.p_type AS pm, q.p_type AS qm, abs(ln(1 + p.p_retailprice) - ln(1 + q.p_retailprice)) AS gap FROM {PAIRS} JOIN part p ON p.p_partkey = a JOIN part q ON q.p_partkey = b),
k AS (SELECT 'same brand' AS kind, gap FROM g WHERE pb = qb UNION ALL SELECT 'other brand', gap FROM g WHERE pb <> qb UNION ALL SELECT 'other maker', gap FROM g WHERE pm <> qm),
m AS (SELECT kind, count(*) AS n, median(gap) AS m FROM k GROUP BY kind), b AS (SELECT max(m) AS bm, coalesce(max(n), 0) AS bn FROM m WHERE kind = 'same brand')
SELECT 'jumps' AS "check", kind AS subject, n, round(m / nullif(bm, 0), 6) AS measure, n >= 30 AND bn >= 3 AND coalesce(m / nullif(bm, 0) > 1.02, false) AND m > 0.01 AS breach FROM m CROSS JOIN b WHERE kind <> 'same brand'""")
def boundary_jumps(t: Tables) -> DataFrame:
    """Jumps between near places of other brands or makers against those of one brand (2.L)."""
    return seams(t).select("check", "subject", "n", r("measure").alias("measure"), "breach")


@query("""SELECT 'flat' AS "check", p_brand AS subject, count(*) AS n, round(ln(1 + quantile_cont(p_retailprice, 0.95)) - ln(1 + quantile_cont(p_retailprice, 0.05)), 6)::DOUBLE AS measure,
count(*) >= 5 AND sum(p_size) >= 100 AND ln(1 + quantile_cont(p_retailprice, 0.95)) - ln(1 + quantile_cont(p_retailprice, 0.05)) < 0.6 AND max(p_retailprice) - min(p_retailprice) < 900 AS breach FROM part GROUP BY p_brand""")
def flat_groups(t: Tables) -> DataFrame:
    """Groups whose places hardly vary (2.L)."""
    return release.flatness("flat", surface(t), "brand", "v", "n", 5, 100.0, 0.6, 900.0).select("check", "subject", "n", r("measure").alias("measure"), "breach")


@query("""SELECT 'rates' AS "check", p_type AS subject, count(*) AS n, round(sum(p_size) * 100000.0 / sum(p_retailprice), 4)::DOUBLE AS measure, sum(p_size) * 100000.0 / sum(p_retailprice) NOT BETWEEN 1700 AND 1900 AS breach FROM part GROUP BY p_type""")
def plausible_rates(t: Tables) -> DataFrame:
    """Rates of groups outside what is plausible (2.L)."""
    return release.plausible("rates", surface(t), "maker", "n", "v", 1700.0, 1900.0).select("check", "subject", "n", r("measure", 4).alias("measure"), "breach")


@query("""WITH c AS (SELECT 0.9 * quantile_cont(p_retailprice, 0.99) AS high, quantile_cont(p_size, 0.3) AS low, count(*) AS n, max(p_retailprice) AS top FROM part),
b AS (SELECT p_partkey, p_retailprice FROM part CROSS JOIN c WHERE p_retailprice > high AND p_size <= low)
SELECT 'hot' AS "check", p_partkey::VARCHAR AS subject, 1::BIGINT AS n, round(p_retailprice, 4)::DOUBLE AS measure, true AS breach FROM b UNION ALL SELECT 'hot', 'all', n, round(top, 4)::DOUBLE, (SELECT count(*) > 0 FROM b) FROM c""")
def thin_hotspots(t: Tables) -> DataFrame:
    """Places above the rest for want of exposure (2.L)."""
    return release.hotspots("hot", surface(t), "v", "n", 0.9, 0.3).select("check", "subject", "n", r("measure", 4).alias("measure"), "breach")


@query(f"""SELECT least(a.id, b.id) AS id, greatest(a.id, b.id) AS id2, 0.4::DOUBLE AS border FROM {TILES} a JOIN {TILES} b ON a.id < b.id
AND (abs(a.x0 - b.x0) < 1e-9 AND abs(abs(a.y0 - b.y0) - 0.4) < 1e-9 OR abs(a.y0 - b.y0) < 1e-9 AND abs(abs(a.x0 - b.x0) - 0.4) < 1e-9)""")
def neighbouring_tiles(t: Tables) -> DataFrame:
    """Neighbours by shared borders (2.L)."""
    rings = tiles(t).select("id", F.array("ring").alias("rings"))
    return release.sharing_borders(rings).select("id", "id2", r("border").alias("border"))


@query("""SELECT 'jumps' AS "check", 2::BIGINT AS subjects UNION ALL SELECT 'flat', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'rates', count(DISTINCT p_type) FROM part""")
def release_report(t: Tables) -> DataFrame:
    """All checks in one plan: how many subjects each has looked at."""
    checks = release.verdicts(seams(t), release.flatness("flat", surface(t), "brand", "v", "n", 5, 100.0, 0.6, 900.0), release.plausible("rates", surface(t), "maker", "n", "v", 1.0, 9_000.0))
    return checks.groupBy("check").agg(F.countDistinct("subject").alias("subjects"))
