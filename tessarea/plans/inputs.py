"""The readers on the test tables: a table is written in a reader's format to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea import sources
from tessarea.operators import shapes
from tessarea.plans.registry import Tables, query, r
from tessarea.plans.spatial import TILES, notched
from tessarea.session import Scratch


def customers(t: Tables) -> DataFrame:
    """Keys with leading zeros, and a name that needs quotes."""
    name = F.concat(F.col("c_name"), F.lit(', "of" '), F.col("c_mktsegment"))
    return t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("key"), name.alias("name"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal").cast("string")).alias("balance"))


TEXT_SQL = """SELECT lpad(c_custkey::VARCHAR, 9, '0') AS "key", c_name || ', "of" ' || c_mktsegment AS name, CASE WHEN c_custkey % 3 > 0 THEN round(c_acctbal, 4)::DOUBLE END AS balance FROM customer"""


def read_back(t: Tables, separator: str) -> DataFrame:
    path = Scratch(t.spark, "text").folder("customers")
    customers(t).write.csv(path, header=True, sep=separator, escape='"')
    found = sources.read_strings(t.spark, path, ["key", "name", "balance"], separator)
    return found.select("key", "name", r(F.col("balance").try_cast("double"), 4).alias("balance"))


@query(TEXT_SQL)
def text_with_commas(t: Tables) -> DataFrame:
    """A text table as strings, with leading zeros (A4)."""
    return read_back(t, ",")


@query(TEXT_SQL)
def text_with_tabs(t: Tables) -> DataFrame:
    """The same with tabs."""
    return read_back(t, "\t")


@query("""SELECT o_orderpriority AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders WHERE year(o_orderdate) = 1995 AND o_totalprice BETWEEN 1000 AND 150000 GROUP BY 1""")
def partitioned_scan(t: Tables) -> DataFrame:
    """A partitioned folder, of which one year is read."""
    path = Scratch(t.spark, "hive").folder("orders")
    t.orders.withColumn("year", F.year("o_orderdate")).write.partitionBy("year").parquet(path)
    found = sources.hive_scan(t.spark, path, "year = 1995 AND o_totalprice BETWEEN 1000 AND 150000", ["o_orderpriority", "o_totalprice"])
    return found.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).alias("amount"))


@query("""SELECT c_mktsegment AS offense, year(o_orderdate)::INTEGER AS year, count(*)::DOUBLE AS count FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN 1995 AND 1996 GROUP BY ALL""")
def report_with_preamble(t: Tables) -> DataFrame:
    """A printed report: title lines, a header of years, counts with commas in quotes."""
    path = Scratch(t.spark, "report").folder("report")
    years = list(range(1995, 1997))
    wide = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(*[F.count_if(F.year("o_orderdate") == y).alias(str(y)) for y in years])
    quoted = [F.concat(F.lit('"'), F.format_number(F.col(str(y)), 0), F.lit('"')) for y in years]
    lines = wide.select(F.col("c_mktsegment").alias("at"), F.concat_ws(",", "c_mktsegment", *quoted).alias("value"))
    head = t.spark.createDataFrame([("\x01", "Counts by segment"), ("\x02", "printed for a test"), ("\x03", ",".join(["Segment", *map(str, years)]))], "at string, value string")
    # A report is one small file: a line for each segment.
    head.unionByName(lines).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return sources.read_report(t.spark, path).select("offense", "year", "count")


@query(f"SELECT id, round(w * h * 0.84, 6)::DOUBLE AS area, x0::DOUBLE AS west FROM {TILES}")
def shapes_of_features(t: Tables) -> DataFrame:
    """Concave features written line by line and read with their rings."""
    path = Scratch(t.spark, "features").folder("tiles")
    point = lambda p: F.array(p["x"], p["y"])
    places = F.transform("rings", lambda ring: F.transform(ring, point))
    line = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("id").alias("properties"), F.struct(F.lit("Polygon").alias("type"), places.alias("coordinates")).alias("geometry")))
    notched(t).select(line.alias("value")).write.text(path)
    found = sources.read_feature_lines(t.spark, path, "id int")
    areas = shapes.areas(shapes.covers(found, "id"), "id")
    west = found.select("id", F.array_min(F.transform(F.flatten("rings"), lambda p: p["x"])).alias("west"))
    return areas.join(west, "id").select("id", r("area").alias("area"), r("west", 9).alias("west"))


@query("""SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS amount FROM customer GROUP BY 1""")
def portal_text(t: Tables) -> DataFrame:
    """A portal's text table, folded in one pass."""
    path = Scratch(t.spark, "portal").folder("customers")
    t.customer.select("c_custkey", "c_mktsegment", F.col("c_acctbal").cast("double")).write.csv(path, header=True)
    found = sources.read_portal(t.spark, {"portal_type": "csv", "url": path}, "c_custkey long, segment string, amount double")
    return found.groupBy("segment").agg(F.count("*").alias("n"), r(F.sum("amount"), 2).alias("amount"))


@query("""SELECT n_regionkey::BIGINT AS region, count(*) AS n FROM nation GROUP BY 1""")
def json_lines(t: Tables) -> DataFrame:
    """A JSON sink read back."""
    path = Scratch(t.spark, "lines").folder("nation")
    sources.write_report(t.nation, path, "json")
    return t.spark.read.json(path).groupBy(F.col("n_regionkey").cast("long").alias("region")).agg(F.count("*").alias("n"))
