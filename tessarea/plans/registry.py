"""The catalogue of queries over the test tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of one directory by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of Tables under its name."""

    def wrap(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[f.__name__] = sql
        return f

    return wrap


def r(column, n: int = 6):
    return F.round(column, n)


def candidates(t: Tables) -> DataFrame:
    """A panel of competing lanes: customer, year, priority and status with counts, amounts and months."""
    return t.orders.groupBy(
        F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yr"), F.col("o_orderpriority").alias("prio"), F.col("o_orderstatus").alias("lane")
    ).agg(F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).alias("amount"), F.countDistinct(F.month("o_orderdate")).alias("months"))


CANDIDATES = """(SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderpriority AS prio, o_orderstatus AS lane, count(*) AS n,
  round(sum(o_totalprice), 2) AS amount, count(DISTINCT month(o_orderdate)) AS months FROM orders GROUP BY ALL)"""


def panel(t: Tables) -> DataFrame:
    """Customer and year with orders, months reported and amount."""
    return t.orders.groupBy(F.col("o_custkey").alias("cust"), F.year("o_orderdate").alias("yr")).agg(
        F.count("*").alias("n"), F.countDistinct(F.month("o_orderdate")).alias("months"), F.sum("o_totalprice").alias("amount")
    )


PANEL = """(SELECT o_custkey AS cust, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n, count(DISTINCT month(o_orderdate)) AS months, sum(o_totalprice) AS amount FROM orders GROUP BY ALL)"""
