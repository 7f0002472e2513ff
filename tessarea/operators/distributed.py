"""Ranks, running sums and quantiles of whole groups without a task that holds one: rows are dealt by range, and what
stands before each part is added from one small row a part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.session import Scratch


def running(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), **sums: Column) -> DataFrame:
    """Sums over the rows before each row (itself left out) in ``order`` within ``group``; ``order`` must tell rows apart, or ties are arbitrary.

    Rows are sorted by range into parts and written once, so that parts are the same for both passes."""
    scratch = Scratch(df.sparkSession, "running")
    made = df.withColumns({f"_v_{n}": x for n, x in sums.items()})
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.keep(made.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_part", *group).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    # A row for each part and group that meet: few, as a range holds neighbouring groups.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select("_part", *group, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    from tessarea.operators.rel import null_safe_join

    out = null_safe_join(dealt, heads, ["_part", *group])
    return out.select(*df.columns, *[(F.coalesce(F.sum(f"_v_{n}").over(w), F.lit(0)) + F.col(f"_b_{n}")).alias(n) for n in sums])


def positions(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """Each row's place from 0 in ``order`` within ``group``."""
    return running(df, order, group, **{name: F.lit(1).cast("long")})


def average_ranks(df: DataFrame, value: str, name: str, group: Sequence[str] = ()) -> DataFrame:
    """Ranks from 1 in which equal values share the mean of their places."""
    counted = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    placed = running(counted, [value], group, _before=F.col("_n"))
    from tessarea.operators.rel import null_safe_join

    side = placed.select(*group, value, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(name))
    return null_safe_join(df, side, [*group, value])


def quantiles(df: DataFrame, group: Sequence[str], value: str, shares: Sequence[float], names: Sequence[str], times: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: values are counted first, running counts come by range, and of each group only
    the rows around each quantile are picked. NULL values count for nothing; groups without any value give no row. ``times`` says how often a row counts."""
    from tessarea.operators.rel import null_safe_join

    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("_x")).agg((F.sum(times) if times else F.count("*")).alias("_n"))
    placed = running(counted, ["_x"], group, _before=F.col("_n"))
    totals = counted.groupBy(*group).agg(F.sum("_n").alias("_all"))
    wide = null_safe_join(placed, totals, list(group)) if group else placed.crossJoin(totals)
    made = []
    for q, name in zip(shares, names, strict=True):
        at = F.lit(q) * (F.col("_all") - 1)
        here = lambda k: F.max(F.when((F.col("_before") <= k) & (k < F.col("_before") + F.col("_n")), F.col("_x")))
        low, high, rest = here(F.floor(at)), here(F.ceil(at)), F.max(at - F.floor(at))
        made.append((low + (high - low) * rest).alias(name))
    return wide.groupBy(*group).agg(*made, F.max("_all").alias("_count")).drop("_count")


def buckets(df: DataFrame, order: Sequence[str], n: int, name: str, group: Sequence[str] = ()) -> DataFrame:
    """n buckets of equal size in ``order`` within ``group``, numbered from 1, the first ones larger by one where they can't be equal."""
    from tessarea.operators.rel import with_totals

    placed = with_totals(positions(df, order, "_at", group), list(group), _all=F.count("*"))
    size, more = F.floor(F.col("_all") / n), F.col("_all") % n
    large = more * (size + 1)
    bucket = F.when(F.col("_at") < large, F.floor(F.col("_at") / (size + 1))).otherwise(more + F.floor((F.col("_at") - large) / F.greatest(size, F.lit(1))))
    return placed.withColumn(name, (bucket + 1).cast("int")).drop("_at", "_all")
