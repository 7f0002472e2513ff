"""Relational kit: selection, completion, fallback, shares, rollups and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessarea.session import Scratch


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank0") -> DataFrame:
    """Rank from 0 within ``keys``. ``order`` must end in what tells rows apart, or ties are arbitrary."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by a composite priority. Spark limits each task's groups before the shuffle."""
    return ranked(df, keys, order, "_rank").filter(F.col("_rank") == 0).drop("_rank")


def members(df: DataFrame, chosen: DataFrame, keys: Sequence[str], inside: bool = True) -> DataFrame:
    """Rows whose keys together stand in ``chosen``, or with ``inside`` False those whose don't."""
    return df.join(chosen.select(*keys).distinct(), list(keys), "left_semi" if inside else "left_anti")


def replaced(df: DataFrame, crosswalk: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Keys by a crosswalk with each old key once, others as they are."""
    side = crosswalk.select(F.col(old).alias(key), F.col(new).alias("_new"))
    out = df.join(side, key, "left")
    return out.select(*[F.coalesce("_new", key).alias(key) if c == key else F.col(c) for c in df.columns])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An inner or left join in which NULL keys are equal; the left side's keys are returned."""
    side = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(side[f"_right_{k}"]) for k in keys]
    return left.join(side, on, how).drop(*[f"_right_{k}" for k in keys])


def clamp_negative(df: DataFrame, value: str, ledger: str) -> DataFrame:
    """Negative values become 0; ``ledger`` says by how much."""
    return df.withColumn(ledger, F.greatest(-F.col(value), F.lit(0.0))).withColumn(value, F.greatest(F.col(value), F.lit(0.0)))


def complete(df: DataFrame, keys: Sequence[str], dimension: DataFrame, fill: dict) -> DataFrame:
    """Each distinct key crossed with a small dimension, with missing rows filled. Spark broadcasts the dimension if it is small enough."""
    skeleton = df.select(*keys).distinct().crossJoin(dimension)
    return skeleton.join(df, [*keys, *dimension.columns], "left").fillna(fill)


def once(df: DataFrame, label: str = "once") -> DataFrame:
    """A frame that is used twice: one that joins or aggregates is written and read back, so that it is made once however long the chain; a plain scan is read again."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not any(step in plan for step in ("Join", "Aggregate", "Window", "Generate")):
        return df
    return Scratch(df.sparkSession, label).keep(df, label)


def with_totals(df: DataFrame, group: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates of each row's group as columns: aggregated before the shuffle and joined back, so that no task holds a group. NULL keys form groups."""
    df = once(df, "totals")
    totals = df.groupBy(*group).agg(*[x.alias(name) for name, x in aggregates.items()])
    return null_safe_join(df, totals, group, "left") if group else df.crossJoin(totals)


def share_of_group(df: DataFrame, group: Sequence[str], value: str, name: str, fallback: str | None = None) -> DataFrame:
    """value / its group's sum; where that is 0 the share of ``fallback``, else 0."""
    sums = {"_total": F.sum(value)} | ({"_other": F.sum(fallback)} if fallback else {})
    out = with_totals(df, group, **sums)
    other = F.when(F.col("_other") > 0, F.col(fallback) / F.col("_other")) if fallback else F.lit(None)
    return out.withColumn(name, F.coalesce(F.when(F.col("_total") > 0, F.col(value) / F.col("_total")), other, F.lit(0.0))).drop(*sums)


def basis_shares(df: DataFrame, group: Sequence[str], bases: Sequence[str], name: str, floor: float) -> DataFrame:
    """Shares of each group by the first basis with a positive sum, or equal ones; those below ``floor`` become 0 unless all are, and the rest is scaled to 1.

    Two aggregates: the sums of all bases, of which the chosen one is the first shares' total, then the largest share and what the floor leaves."""
    out = with_totals(df, group, _count=F.count("*"), **{f"_b{i}": F.sum(b) for i, b in enumerate(bases)})
    base, total = F.lit(1.0), F.col("_count").cast("double")
    for i, b in reversed(list(enumerate(bases))):
        base, total = F.when(F.col(f"_b{i}") > 0, F.col(b)).otherwise(base), F.when(F.col(f"_b{i}") > 0, F.col(f"_b{i}")).otherwise(total)
    out = out.withColumn("_s0", F.coalesce(base / total, F.lit(0.0)))
    out = with_totals(out, group, _top=F.max("_s0"), _all=F.sum("_s0"), _left=F.sum(F.when(F.col("_s0") >= floor, F.col("_s0"))))
    floored = F.col("_top") >= floor
    share = F.when(floored, F.when(F.col("_s0") >= floor, F.col("_s0") / F.col("_left")).otherwise(0.0)).otherwise(F.col("_s0") / F.col("_all"))
    return out.withColumn(name, F.coalesce(share, F.lit(0.0))).drop("_count", *[f"_b{i}" for i in range(len(bases))], "_s0", "_top", "_all", "_left")


def dominant_label(df: DataFrame, keys: Sequence[str], label: str, weight: str) -> DataFrame:
    """Per key the label with most weight, the smaller label on ties."""
    sums = df.groupBy(*keys, label).agg(F.sum(weight).alias("_w"))
    return top1(sums, keys, [F.desc("_w"), F.asc(label)]).withColumnRenamed("_w", "weight")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of wx over sum of w where x is known, NULL without any."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def rollup_via_bridge(facts: DataFrame, bridge: DataFrame, on: str, keys: Sequence[str], value: str, weight: str = "weight") -> DataFrame:
    """Facts summed through a weighted crosswalk."""
    return facts.join(bridge, on).groupBy(*keys).agg(F.sum(F.col(value) * F.col(weight)).alias(value))


def lookup_chain(df: DataFrame, levels: Sequence[tuple[DataFrame, Sequence[str], str, str]], name: str, default: float) -> DataFrame:
    """The value of the first level that has one, with the level's label. Each level: table, keys, column, label; a table without keys is taken as its one row (the largest value of several)."""
    out, tried, labels = df, [], []
    for i, (table, keys, column, label) in enumerate(levels):
        side = table.select(*keys, F.col(column).alias(f"_l{i}"))
        out = out.join(side, list(keys), "left") if keys else out.crossJoin(F.broadcast(side.agg(F.max(f"_l{i}").alias(f"_l{i}"))))  # one row
        tried.append(F.col(f"_l{i}"))
        labels.append(F.when(F.col(f"_l{i}").isNotNull(), F.lit(label)))
    return out.withColumns({name: F.coalesce(*tried, F.lit(default)), f"{name}_source": F.coalesce(*labels, F.lit("default"))}).drop(*[f"_l{i}" for i in range(len(levels))])


def most_specific_rate(df: DataFrame, levels: Sequence[tuple[Sequence[str], int, str]], value: str, exposure: str, name: str) -> DataFrame:
    """The rate of the first level with enough rows, and its label. Each level: keys, least rows, label; the last should have none and always hold."""
    chain = []
    for keys, least, label in levels:
        rates = df.groupBy(*keys).agg((F.sum(value) / F.sum(exposure)).alias("_rate"), F.count("*").alias("_n")).filter(F.col("_n") >= least)
        chain.append((rates, keys, "_rate", label))
    return lookup_chain(df, chain, name, 0.0)


def pivot_fixed(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], value: str, prefix: str = "") -> DataFrame:
    """Sums by a fixed list of values as columns, 0 where there is none; one pass, no job to list the values."""
    cols = [F.coalesce(F.sum(F.when(F.col(column) == v, F.col(value))), F.lit(0.0)).alias(f"{prefix}{v}".lower()) for v in values]
    return df.groupBy(*keys).agg(*cols)


def unpivot_fixed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


def plug_residual(df: DataFrame, group: Sequence[str], share: str, order: Sequence[Column]) -> DataFrame:
    """Shares rounded to 6 places, what is missing to 1 added to the group's first row in ``order``."""
    w = Window.partitionBy(*group)
    r = F.round(F.col(share), 6)
    first = F.row_number().over(w.orderBy(*order)) == 1
    return df.withColumn(share, F.round(r + F.when(first, 1 - F.sum(r).over(w)).otherwise(0.0), 6))


def largest(df: DataFrame, columns: Sequence[str], key: str, k: int) -> DataFrame:
    """screen, key, x: the k largest of each column, ties to the smaller key; a column that is NULL throughout gives no rows. Each is a bounded top-k."""
    out = None
    for c in columns:
        rows = df.filter(F.col(c).isNotNull()).select(F.lit(c).alias("screen"), key, F.col(c).cast("double").alias("x")).orderBy(F.desc("x"), key).limit(k)
        out = rows if out is None else out.unionByName(rows)
    return out


def frame_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, atol: float, rtol: float = 0.0) -> DataFrame:
    """Keys on one side alone, and values that differ beyond atol + rtol |right|. NULL equals NULL."""
    a, b = left.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("_l")), right.select(*keys, F.col(value).alias("right_value"), F.lit(True).alias("_r"))
    both = a.join(b, list(keys), "full")
    off = F.abs(F.col("left_value") - F.col("right_value")) > atol + rtol * F.abs(F.col("right_value"))
    kind = F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").when(F.coalesce(off, ~F.col("left_value").eqNullSafe(F.col("right_value"))), "differs")
    return both.withColumn("kind", kind).filter("kind IS NOT NULL").select(*keys, "left_value", "right_value", "kind")


def token_pairs(df: DataFrame, key: str, tokens: str, most: int = 1_000) -> DataFrame:
    """a, b, common: the pairs of rows with key a < b that share any of their distinct tokens, and how many.

    A token of more than ``most`` rows is met in parts, each pair of parts a group of its own."""
    rows = df.withColumn("row", F.monotonically_increasing_id()).select(F.col(key).alias("key"), "row", F.explode(tokens).alias("token"))
    hot = rows.groupBy("token").count().filter(F.col("count") > most).select("token", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    cut = rows.join(hot, "token", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own, every = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = cut.select("token", F.col("key").alias("a"), F.col("row").alias("a_row"), own.alias("i"), every.alias("j"))
    b = cut.select("token", F.col("key").alias("b"), F.col("row").alias("b_row"), every.alias("i"), own.alias("j"))
    met = a.join(b, ["token", "i", "j"]).filter("a < b")
    return met.groupBy("a", "a_row", "b", "b_row").agg(F.count("*").alias("common")).select("a", "b", "common")
