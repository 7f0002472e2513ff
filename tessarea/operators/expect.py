"""Fail-closed assertions. Each expectation is an aggregate; a batch of them is one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


PARTS, EPSILON = 1024, {"double": 2.0**-52, "float": 2.0**-23}  # parts of a sum; what one addition may round off, twofold


class ExpectationError(AssertionError):
    pass


def unique(df: DataFrame, keys: Sequence[str]) -> None:
    found = df.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if found:
        raise ExpectationError(f"keys {list(keys)} are not unique, for example {[tuple(r) for r in found]}")


def empty(df: DataFrame, message: str) -> None:
    found = df.limit(5).collect()
    if found:
        raise ExpectationError(f"{message}: {[tuple(r) for r in found]}")


def vocabulary(df: DataFrame, keys: Sequence[str], column: str, words: Sequence[str]) -> None:
    """Each key has all the words and no other."""
    n = df.groupBy(*keys).agg(F.countDistinct(F.when(F.col(column).isin(*words), F.col(column))).alias("n"), F.count_if(~F.coalesce(F.col(column).isin(*words), F.lit(False))).alias("other"))
    empty(n.filter((F.col("n") < len(set(words))) | (F.col("other") > 0)), f"{column} is incomplete or has other values")


def referential(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> None:
    """Each key stands in the parent. NULL keys refer to nothing."""
    side = df.select(*keys).dropna(how="any").join(parent.select(*keys), list(keys), "left_anti")
    empty(side, f"{list(keys)} that the parent lacks")


def exclusive(df: DataFrame, keys: Sequence[str], lane: str) -> None:
    """No key stands in more than one lane."""
    empty(df.groupBy(*keys).agg(F.countDistinct(lane).alias("n")).filter("n > 1"), f"keys in several lanes of {lane}")


def within_residual(df: DataFrame, keys: Sequence[str], imputed: str, residual: str, tolerance: float = 1e-6) -> None:
    """What is imputed by key is no more than the key's residual, which every row of it repeats."""
    sums = df.groupBy(*keys).agg(F.sum(imputed).alias("i"), F.max(residual).alias("r"))
    empty(sums.filter(F.col("i") > F.col("r") + tolerance), "more imputed than the residual")


def count_is(df: DataFrame, condition: Column, n: int) -> None:
    """Just n rows hold: a registry's entries were all met, or a filter was run and not merely matched."""
    found = df.agg(F.count_if(condition).alias("n")).first()["n"]
    if found != n:
        raise ExpectationError(f"{found} rows hold, not {n}")


def functional(df: DataFrame, key: str, value: str) -> None:
    """Each key has exactly one value."""
    found = df.groupBy(key).agg(F.countDistinct(value).alias("n")).filter("n <> 1").limit(5).collect()
    if found:
        raise ExpectationError(f"{key} does not determine {value}: {[r[0] for r in found]}")


def all_hold(df: DataFrame, **rules: Column) -> None:
    """Every row keeps every rule; a NULL counts as a breach. One pass."""
    row = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]).first()
    broken = {name: row[name] for name in rules if row[name]}
    if broken:
        raise ExpectationError(f"rows that break a rule: {broken}")


def sums_to(df: DataFrame, group: Sequence[str], value: str, total: float = 1.0, tolerance: float = 1e-9) -> None:
    found = df.groupBy(*group).agg(F.sum(value).alias("s")).filter(F.abs(F.col("s") - total) > tolerance).limit(5).collect()
    if found:
        raise ExpectationError(f"{value} does not sum to {total}: {[tuple(r) for r in found]}")


def _summed(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sums by key in two steps, so that few additions follow one another, and what rounding may have added: nothing to whole numbers."""
    kind = df.select(value).schema[0].dataType.simpleString()
    parts = df.withColumn("_part", F.monotonically_increasing_id() % PARTS).groupBy(*keys, "_part").agg(F.sum(value).alias("s"), F.sum(F.abs(value)).alias("m"), F.count(value).alias("n"))
    slack = (F.max("n") + PARTS) * F.sum("m") * EPSILON.get(kind, 0.0)
    return parts.groupBy(*keys).agg(F.sum("s").alias(name), slack.alias("slack"))


def reconciles(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> None:
    """The two sides have the same totals by ``keys`` but for ``tolerance`` and what sums in another order may differ by. NULL keys are equal."""
    both = _summed(left, keys, value, "a").unionByName(_summed(right, keys, value, "b"), allowMissingColumns=True)
    sums = both.groupBy(*keys).agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.sum("slack").alias("slack"))
    found = sums.filter(F.abs(F.col("a") - F.col("b")) > tolerance + F.coalesce("slack", F.lit(0.0))).drop("slack").limit(5).collect()
    if found:
        raise ExpectationError(f"totals of {value} differ: {[tuple(r) for r in found]}")


def ratchet(now: float, baseline: float, most: float = 0.1) -> None:
    """A total may fall freely but rise by ``most`` of its baseline only."""
    if now > baseline * (1 + most):
        raise ExpectationError(f"{now} exceeds the baseline {baseline} by more than {most:.0%}")
