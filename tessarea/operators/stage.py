"""A table that is published only if all its checks hold.

Rules on rows are metrics that Spark observes while the table is written; checks on keys and sums are then one job over the few
columns that they need, each row sent once a check as (check, key, value). Filters leave a witness: what they matched is counted
before them, and what still matches is counted in the rows that are written. The table is written beside its place and
renamed, so a reader sees the former table or the whole new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessarea.operators.expect import ExpectationError


class Stage:
    """Collects filters and checks of one table, then publishes it.

    ``key`` names rows in reports; of the offenders of a check the smallest and the largest key are kept, and their number."""

    def __init__(self, df: DataFrame, key: Sequence[str]):
        self.df, self.key = df, list(key)
        self.rules: dict[str, Column] = {}
        self.filters: dict[str, tuple[Column, int | None]] = {}
        self.grouped: dict[str, tuple[list[str], Column, Column]] = {}
        self.watched: list[tuple[str, Observation]] = []

    def drop(self, name: str, condition: Column, expected: int | None = None) -> Stage:
        """Rows that meet the condition go. ``expected`` is how many there must be; without it any number but none will do."""
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        met = F.coalesce(condition, F.lit(False))
        self.df = self.df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(met).alias("met")).filter(~met)
        self.watched.append((name, seen))
        self.filters[name] = (condition, expected)
        return self

    def rule(self, name: str, condition: Column) -> Stage:
        """Holds in every row; NULL is a breach."""
        self.rules[name] = condition
        return self

    def unique(self, name: str, keys: Sequence[str]) -> Stage:
        self.grouped[name] = (list(keys), F.lit(1.0), F.col("total") == 1)
        return self

    def sums_to(self, name: str, keys: Sequence[str], value: str, total: float, tolerance: float = 1e-9) -> Stage:
        self.grouped[name] = (list(keys), F.col(value).cast("double"), F.abs(F.col("total") - total) <= tolerance)
        return self

    def balanced(self, name: str, keys: Sequence[str], left: str, right: str, tolerance: float = 1e-6) -> Stage:
        """Two columns have the same totals by ``keys``."""
        self.grouped[name] = (list(keys), F.coalesce(F.col(left).cast("double"), F.lit(0.0)) - F.coalesce(F.col(right).cast("double"), F.lit(0.0)), F.abs("total") <= tolerance)
        return self

    def within(self, name: str, keys: Sequence[str], value: str, most: float) -> Stage:
        """Totals by ``keys`` are ``most`` at most."""
        self.grouped[name] = (list(keys), F.col(value).cast("double"), F.col("total") <= most)
        return self

    def _row_metrics(self) -> list[Column]:
        name = F.struct(*self.key)
        out = [F.count(F.lit(1)).alias("rows")]
        for i, condition in enumerate(self.rules.values()):
            off = ~F.coalesce(condition, F.lit(False))
            out += [F.count_if(off).alias(f"rule{i}"), F.min(F.when(off, name)).alias(f"rule{i}_first"), F.max(F.when(off, name)).alias(f"rule{i}_last")]
        for i, (condition, _) in enumerate(self.filters.values()):
            out.append(F.count_if(F.coalesce(condition, F.lit(False))).alias(f"left{i}"))
        return out

    def _group_breaches(self, written: DataFrame) -> dict[str, tuple]:
        """One aggregate for all checks: a row meets each check once, with the check's key and value."""
        if not self.grouped:
            return {}
        ways = [F.struct(F.lit(n).alias("check"), F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key"), value.alias("value")) for n, (keys, value, _) in self.grouped.items()]
        sums = written.select(F.explode(F.array(*ways)).alias("x")).groupBy("x.check", "x.key").agg(F.sum("x.value").alias("total"))
        holds = F.lit(False)
        for n, (_, _, condition) in self.grouped.items():
            holds = F.when(F.col("check") == n, condition).otherwise(holds)
        off = sums.filter(~F.coalesce(holds, F.lit(False))).groupBy("check").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
        return {r["check"]: (r["n"], r["first"], r["last"]) for r in off.collect()}

    def publish(self, path: str) -> dict[str, int]:
        """Writes, checks and renames. Gives the rows written and what each filter dropped; raises, and leaves what was there, if anything is broken."""
        spark, made = self.df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}"
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = place(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        whole = Observation(f"rows-{uuid.uuid4().hex[:8]}")
        try:
            self.df.observe(whole, *self._row_metrics()).write.parquet(made)
            seen = whole.get
            broken: dict[str, tuple] = {}
            for i, name in enumerate(self.rules):
                if seen[f"rule{i}"]:
                    broken[name] = (seen[f"rule{i}"], *(tuple(seen[f"rule{i}_{e}"]) for e in ("first", "last")))
            dropped = {name: found.get["met"] for name, found in self.watched}
            for i, (name, (_, expected)) in enumerate(self.filters.items()):
                if dropped[name] == 0 and expected is None or expected is not None and dropped[name] != expected:
                    broken[name] = (dropped[name], "rows met by the filter", expected)
                if seen[f"left{i}"]:
                    broken[f"{name}: not run"] = (seen[f"left{i}"], "rows left", None)
            broken |= self._group_breaches(spark.read.schema(self.df.schema).parquet(made))
            if broken:
                raise ExpectationError(f"not published; broken (number, first and last): {broken}")
            old = f"{made}.old"
            if fs.exists(place(path)):
                fs.rename(place(path), place(old))
            if not fs.rename(place(made), place(path)):
                raise ExpectationError(f"{made} could not be renamed")
            fs.delete(place(old), True)
            return {"rows": seen["rows"], **dropped}
        finally:
            fs.delete(place(made), True)
