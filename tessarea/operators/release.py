"""Checks of a finished surface: jumps between neighbours, seams between sources, groups without variation. Each gives
rows (check, subject, n, measure, limit, breach); all are collected in one job, and a check without rows fails like a breach."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.operators.distributed import quantiles
from tessarea.operators.expect import ExpectationError

VERDICT = ["check", "subject", "n", "measure", "limit", "breach"]


def sharing_borders(shapes: DataFrame, key: str = "id", rings: str = "rings", digits: int = 9) -> DataFrame:
    """id, id2 (id < id2) and ``border``: the length of the straight pieces that two shapes have in common, corner to corner.

    A piece is known by its two ends in order, so shapes meet by one equi-join, without a search."""
    point = lambda p: F.struct(F.round(p["x"], digits).alias("x"), F.round(p["y"], digits).alias("y"))
    ring = F.filter("ring", lambda p: p.isNotNull())
    n = F.size(ring)
    sides = F.zip_with(ring, F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1)), lambda a, b: F.struct(F.least(point(a), point(b)).alias("a"), F.greatest(point(a), point(b)).alias("b")))
    pieces = shapes.select(F.col(key).alias("id"), F.explode(rings).alias("ring")).filter("size(ring) > 1").select("id", F.explode(sides).alias("piece")).filter("piece.a <> piece.b").distinct()
    met = pieces.join(pieces.select(F.col("id").alias("id2"), "piece"), "piece").filter("id < id2")
    d = lambda c: F.col(f"piece.b.{c}") - F.col(f"piece.a.{c}")
    return met.groupBy("id", "id2").agg(F.sum(F.sqrt(d("x") * d("x") + d("y") * d("y"))).alias("border"))


def each_once(graph: DataFrame, most_km: float | None = None) -> DataFrame:
    """Neighbours (id, id2) as unordered pairs, within ``most_km`` if it is given."""
    near = graph.filter(F.col("km") <= most_km) if most_km is not None else graph
    return near.select(F.least("id", "id2").alias("id"), F.greatest("id", "id2").alias("id2")).distinct()


def pair_gaps(surface: DataFrame, pairs: DataFrame, value: str, kinds: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """kind, n, median of |log1p a - log1p b| over the pairs of each kind with both values known (below 0: taken as 0).

    A kind is a condition on the columns ``a_x`` and ``b_x`` of the two places; a pair may be of several kinds."""
    side = lambda s, key: surface.select(F.col("id").alias(key), *[F.col(c).alias(f"{s}_{c}") for c in {value, *columns}])
    both = pairs.join(side("a", "id"), "id").join(side("b", "id2"), "id2")
    log = lambda s: F.log1p(F.greatest(F.col(f"{s}_{value}").cast("double"), F.lit(0.0)))
    labels = F.filter(F.array(*[F.when(condition, F.lit(name)) for name, condition in kinds.items()]), lambda x: x.isNotNull())
    gaps = both.withColumn("gap", F.abs(log("a") - log("b"))).filter("gap IS NOT NULL").select(F.explode(labels).alias("kind"), "gap")
    return quantiles(gaps, ["kind"], "gap", [0.5], ["median"]).join(gaps.groupBy("kind").agg(F.count("*").alias("n")), "kind").select("kind", "n", "median")


def jumps(check: str, gaps: DataFrame, baseline: str, ratio: float, gap: float, least: int, least_baseline: int) -> DataFrame:
    """A kind of pairs breaches if its median gap is over ``gap`` and over ``ratio`` times the baseline kind's, with enough pairs of both."""
    base = gaps.filter(F.col("kind") == baseline).agg(F.max("median").alias("base"), F.max("n").alias("base_n"))  # one row
    rows = gaps.filter(F.col("kind") != baseline).crossJoin(F.broadcast(base))
    times = F.try_divide("median", F.when(F.col("base") > 0, F.col("base")))
    broken = (F.col("n") >= least) & (F.coalesce("base_n", F.lit(0)) >= least_baseline) & (times > ratio) & (F.col("median") > gap)
    return rows.select(F.lit(check).alias("check"), F.col("kind").alias("subject"), "n", times.alias("measure"), F.lit(float(ratio)).alias("limit"), F.coalesce(broken, F.lit(False)).alias("breach"))


def flatness(check: str, surface: DataFrame, group: str, value: str, expected: str, least: int, least_expected: float, spread: float, most_range: float) -> DataFrame:
    """Groups with enough places and expected counts whose values hardly vary: the 95th percentile over the 5th, in logs, and the range."""
    known = surface.filter(F.col(value).isNotNull()).select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("subject"), F.col(value).cast("double").alias("v"), F.greatest(F.coalesce(F.col(expected).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("e"))
    sums = known.groupBy("subject").agg(F.count("*").alias("n"), F.sum("e").alias("e"), (F.max("v") - F.min("v")).alias("range"))
    tails = quantiles(known, ["subject"], "v", [0.05, 0.95], ["low", "high"])
    logs = F.log1p(F.greatest("high", F.lit(0.0))) - F.log1p(F.greatest("low", F.lit(0.0)))
    flat = (F.col("n") >= least) & (F.col("e") >= least_expected) & (logs < spread) & (F.col("range") < most_range)
    return sums.join(tails, "subject").select(F.lit(check).alias("check"), "subject", "n", logs.alias("measure"), F.lit(float(spread)).alias("limit"), flat.alias("breach"))


def plausible(check: str, surface: DataFrame, group: str, count: str, population: str, low: float, high: float, per: float = 100_000.0) -> DataFrame:
    """Groups whose rate per ``per`` inhabitants lies outside low to high; without inhabitants any count is a breach."""
    sums = surface.groupBy(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("subject")).agg(F.count("*").alias("n"), F.sum(count).cast("double").alias("c"), F.sum(population).cast("double").alias("p"))
    rate = F.try_divide(F.col("c") * per, F.when(F.col("p") > 0, F.col("p")))
    off = F.coalesce((rate < low) | (rate > high), F.col("c") > 0, F.lit(False))
    return sums.select(F.lit(check).alias("check"), "subject", "n", rate.alias("measure"), F.lit(float(high)).alias("limit"), off.alias("breach"))


def hotspots(check: str, surface: DataFrame, value: str, exposure: str, times: float, tail: float = 0.05, floor: float = 0.0) -> DataFrame:
    """Places far above the rest only because hardly anything stands below the line: the value over ``times`` the 99th percentile, with an exposure in
    its lowest ``tail`` or at most ``floor``. The rows are the breaches and one row for the whole surface."""
    known = surface.filter(F.col(value).isNotNull() & (F.col(exposure) > 0)).select("id", F.col(value).cast("double").alias("v"), F.col(exposure).cast("double").alias("e"))
    cuts = quantiles(known, [], "v", [0.99], ["high"]).crossJoin(quantiles(known, [], "e", [tail], ["low"]))  # one row each
    rows = known.crossJoin(F.broadcast(cuts)).withColumn("breach", (F.col("v") > times * F.col("high")) & (F.col("e") <= F.greatest("low", F.lit(floor))))
    limit = (F.lit(float(times)) * F.col("high")).alias("limit")
    own = rows.filter("breach").select(F.lit(check).alias("check"), F.col("id").cast("string").alias("subject"), F.lit(1).cast("long").alias("n"), F.col("v").alias("measure"), limit, "breach")
    whole = rows.groupBy(limit).agg(F.count("*").alias("n"), F.max("v").alias("measure"), F.max("breach").alias("breach"))
    return own.unionByName(whole.select(F.lit(check).alias("check"), F.lit("all").alias("subject"), "n", "measure", "limit", "breach"))


def verdicts(*checks: DataFrame) -> DataFrame:
    out = checks[0].select(*VERDICT)
    for check in checks[1:]:
        out = out.unionByName(check.select(*VERDICT))
    return out


def require(names: Sequence[str], *checks: DataFrame) -> dict[str, int]:
    """How many rows each named check compared. Raises if one has a breach, or none to compare. One job; of the breaches of a check the first and the last come to the driver."""
    found = verdicts(*checks).groupBy("check").agg(F.sum("n").alias("n"), F.count_if("breach").alias("broken"), F.min(F.when(F.col("breach"), F.struct("subject", "measure"))).alias("first"), F.max(F.when(F.col("breach"), F.struct("subject", "measure"))).alias("last")).collect()
    seen = {row["check"]: row for row in found}
    missing = [name for name in names if name not in seen or not seen[name]["n"]]
    broken = {name: (row["broken"], tuple(row["first"]), tuple(row["last"])) for name, row in seen.items() if row["broken"]}
    if missing or broken:
        raise ExpectationError(f"checks that had nothing to compare: {missing}; breaches (number, first and last): {broken}")
    return {name: seen[name]["n"] for name in names}
