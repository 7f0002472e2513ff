"""Allocation of totals to units: remainders, overlaps, displacement and support."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.functions import case_first, ratio
from tessarea.operators import expect, rel


def carve_out(target: str, reported: str, imputed: str) -> dict[str, Column]:
    """A target in three parts that sum to it: reported up to the target, imputed up to what is left, the adjustment for the rest."""
    own = F.least(F.greatest(F.col(reported), F.lit(0.0)), F.col(target))
    more = F.least(F.greatest(F.col(imputed), F.lit(0.0)), F.col(target) - own)
    return {"reported_part": own, "imputed_part": more, "adjustment_part": F.col(target) - own - more}


def split_remainder(groups: DataFrame, keys: Sequence[str], target: str, evidence: str, anchored: Column, rare: Column, least: float = 3.0) -> DataFrame:
    """``part``: each key's target among its anchored groups in proportion to their evidence and the residual group, which takes
    what evidence doesn't reach. A rare offense's anchored groups need evidence of ``least`` or more, or they get nothing.

    The residual group of a key is the row that isn't anchored; one must be there. It takes the difference, so parts sum to the target."""
    expect.empty(groups.groupBy(*keys).agg(F.count_if(~anchored).alias("n")).filter("n <> 1"), "a key needs one residual group")
    held = groups.withColumn("_e", F.when(anchored & (~rare | (F.col(evidence) >= least)), F.greatest(F.col(evidence), F.lit(0.0))).when(anchored, F.lit(0.0)).otherwise(F.greatest(F.col(evidence), F.lit(0.0))))
    out = rel.with_totals(held, keys, _all=F.sum("_e")).withColumn("_p", F.when(anchored, F.coalesce(F.col(target) * ratio("_e", "_all"), F.lit(0.0))))
    out = rel.with_totals(out, keys, _given=F.coalesce(F.sum("_p"), F.lit(0.0)))
    return out.withColumn("part", F.when(anchored, F.col("_p")).otherwise(F.col(target) - F.col("_given"))).drop("_e", "_all", "_p", "_given")


def route(flags: Sequence[tuple[str, str]], default: str) -> Column:
    """The kind of group of the first flag that holds."""
    return case_first([(F.coalesce(F.col(flag), F.lit(False)), kind) for flag, kind in flags], default)


def demote(df: DataFrame, kind: str, group: Sequence[str], support: str, evidence: str, rare: Column, falls: Mapping[str, str], least: float = 3.0) -> DataFrame:
    """Groups without support, or rare ones without evidence of ``least``, fall to another kind; judged by their group's sums."""
    out = rel.with_totals(df, [*group, kind], _s=F.sum(support), _e=F.sum(evidence))
    weak = (F.coalesce("_s", F.lit(0.0)) <= 0) | (rare & (F.coalesce("_e", F.lit(0.0)) < least))
    fallen = case_first([(F.col(kind) == a, b) for a, b in falls.items()], F.col(kind))
    return out.withColumn(kind, F.when(weak, fallen).otherwise(F.col(kind))).drop("_s", "_e")


def overlap_lanes(targets: DataFrame, units: DataFrame, lanes: Mapping[str, tuple[str, Column]], weight: str, unit: str, target: str) -> DataFrame:
    """unit, lane, count: the targets of each lane (rows with ``kind`` and ``place``) on the units of their place by weight.

    A lane is a unit's column that names the place and a condition on units. Targets whose place has no weight stop the job."""
    out = None
    for lane, (place, where) in lanes.items():
        weights = units.filter(where).select(F.col(place).alias("place"), F.col(unit).alias("unit"), F.col(weight).alias("_w"))
        shares = rel.share_of_group(weights, ["place"], "_w", "_share").filter("_share > 0")
        mine = targets.filter(F.col("kind") == lane).groupBy("place").agg(F.sum(target).alias("_t"))
        expect.empty(rel.members(mine.filter("_t > 0"), shares, ["place"], inside=False), f"targets of {lane} without units")
        rows = mine.join(shares, "place").select("unit", F.lit(lane).alias("lane"), (F.col("_t") * F.col("_share")).alias("count"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("unit", "lane").agg(F.sum("count").alias("count"))


def footprint_shares(df: DataFrame, group: Sequence[str], basis: str, activity: str, weight: str) -> DataFrame:
    """``share``: by the declared basis activity times weight ("activity") or the weight as it is ("verbatim"); other bases stop the job."""
    expect.all_hold(df, basis=F.col(basis).isin("activity", "verbatim"))
    return rel.share_of_group(df.withColumn("_v", F.when(F.col(basis) == "activity", F.col(activity) * F.col(weight)).otherwise(F.col(weight))), group, "_v", "share", weight).drop("_v")


def displace(shares: DataFrame, covers: DataFrame, group: Sequence[str], unit: str, share: str, cover: str, carved: Column | None = None) -> DataFrame:
    """Shares of units scaled by 1 minus the largest cover on them, zeros dropped, renormalised; where ``carved`` holds the cover is none.

    A group that loses all its units stops the job."""
    most = covers.filter(~F.coalesce(carved, F.lit(False))) if carved is not None else covers
    most = most.groupBy(unit).agg(F.max(cover).alias("_c"))
    left = shares.join(most, unit, "left").withColumn("_s", F.col(share) * (1 - F.least(F.coalesce("_c", F.lit(0.0)), F.lit(1.0)))).filter("_s > 0")
    expect.empty(rel.members(shares.filter(F.col(share) > 0).select(*group).distinct(), left, group, inside=False), "all units of a group are displaced")
    return rel.share_of_group(left.drop(share), group, "_s", share).drop("_s", "_c")


def consolidated(support: DataFrame, county: DataFrame, excluded: DataFrame, principal: str, unit: str) -> DataFrame:
    """The units of principals that a county takes over: their county's units but for those of excluded places; others keep theirs.

    ``county`` has (principal, unit), ``excluded`` (principal, unit)."""
    over = rel.members(county.select(principal, unit).distinct(), excluded, [principal, unit], inside=False)
    return rel.members(support.select(principal, unit), county, [principal], inside=False).unionByName(over).distinct()


def move_from_empty(df: DataFrame, group: Sequence[str], count: str, denominator: str) -> DataFrame:
    """Counts on rows without a denominator go to the group's rows with one, by their counts, or by the denominator if those are all 0."""
    good = F.col(denominator) > 0
    out = rel.with_totals(df, group, _move=F.sum(F.when(~good, F.col(count)).otherwise(0.0)), _c=F.sum(F.when(good, F.col(count)).otherwise(0.0)), _d=F.sum(F.when(good, F.col(denominator)).otherwise(0.0)))
    share = F.when(F.col("_c") > 0, F.col(count) / F.col("_c")).otherwise(ratio(denominator, "_d"))
    moved = F.when(good, F.col(count) + F.col("_move") * share).when(F.col("_d") > 0, F.lit(0.0)).otherwise(F.col(count))
    return out.withColumn(count, moved).drop("_move", "_c", "_d")


def targets_hold(df: DataFrame, group: Sequence[str], target: str, drawn: str, tolerance: float = 1e-6) -> None:
    """No group's target is negative, and none is drawn on for more than it has."""
    sums = df.groupBy(*group).agg(F.sum(target).alias("t"), F.sum(drawn).alias("d"))
    expect.all_hold(sums, not_negative=F.col("t") >= -tolerance, not_overdrawn=F.col("d") <= F.col("t") + tolerance)


def direct_support(coverage: DataFrame, observed: DataFrame, unit: str, offense: str, offenses: Mapping[str, str], year: str, count: str) -> DataFrame:
    """By unit, for each offense (value and column prefix): support ("observed", "covered" or "model_only"), first and last year and count.

    ``coverage`` has (unit, offense, year) where anything reports, ``observed`` (unit, offense, year, count)."""
    held = coverage.groupBy(unit, offense).agg(F.min(year).alias("_a"), F.max(year).alias("_b"))
    seen = observed.groupBy(unit, offense).agg(F.sum(count).alias("_n"))
    rows = held.join(seen, [unit, offense], "left")
    made = []
    for value, name in offenses.items():
        at = lambda c, v=value: F.max(F.when(F.col(offense) == v, F.col(c)))
        made += [F.when(at("_n") > 0, "observed").when(at("_a").isNotNull(), "covered").otherwise("model_only").alias(f"{name}_support"), at("_a").alias(f"{name}_first"), at("_b").alias(f"{name}_last"), F.coalesce(at("_n"), F.lit(0)).alias(f"{name}_count")]
    return rows.groupBy(unit).agg(*made)


def mode_mix(df: DataFrame, keys: Sequence[str], mode: str, mass: str, direct: str = "direct", least: float = 0.6) -> DataFrame:
    """``mode_mix``: direct or modeled if that part of the mass is ``least`` or more, else mixed; NULL without mass."""
    sums = df.groupBy(*keys).agg(F.sum(mass).alias("_all"), F.sum(F.when(F.col(mode) == direct, F.col(mass)).otherwise(0.0)).alias("_direct"))
    share = ratio("_direct", "_all")
    return sums.select(*keys, share.alias("direct_share"), F.when(share >= least, "direct").when(1 - share >= least, "modeled").when(share.isNotNull(), "mixed").alias("mode_mix"))
