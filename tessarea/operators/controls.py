"""Controls, exposure lanes, silent units and features: totals by unit that later steps hold on to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.functions import clip, ratio
from tessarea.operators import expect, rel
from tessarea.operators.distributed import quantiles


def exposure_partition(shares: DataFrame, unit: str, kind: str, county: str, share: str, population: str, municipal: str = "municipal") -> DataFrame:
    """unit_kind, unit_id, population: municipal shares by their unit, all else by county; together they are the whole population."""
    lived = shares.withColumn("_p", F.col(share) * F.col(population))
    ours = lived.filter(F.col(kind) == municipal).groupBy(F.lit("municipal").alias("unit_kind"), F.col(unit).cast("string").alias("unit_id")).agg(F.sum("_p").alias("population"))
    rest = lived.filter(~F.coalesce(F.col(kind) == municipal, F.lit(False))).groupBy(F.lit("county").alias("unit_kind"), F.col(county).cast("string").alias("unit_id")).agg(F.sum("_p").alias("population"))
    return ours.unionByName(rest)


def silent_units(agencies: DataFrame, unit: Sequence[str], reports: Column, filled: Column, exempt: Column) -> DataFrame:
    """Units none of whose agencies reports or is filled, and none of which is exempt; with the number of their agencies."""
    flags = agencies.groupBy(*unit).agg(F.bool_or(F.coalesce(reports, F.lit(False))).alias("_r"), F.bool_or(F.coalesce(filled, F.lit(False))).alias("_f"), F.bool_or(F.coalesce(exempt, F.lit(False))).alias("_e"), F.count("*").alias("silent_agencies"))
    return flags.filter("NOT _r AND NOT _f AND NOT _e").select(*unit, "silent_agencies")


def land_on_controls(controls: DataFrame, imputed: DataFrame, keys: Sequence[str], count: str, mass: str, label: str, name: str = "imputed") -> DataFrame:
    """Imputed mass added to the controls of its key and the row relabelled; mass without a control stops the job."""
    lost = rel.members(imputed.filter(F.col(mass) != 0), controls, keys, inside=False)
    expect.empty(lost, "imputed mass has no control")
    added = imputed.groupBy(*keys).agg(F.sum(mass).alias("_m"))
    out = controls.join(added, list(keys), "left").withColumn("_m", F.coalesce("_m", F.lit(0.0)))
    return out.withColumns({count: F.col(count) + F.col("_m"), label: F.when(F.col("_m") > 0, F.lit(name)).otherwise(F.col(label)), "landed": F.col("_m")}).drop("_m")


def pooled_sparse_rate(df: DataFrame, levels: Sequence[tuple[Sequence[str], int, str]], count: str, population: str, low: float = 1e4, high: float = 1e5) -> DataFrame:
    """``pooled_rate``: (c + r p) / (n + p), r the most specific peers' rate, p the median population within [low, high]."""
    prior = rel.most_specific_rate(df, levels, count, population, "_prior")
    middle = quantiles(df, [], population, [0.5], ["_m"]).agg(F.max("_m").alias("_m"))  # one row, also without any population
    strength = middle.select(clip(F.col("_m"), low, high).alias("_p"))
    out = prior.crossJoin(strength)
    return out.withColumn("pooled_rate", (F.col(count) + F.col("_prior") * F.col("_p")) / (F.col(population) + F.col("_p"))).drop("_p").withColumnsRenamed({"_prior": "prior_rate", "_prior_source": "prior_source"})


def calibrated(df: DataFrame, own: DataFrame, other: DataFrame, keys: Sequence[str], count: str, total: str) -> DataFrame:
    """Counts times the ratio of another source's total to one's own by key, 1 where either is lacking or not positive."""
    a, b = own.select(*keys, F.col(total).alias("_own")), other.select(*keys, F.col(total).alias("_other"))
    factor = F.coalesce(F.when((F.col("_own") > 0) & (F.col("_other") > 0), F.col("_other") / F.col("_own")), F.lit(1.0))
    return df.join(a, list(keys), "left").join(b, list(keys), "left").withColumn("factor", factor).withColumn("calibrated", F.col(count) * F.col("factor")).drop("_own", "_other")


def scale_to_control(df: DataFrame, control: DataFrame, keys: Sequence[str], value: str, target: str, digits: int = 0) -> DataFrame:
    """Values times control over their sum, rounded half to even; groups without a control stay as they are."""
    out = rel.with_totals(df, keys, _sum=F.sum(value)).join(control.select(*keys, target), list(keys), "left")
    return out.withColumn("scaled", F.bround(F.col(value) * F.coalesce(ratio(target, "_sum"), F.lit(1.0)), digits)).drop("_sum", target)


def outer_merge(frames: Sequence[DataFrame], keys: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Frames of different columns on one key, lacking values filled: one union and one aggregation instead of a chain of full joins. Each frame has a key once."""
    columns = [c for f in frames for c in f.columns if c not in keys]
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.coalesce(F.max(c).cast("double"), F.lit(fill)).alias(c) for c in columns])


def relabel(df: DataFrame, crosswalk: DataFrame, key: str, old: str, new: str, prefix: int) -> DataFrame:
    """Old keys to new ones. Their prefixes, the coarser keys, must map one to one, or the job stops."""
    coarse = crosswalk.select(F.substring(F.col(old).cast("string"), 1, prefix).alias("_a"), F.substring(F.col(new).cast("string"), 1, prefix).alias("_b")).distinct()
    expect.unique(coarse, ["_a"])
    expect.unique(coarse, ["_b"])
    return rel.replaced(df, crosswalk, key, old, new)


def backfill(df: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the registry whose keys are lacking are appended; columns that it lacks are NULL."""
    return df.unionByName(rel.members(registry, df, keys, inside=False), allowMissingColumns=True)


def share_block(df: DataFrame, shares: Mapping[str, tuple[str, str, bool]], logs: Sequence[str] = ()) -> DataFrame:
    """Ratios (numerator, denominator, bounded to [0, 1]) and log1p columns; one whose inputs are lacking is left out."""
    from tessarea.functions import bounded_ratio

    have = set(df.columns)
    made = {name: bounded_ratio(n, d) if bounded else F.when(F.col(d) > 0, ratio(n, d)) for name, (n, d, bounded) in shares.items() if {n, d} <= have}
    return df.withColumns(made | {f"log_{c}": F.log1p(c) for c in logs if c in have})


def useful_features(df: DataFrame, columns: Sequence[str], protected: Sequence[str] = (), least_known: float = 0.01, least_nonzero: float = 0.001) -> list[str]:
    """Columns that are known often enough, not constant and not nearly all zero. One pass over all columns."""
    names = [c for c in columns if c not in protected]
    made = [x for c in names for x in (F.count(c).alias(f"n_{c}"), F.count_if(F.col(c) != 0).alias(f"z_{c}"), (F.max(c) != F.min(c)).alias(f"d_{c}"))]
    row = df.agg(F.count("*").alias("_all"), *made).first()
    every = max(1, row["_all"])
    return [c for c in names if row[f"n_{c}"] >= least_known * every and row[f"z_{c}"] >= least_nonzero * every and row[f"d_{c}"]]


def distinct_columns(df: DataFrame, columns: Sequence[str], key: str) -> list[str]:
    """Of columns with equal values in every row the one with the shortest name, then the first in order. One pass of sums of hashes."""
    row = df.agg(*[F.sum(F.xxhash64(F.col(key), F.col(c).cast("double")).cast("decimal(38,0)")).alias(c) for c in columns]).first()
    kept: dict = {}
    for c in sorted(columns, key=lambda c: (len(c), columns.index(c))):
        kept.setdefault(row[c], c)
    return [c for c in columns if c in kept.values()]


def by_policy(columns: Sequence[str], policy: Mapping[str, str], wanted: Sequence[str]) -> list[str]:
    """Columns whose class is wanted; a column without a class is an error."""
    unknown = [c for c in columns if c not in policy]
    if unknown:
        raise expect.ExpectationError(f"columns without a class: {unknown}")
    return [c for c in columns if policy[c] in wanted]
