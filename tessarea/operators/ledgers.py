"""Identity and lane ledgers: who counts as whom, which lane speaks for whom, and what overrides say."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessarea.operators import expect, rel


def supplement_walk(values: DataFrame, entity: Sequence[str], item: str, lane: str, value: str, signals: dict[str, Column], order: Sequence[Column]) -> DataFrame:
    """One lane per entity by ``order`` over ``signals`` (aggregates of an entity's rows in a lane); an item that it lacks comes
    from the best ranked lane that has it, flagged as a supplement. Rows with a NULL value count as lacking."""
    lanes = values.groupBy(*entity, lane).agg(*[x.alias(name) for name, x in signals.items()])
    ranks = rel.ranked(lanes, entity, order, "_rank").select(*entity, lane, "_rank")
    rows = values.filter(F.col(value).isNotNull()).join(ranks, [*entity, lane])
    best = rows.groupBy(*entity, item).agg(F.min_by(F.struct(lane, value), "_rank").alias("_best"), F.min("_rank").alias("_rank"))
    return best.select(*entity, item, f"_best.{lane}", f"_best.{value}", (F.col("_rank") > 0).alias("supplement"))


def by_label(label: str, columns: dict[str, str]) -> Column:
    """The column that the label names, NULL for other labels."""
    out = F.lit(None)
    for name, column in columns.items():
        out = F.when(F.col(label) == name, F.col(column)).otherwise(out)
    return out


def support_flags(months, count, coherent) -> dict[str, Column]:
    """supported, true_partial (1 to 11 months of a coherent year) and usable (a whole year): at most one of the last two holds."""
    m, known = F.coalesce(months, F.lit(0)), count.isNotNull()
    partial = known & m.between(1, 11) & F.coalesce(coherent, F.lit(False))
    return {"supported": known & (m > 0), "true_partial": partial, "usable": known & (m >= 12)}


def corroborated(value, reference, months, other) -> Column:
    """A whole year equal to the reference, where the other lane says something else or nothing."""
    return F.coalesce((value == reference) & (months >= 12) & (other.isNull() | (other != value)), F.lit(False))


def twin_ledger(vectors: DataFrame, entity: str, year: str, within: Sequence[str], vector: str, least_years: int) -> DataFrame:
    """variant, canonical, years: entities whose vectors equal those of the smallest entity of their stem in many years.

    Each year's equal vectors point to their smallest entity, so the pairs grow with the rows, not with their squares."""
    groups = vectors.groupBy(*within, year, vector).agg(F.min(entity).alias("canonical"))
    pairs = vectors.join(groups, [*within, year, vector]).filter(F.col(entity) != F.col("canonical"))
    return pairs.groupBy(F.col(entity).alias("variant"), "canonical").agg(F.count("*").alias("years")).filter(F.col("years") >= least_years)


def rekey(df: DataFrame, ledger: DataFrame, key: str, old: str = "variant", new: str = "canonical") -> DataFrame:
    """Keys by a ledger in which each old key has one new one, others as they are; ``rekeyed`` tells which."""
    expect.unique(ledger, [old])
    side = ledger.select(F.col(old).alias(key), F.col(new).alias("_new"))
    out = df.join(side, key, "left")
    return out.select(*[F.coalesce("_new", key).alias(key) if c == key else F.col(c) for c in df.columns], F.col("_new").isNotNull().alias("rekeyed"))


def mass_neutral(members: DataFrame, case: str, footprint: str) -> DataFrame:
    """case, applies: a merge is applied only if all members have one and the same footprint, else it is set aside."""
    return members.groupBy(case).agg(((F.countDistinct(footprint) == 1) & (F.count_if(F.col(footprint).isNull()) == 0)).alias("applies"))


def combine(rules: DataFrame, registry: DataFrame, key: str, value: str) -> DataFrame:
    """Two ledgers as one, with the source; a key on which they disagree stops the job."""
    a, b = rules.select(key, F.col(value).alias("_rule")), registry.select(key, F.col(value).alias("_registry"))
    both = a.join(b, key, "full")
    expect.all_hold(both, agree=F.coalesce(F.col("_rule") == F.col("_registry"), F.lit(True)))
    source = F.when(F.col("_rule").isNull(), "registry").when(F.col("_registry").isNull(), "rule").otherwise("both")
    return both.select(key, F.coalesce("_rule", "_registry").alias(value), source.alias("source"))


def override(df: DataFrame, registry: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns overwritten where the registry has a value for the key; a key twice in the registry stops the job."""
    expect.unique(registry, keys)
    side = registry.select(*keys, *[F.col(c).alias(f"_to_{c}") for c in columns], F.lit(True).alias("_hit"))
    out = df.join(side, list(keys), "left")
    return out.select(*[F.coalesce(f"_to_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns], F.coalesce("_hit", F.lit(False)).alias("overridden"))


def succession(last_seen: DataFrame, footprint: DataFrame, entity: str, unit: str, now: int, silence: int = 2, block: int = 1 << 16) -> DataFrame:
    """dead, live: entities silent for more than ``silence`` years all of whose units one live entity covers; the smallest such one.

    ``last_seen`` has (entity, last), ``footprint`` distinct (entity, unit). Equal footprints are one. Blocks of some ``block`` dead footprints meet
    blocks of as many live ones, and a task holds one of each: no pair is a row. A NULL unit is covered by nothing."""
    units = footprint.join(last_seen.select(entity, (F.col("last") < now - silence).alias("_dead")).filter("_dead IS NOT NULL"), entity)
    sets = rel.once(units.groupBy(entity, "_dead").agg(F.array_sort(F.collect_set(unit)).alias("_units"), F.count_if(F.col(unit).isNull()).alias("_unknown")), "sets")
    dead = sets.filter("_dead AND _unknown = 0").select(F.col(entity).alias("dead"), "_units")
    live = rel.once(sets.filter("NOT _dead").groupBy("_units").agg(F.min(entity).alias("live")), "live")
    wanted = rel.once(dead.groupBy("_units").agg(F.min("dead").alias("_first")), "wanted")
    rows, columns = (max(1, -(-df.count() // block)) for df in (wanted, live))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = wanted.select(dealt("_first", rows).alias("_i"), every(columns).alias("_j"), "_first", "_units").groupBy("_i", "_j")
    right = live.select(every(rows).alias("_i"), dealt("live", columns).alias("_j"), "live", "_units").groupBy("_i", "_j")
    made = StructType([StructField("_first", dead.schema["dead"].dataType), StructField("live", live.schema["live"].dataType)])
    first = _first_covers(left, right, made).groupBy("_first").agg(F.min("live").alias("live"))
    covered = wanted.join(first, "_first").select("_units", "live")
    return dead.join(covered, "_units").select("dead", "live")


def _first_covers(wanted: GroupedData, live: GroupedData, made: StructType) -> DataFrame:
    """_first, live: each wanted footprint's smallest live one among those given that has all its units.

    A unit is the places of the live ones that have it, in their order: a bitmap if it is common, else a sorted list, so that units take little
    more than their rows. If all units are common their bitmaps are cut, else the rarest one's list is looked up in the others."""

    def run(wanted: pa.Table, live: pa.Table) -> pa.Table:
        live = live.select(["live", "_units"]).sort_by("live")
        lists = live["_units"].combine_chunks()
        held = lists.flatten().dictionary_encode()
        codes = held.indices.to_numpy()
        at = np.repeat(np.arange(len(lists), dtype=np.int64), lists.value_lengths().to_numpy())
        counts = np.bincount(codes, minlength=len(held.dictionary))
        sorted_at, starts = at[np.argsort(codes, kind="stable")], np.concatenate([[0], np.cumsum(counts)])
        places = lambda code: sorted_at[starts[code] : starts[code + 1]]
        words = -(-len(lists) // 64)
        common = np.flatnonzero(counts >= max(1, words // 2))
        line, bitmaps = np.full(len(counts), -1), np.zeros((len(common), words * 8), np.uint8)
        line[common] = np.arange(len(common))
        for i, code in enumerate(common):
            has = np.zeros(words * 64, np.uint8)
            has[places(code)] = 1
            bitmaps[i] = np.packbits(has, bitorder="little")
        whole = bitmaps.view("<u8")

        asked = wanted["_units"].combine_chunks()
        found = pc.fill_null(pc.index_in(asked.flatten(), value_set=held.dictionary), -1).to_numpy()
        ends = np.cumsum(asked.value_lengths().to_numpy())
        hits, smallest = [], []
        for row, (start, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True)):
            mine = found[start:end]
            if mine.min(initial=0) < 0:
                continue
            lines = line[mine]
            rare = mine[lines < 0]
            if not len(rare):
                cut = np.bitwise_and.reduce(whole[lines], axis=0)
                word = int((cut != 0).argmax())
                bits = int(cut[word])
                if bits:
                    hits.append(row)
                    smallest.append(word * 64 + (bits & -bits).bit_length() - 1)
                continue
            left = places(rare[counts[rare].argmin()])
            for code in rare:
                left = left[np.isin(left, places(code), assume_unique=True)]
            for i in lines[lines >= 0]:
                left = left[(bitmaps[i][left >> 3] >> (left & 7)) & 1 == 1]
            if len(left):
                hits.append(row)
                smallest.append(int(left[0]))
        return pa.table({"_first": wanted["_first"].take(pa.array(hits, pa.int64())), "live": live["live"].take(pa.array(smallest, pa.int64()))})

    return wanted.cogroup(live).applyInArrow(run, made)


def sane_or_ladder(df: DataFrame, entity: Sequence[str], current: str, annualised: str, ladder: str, panel_most: str, times: float = 3.0) -> DataFrame:
    """``value`` is the annualised count, but for entities whose total uplift exceeds ``times`` their largest year: those take the ladder's.

    ``panel_most`` is a column with the entity's largest year."""
    out = rel.with_totals(df, entity, _up=F.sum(F.col(annualised) - F.col(current)), _most=F.max(panel_most))
    wild = F.coalesce(F.col("_up") > times * F.col("_most"), F.lit(False))
    return out.withColumns({"value": F.when(wild, F.col(ladder)).otherwise(F.col(annualised)), "capped": wild}).drop("_up", "_most")


def no_fill_where_reported(df: DataFrame, filled: Column, reported: Column, exempt: Column) -> None:
    """No row may hold a fill where a whole report stands, but for exempt ones."""
    expect.all_hold(df, no_fill=~filled | ~reported | exempt)


def adjudicate(df: DataFrame, footprint: DataFrame, rulings: DataFrame, entity: str, unit: Sequence[str], values: Sequence[str], place: str) -> tuple[DataFrame, DataFrame]:
    """The rows after rulings, and the rulings with what became of them.

    ``rulings`` has (case_id, old, new, verdict): ``merge`` moves old's values onto new, ``keep`` leaves both; another verdict, an old key
    ruled on twice, or a new one that itself moves stops the job. A merge is applied only if both have the same places in
    ``footprint`` (entity, place), which leaves every place's mass where it was; else it is ``set aside``. The sums of the values by
    unit are the same before and after, or the job stops. Returned: (entity, unit, values, merged: how many others went in), and
    (case_id, old, new, verdict, status, the values moved)."""
    ruled = rel.once(rulings.select("case_id", "old", "new", "verdict"), "rulings")
    expect.all_hold(ruled, verdict=F.col("verdict").isin("merge", "keep"), apart=F.col("old") != F.col("new"))
    expect.unique(ruled, ["old"])
    merges = ruled.filter("verdict = 'merge'")
    expect.empty(merges.join(merges.select(F.col("old").alias("new")), "new", "left_semi"), "rulings whose new key moves itself")
    places = footprint.select(F.col(entity).alias("_e"), F.col(place).alias("_p")).distinct()
    old = merges.join(places.withColumnRenamed("_e", "old"), "old").select("case_id", "_p", F.lit(1).alias("o"))
    new = merges.join(places.withColumnRenamed("_e", "new"), "new").select("case_id", "_p", F.lit(1).alias("n"))
    both = old.join(new, ["case_id", "_p"], "full").groupBy("case_id").agg(F.count_if(F.col("o").isNull() | F.col("n").isNull()).alias("apart"))
    status = F.when(F.col("verdict") == "keep", "kept").when(F.col("apart") == 0, "applied").otherwise("set aside")
    decided = rel.once(ruled.join(both, "case_id", "left").select("case_id", "old", "new", "verdict", status.alias("status")), "decided")
    moves = decided.filter("status = 'applied'").select(F.col("old").alias(entity), F.col("new").alias("_to"))
    moved = df.join(moves, entity, "left")
    out = moved.groupBy(F.coalesce("_to", entity).alias(entity), *unit).agg(*[F.sum(v).alias(v) for v in values], F.countDistinct(F.when(F.col("_to").isNotNull(), F.col(entity))).alias("merged"))
    for v in values:
        expect.reconciles(df, out, unit, v, 1e-6)
    mass = df.groupBy(F.col(entity).alias("old")).agg(*[F.sum(v).alias(v) for v in values])
    gone = [F.when(F.col("status") == "applied", F.coalesce(v, F.lit(0))).otherwise(F.lit(0)).cast("double").alias(v) for v in values]
    return out, decided.join(mass, "old", "left").select("case_id", "old", "new", "verdict", "status", *gone)


def believable(df: DataFrame, registry: DataFrame, keys: Sequence[str], months: str, usable: str) -> DataFrame:
    """Directives over what was reported: ``reads_missing`` makes a year unusable with no months, ``partial_year`` says how many months (1 to 11)
    are believed, at most those reported, and such a year isn't usable whole. Adds ``directive``.

    An unknown directive, a partial year without its months, or a key twice in the registry stops the job."""
    expect.unique(registry, keys)
    expect.all_hold(registry, directive=F.col("directive").isin("reads_missing", "partial_year"), months=(F.col("directive") != "partial_year") | F.col("believable_months").between(1, 11))
    side = registry.select(*keys, "directive", F.col("believable_months").alias("_m"))
    out = df.join(side, list(keys), "left")
    partial, missing = F.col("directive") == "partial_year", F.col("directive") == "reads_missing"
    return out.withColumns({months: F.when(missing, F.lit(0)).when(partial, F.least(months, "_m")).otherwise(F.col(months)), usable: F.col(usable) & F.col("directive").isNull()}).drop("_m")
