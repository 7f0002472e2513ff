"""Text, time and list expressions. NULL in gives NULL out; what doesn't parse is NULL, never an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessarea.functions.exprs import _c

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def fullmatch(x, pattern: str) -> Column:
    return _c(x).rlike(f"^(?:{pattern})$")


def extract(x, pattern: str, group: int = 1) -> Column:
    """The group of the first match, NULL without one."""
    return F.when(_c(x).rlike(pattern), F.regexp_extract(_c(x), pattern, group))


def split_once(x, separator: str) -> tuple[Column, Column]:
    """What stands before and behind the first separator (a pattern); the second is NULL without one."""
    parts = F.split(_c(x), separator, 2)
    return F.get(parts, 0), F.get(parts, 1)


def has_word(x, words: Sequence[str]) -> Column:
    """Whether any of the words stands as a word of its own, in either case."""
    return F.upper(_c(x)).rlike(r"\b(" + "|".join(w.upper() for w in words) + r")\b")


def or_if_blank(x, other) -> Column:
    """x, or ``other`` where x is NULL or empty."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), other if isinstance(other, Column) else F.lit(other))


def slug(x) -> Column:
    """Lower case, every run of other signs than letters and digits one underscore."""
    return F.trim(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "_"), F.lit("_"))


def remap(x, pairs: Mapping) -> Column:
    """Keys by a short fixed list, others as they are."""
    x = _c(x)
    table = F.create_map(*[F.lit(v) for pair in pairs.items() for v in pair])
    return F.coalesce(F.try_element_at(table, x), x) if pairs else x


def ranges(numbers) -> Column:
    """Whole numbers of an array as text: ascending, runs as low-high, joined by commas."""
    n = F.array_sort(F.array_distinct(_c(numbers)).cast("array<bigint>"))
    last = lambda acc: F.try_element_at(acc, F.lit(-1))
    one = lambda low, high: F.array(F.struct(low.alias("low"), high.alias("high")))
    runs = F.aggregate(
        n,
        F.array().cast("array<struct<low:bigint,high:bigint>>"),
        lambda acc, v: F.when(last(acc)["high"] == v - 1, F.concat(F.slice(acc, 1, F.size(acc) - 1), one(last(acc)["low"], v))).otherwise(F.concat(acc, one(v, v))),
    )
    text = lambda r: F.when(r["low"] == r["high"], r["low"].cast("string")).otherwise(F.concat_ws("-", r["low"].cast("string"), r["high"].cast("string")))
    return F.array_join(F.transform(runs, text), ",")


def first_timestamp(*tries: tuple) -> Column:
    """The first (text, format) that parses."""
    return F.coalesce(*[F.try_to_timestamp(_c(x), F.lit(fmt)) for x, fmt in tries])


def epoch(x, milliseconds: Column) -> Column:
    """A timestamp from a number of seconds, or of milliseconds where told so."""
    return F.when(milliseconds, F.timestamp_millis(_c(x).cast("long"))).otherwise(F.timestamp_seconds(_c(x).cast("long")))


def month_number(x) -> Column:
    """1 to 12 from an English month's name or its first three letters."""
    names = F.create_map(*[F.lit(v) for i, m in enumerate(MONTHS) for k in dict.fromkeys((m, m[:3])) for v in (k, i + 1)])
    return F.try_element_at(names, F.lower(F.trim(_c(x))))


def name_variants(x, rewrites: Sequence[tuple[str, str]]) -> Column:
    """Distinct (name, tier): the name itself at tier 0, then what each rewrite (pattern, replacement) makes of it."""
    x = _c(x)
    made = [x, *[F.trim(F.regexp_replace(x, a, b)) for a, b in rewrites]]
    names = F.array_distinct(F.array(*made))
    return F.transform(F.filter(names, lambda n: F.length(n) > 0), lambda n: F.struct(n.alias("name"), (F.array_position(F.array(*made), n) - 1).alias("tier")))


def likeness(a: str, b: str) -> float:
    """Jaro-Winkler: characters in common near each other, less those out of order, more for up to four equal first ones (from 0.7 on)."""
    if not a or not b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                first.append(c)
                break
    m = len(first)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(first, (c for c, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + 0.1 * same * (1 - jaro) if jaro > 0.7 else jaro


def jaro_winkler(a, b) -> Column:
    """Likeness of two texts from 0 to 1, in Arrow batches; equal pairs of a batch are compared once. NULL with NULL."""

    @F.pandas_udf("double")
    def like(x: pd.Series, y: pd.Series) -> pd.Series:
        known: dict = {}
        return pd.Series([None if p is None or q is None else known[p, q] if (p, q) in known else known.setdefault((p, q), likeness(p, q)) for p, q in zip(x, y, strict=True)], dtype="float64")

    return like(_c(a), _c(b))
