"""Scalar kit. Every function keeps NULL as NULL and never raises on data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def ratio(n, d) -> Column:
    """n / d, NULL where d is 0 or NULL."""
    return F.try_divide(_c(n).cast("double"), _c(d).cast("double"))


def clip(x, low=None, high=None) -> Column:
    """Into [low, high]; NULL stays NULL, which greatest and least alone would skip."""
    x, out = _c(x), _c(x)
    if low is not None:
        out = F.greatest(out, _c(low))
    if high is not None:
        out = F.least(out, _c(high))
    return F.when(x.isNotNull(), out)


def bounded_ratio(n, d) -> Column:
    """n / d within [0, 1]; NULL where d is not positive."""
    return clip(F.when(_c(d) > 0, ratio(n, d)), 0.0, 1.0)


def finite(x) -> Column:
    """NULL for NaN and infinities."""
    x = _c(x)
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def nan_to_null(x) -> Column:
    x = _c(x)
    return F.when(~F.isnan(x), x)


def try_num(x) -> Column:
    return _c(x).try_cast("double")


def zfill(x, n: int) -> Column:
    """Zeros to the left up to n characters; unlike lpad it never cuts."""
    x = _c(x).cast("string")
    return F.when(F.length(x) < n, F.lpad(x, n, "0")).otherwise(x)


def round_half_even(x, n: int = 0) -> Column:
    return F.bround(_c(x), n)


def case_first(rungs, default=None) -> Column:
    """The value of the first condition that holds."""
    out = reduce(lambda acc, r: acc.when(r[0], _c_value(r[1])), rungs[1:], F.when(rungs[0][0], _c_value(rungs[0][1])))
    return out.otherwise(_c_value(default))


def case_last(rungs, default=None) -> Column:
    """A ladder in which a later condition overwrites an earlier one."""
    return case_first(list(reversed(rungs)), default)


def _c_value(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    p, q = F.radians(_c(lat1)), F.radians(_c(lat2))
    a = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin((F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2), 2)
    return F.lit(2 * 6371.0088) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def normalise_name(x) -> Column:
    """Upper case, single spaces, letters and digits only."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(_c(x)), "[^A-Z0-9 ]", " "), " +", " "))
