"""Rates, exposures and guards as expressions of columns; thresholds are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessarea.functions.exprs import _c, case_first, clip, ratio


def density(n, area) -> Column:
    """n per area, NULL where the area is not positive."""
    return F.when(_c(area) > 0, ratio(n, area))


def band(x, cuts: Sequence[tuple[float, str]], lowest: str) -> Column:
    """The label of the highest cut that x reaches, ``lowest`` for the rest and for NULL."""
    return case_first([(F.coalesce(_c(x) >= cut, F.lit(False)), label) for cut, label in sorted(cuts, reverse=True)], lowest)


def growth(first, last, years) -> Column:
    """Yearly factor between two positive values."""
    return F.when((_c(first) > 0) & (_c(last) > 0), F.pow(ratio(last, first), 1.0 / _c(years)))


def daytime(residents, jobs_here, jobs_of_residents) -> Column:
    """Residents plus net commuters, never below the residents."""
    return F.greatest(_c(residents) + _c(jobs_here) - _c(jobs_of_residents), _c(residents))


def vehicles(total, households: Sequence) -> Column:
    """A stated total, or else the sum of k times the households with k vehicles."""
    return F.coalesce(_c(total), sum((F.lit(float(k)) * _c(h) for k, h in enumerate(households)), F.lit(0.0)))


def capped_exposure(exposure, base, jobs, least_jobs: float = 5000.0, times: float = 3.0) -> Column:
    """Where many jobs are registered at one place, at most ``times`` the base."""
    return F.when(_c(jobs) >= least_jobs, F.least(_c(exposure), times * _c(base))).otherwise(_c(exposure))


def gap(target, reported) -> Column:
    """What is missing to the target, never negative."""
    return clip(_c(target) - _c(reported), 0.0)


def from_log_rate(predicted, exposure, per: float = 1e5, most: float = 12.0) -> Column:
    """Counts from a predicted log1p rate, clipped before it is raised."""
    return F.expm1(clip(predicted, 0.0, most)) / per * _c(exposure)


def temper(offense, covered, never: Sequence[str], half: Sequence[str]) -> Column:
    """How far a model tilts a share: wholly where the truth is covered or nothing else is said, not at all or by half for some."""
    return case_first([(F.coalesce(_c(covered), F.lit(False)), 1.0), (_c(offense).isin(*never), 0.0), (_c(offense).isin(*half), 0.5)], 1.0)


def transient(exposure, residents, index, least_ratio: float = 5.0, least_index: float = 1000.0) -> Column:
    """Many more people than residents together with an extreme resident index."""
    return F.coalesce((ratio(exposure, residents) >= least_ratio) & (_c(index) >= least_index), F.lit(False))


def ambient_blind(share, lift, low_rate, national, most_share: float = 0.5, times: float = 3.0) -> Column:
    """A large share without any lift by the model, and a rate whose lower bound lies far above the national one."""
    return F.coalesce((_c(share) > most_share) & ~_c(lift) & (_c(low_rate) >= times * _c(national)), F.lit(False))
