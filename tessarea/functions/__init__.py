"""Null-safe scalar expressions."""

from tessarea.functions.exprs import (
    bounded_ratio, case_first, case_last, clip, finite, haversine_km, nan_to_null, normalise_name, ratio, round_half_even, try_num, zfill,
)

__all__ = ["bounded_ratio", "case_first", "case_last", "clip", "finite", "haversine_km", "nan_to_null", "normalise_name", "ratio", "round_half_even", "try_num", "zfill"]
