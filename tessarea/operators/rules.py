"""Classification rules as data, compiled to one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessarea.functions import case_first


def condition(c: dict) -> Column:
    """eq, in, ge, le, contains or regex on a field; a NULL field matches nothing."""
    x = F.col(c["field"])
    kinds = {"eq": lambda v: x == v, "in": lambda v: x.isin(*v), "ge": lambda v: x >= v, "le": lambda v: x <= v, "contains": lambda v: x.contains(v), "regex": lambda v: x.rlike(v)}
    (kind,) = [k for k in c if k != "field"]
    if kind not in kinds:
        raise ValueError(f"unknown condition {kind}")
    return F.coalesce(kinds[kind](c[kind]), F.lit(False))


def first_match(rules: list[dict], default: str | None = None) -> Column:
    """The label of the first rule all of whose ``all`` hold and none of whose ``none``."""
    rungs = []
    for rule in rules:
        holds = F.lit(True)
        for c in rule.get("all", []):
            holds = holds & condition(c)
        for c in rule.get("none", []):
            holds = holds & ~condition(c)
        rungs.append((holds, rule["label"]))
    return case_first(rungs, default)
