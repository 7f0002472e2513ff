"""Queries that apply the operators to the test tables."""

from tessarea.plans import allocation, controls, entities, fills, general, inputs, ledgers, models, publish, release, scalars, selection, spatial, surface
from tessarea.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "allocation", "controls", "entities", "fills", "general", "inputs", "ledgers", "models", "publish", "release", "scalars", "selection", "spatial", "surface"]
