"""Explainable scores: an ordered breakdown of contributions, folded in its order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def breakdown(contributions: Mapping[str, Column]) -> Column:
    """array<struct<feature, contribution>> in order, rounded to 6 digits, without what contributes nothing."""
    every = F.array(*(F.struct(F.lit(k).alias("feature"), F.round(F.coalesce(v.cast("double"), F.lit(0.0)), 6).alias("contribution")) for k, v in contributions.items()))
    return F.filter(every, lambda e: e["contribution"] != 0.0)


def folded(parts: Column) -> Column:
    """Sum in order, within 0 and 1, to 6 digits."""
    total = F.aggregate(parts, F.lit(0.0), lambda acc, e: acc + e["contribution"])
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 6)


def capped(weights: Column, cap: float) -> Column:
    return F.least(F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w) * cap, F.lit(cap))


def decision(score: Column, ladder: list[tuple[float, str]], default: str) -> Column:
    """Name of the first threshold that the score reaches; thresholds are inclusive, highest first."""
    out = None
    for least, name in ladder:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise(default)


def overridden(score: Column, mandatory: Column, least: float) -> Column:
    return F.when(mandatory, F.greatest(score, F.lit(least))).otherwise(score)
