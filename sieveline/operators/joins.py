"""Joins that hold under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_lookup(rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, how: str = "inner", parts: int = 16) -> DataFrame:
    """rows with the columns of lookup, which has one row for each key. A key may be that of a third of all rows: its rows go to so many tasks, and each row of lookup to all of them.

    Sizes are estimated without the copies, so that they would be broadcast where they are parts times too large for it: the hint keeps the join a merge join."""
    salted = rows.withColumn("_part", F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int"))
    copies = lookup.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return salted.join(copies.hint("merge"), [key, "_part"], how).drop("_part")
