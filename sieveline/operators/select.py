"""Budgeted top-k selection: a total order, cascaded limits, carry-forward, work budgets and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def cascade(rows: DataFrame, order: Sequence[Column], limits: Sequence[tuple[str, int]]) -> DataFrame:
    """The first rows by order with rank and the name of the smallest limit that holds them. limits: names and sizes, smallest first.

    The global order is only ever applied to the largest limit's rows: each task keeps its own best (TakeOrdered), and the window ranks what is left.
    """
    best = rows.orderBy(*order).limit(limits[-1][1])
    status = None
    for name, n in limits:
        status = F.when(F.col("rank") <= n, name) if status is None else status.when(F.col("rank") <= n, name)
    return best.withColumn("rank", F.row_number().over(W.orderBy(*order))).withColumn("status", status)


def carried_forward(rows: DataFrame, chosen: DataFrame, key: str, mandatory: Column) -> DataFrame:
    """Mandatory rows that were not chosen."""
    return rows.where(mandatory).join(chosen.select(key), key, "left_anti")


def round_robin(rows: DataFrame, group: str, order: Sequence[Column], most: int) -> DataFrame:
    """Up to most rows, one of each group in turn. Only each group's first rows are ranked across groups."""
    ranked = rows.withColumn("turn", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("turn") <= most)
    return ranked.orderBy("turn", group).limit(most)


def first_of(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """First row of each key by a unique order column; rows without key are all kept. Minima are combined before the shuffle, and rows are picked by the unique column."""
    keyed = rows.withColumn("_key", key)
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(order).alias(order)).select(order)
    return keyed.where("_key is not null").join(first, order, "left_semi").unionByName(keyed.where("_key is null")).drop("_key")
