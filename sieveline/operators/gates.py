"""Gates of incremental runs: due times, poll windows, checkpoints, replacement by source, caps of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def due(last: Column, now: Column, hours: int) -> Column:
    """Whether so many hours have passed since the last success, or there was none."""
    return F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(last) >= hours * 3600, F.lit(True))


def poll_window(last: Column, now: Column, overlap_days: int, lookback_days: int) -> tuple[Column, Column]:
    """(since, until): from the last success less an overlap, or else a first lookback."""
    return F.coalesce(last.cast("timestamp") - F.expr(f"INTERVAL {overlap_days} DAYS"), now - F.expr(f"INTERVAL {lookback_days} DAYS")), now


def checkpoints(rows: DataFrame, batch: str, failed: Column) -> DataFrame:
    """Rows and failures of each batch, and the last batch without failures so far. A row per batch is ordered, not the rows."""
    each = rows.groupBy(batch).agg(F.count("*").alias("rows_read"), F.count_if(failed).alias("failures"))
    so_far = W.orderBy(batch).rowsBetween(W.unboundedPreceding, 0)
    return each.select(batch, "rows_read", "failures", (F.col("failures") == 0).alias("advances"), F.max(F.when(F.col("failures") == 0, F.col(batch))).over(so_far).alias("checkpoint"))


def replaced_by_source(old: DataFrame, new: DataFrame, source: str) -> DataFrame:
    """old without the rows of any source that new has, and new."""
    return old.join(new.select(source).distinct(), source, "left_anti").select(old.columns).unionByName(new)


def capped_run(rows: DataFrame, group: str, order: str, of_group: int, in_all: int) -> DataFrame:
    """The first rows of each group, and of those the first in all; an order with a limit, so each task hands on at most in_all rows."""
    n = F.row_number().over(W.partitionBy(group).orderBy(order))
    return rows.withColumn("_n", n).where(F.col("_n") <= of_group).drop("_n").orderBy(order).limit(in_all)
