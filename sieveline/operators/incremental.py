"""Incremental mechanisms: overlap windows with a seen-set, TTL caches, overlays, guarded upserts, due work, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlap_run(source: DataFrame, seen: DataFrame, key: str, at: str, start: Column, end: Column) -> DataFrame:
    """Rows of the poll window [start, end) that were not seen."""
    return source.where((F.col(at) >= start) & (F.col(at) < end)).join(seen.select(key), key, "left_anti")


def latest_unexpired(cache: DataFrame, key: str, at: str, expires: Column, now: Column) -> DataFrame:
    """Newest entry of each key that is still valid."""
    valid = cache.where((expires > now) & (F.col(at) <= now))
    return valid.groupBy(key).agg(F.max_by(F.struct(*cache.columns), F.col(at)).alias("e")).select("e.*")


def looked_up(requests: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Requests with hit and the cached columns."""
    return requests.join(cache.withColumn("hit", F.lit(True)), key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def overlaid(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both; new replaces old, row by row."""
    o = old.select(F.struct(*old.columns).alias("o"), F.col(key))
    n = new.select(F.struct(*old.columns).alias("n"), F.col(key))
    return o.join(n, key, "full_outer").select(F.coalesce("n", "o").alias("r")).select("r.*")


def guarded_upsert(existing: DataFrame, incoming: DataFrame, key: str, digest: str) -> DataFrame:
    """Incoming rows with disposition: inserted, unchanged or conflict (the same key with another digest)."""
    e = existing.select(key, F.col(digest).alias("_had"))
    return incoming.join(e, key, "left").withColumn("disposition", F.when(F.col("_had").isNull(), "inserted").when(F.col("_had") == F.col(digest), "unchanged").otherwise("conflict")).drop("_had")


def due_split(rows: DataFrame, done: DataFrame, key: str, digest: str, order: str, budget: int) -> DataFrame:
    """Rows with work: reused (same digest), processed (the first so many of the rest, in order) or deferred."""
    e = done.select(key, F.col(digest).alias("_had"))
    marked = rows.join(e, key, "left").withColumn("_due", ~F.coalesce(F.col("_had") == F.col(digest), F.lit(False))).drop("_had")
    # The budget is a number of rows, so their keys are few: found by TakeOrdered, not by a global sort.
    picked = marked.where("_due").orderBy(order, key).limit(budget).select(key, F.lit(True).alias("_now"))
    return marked.join(picked, key, "left").withColumn("work", F.when(~F.col("_due"), "reused").when(F.col("_now"), "processed").otherwise("deferred")).drop("_due", "_now")


def retained(rows: DataFrame, at: str, now: Column, days: int) -> DataFrame:
    return rows.where(F.col(at) >= now - F.expr(f"INTERVAL {days} DAYS"))
