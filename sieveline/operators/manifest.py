"""Counts over fixed value sets, dispositions and digests of what a stage wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero_filled(rows: DataFrame, grid: dict[str, Sequence], name: str = "n") -> DataFrame:
    """Counts of every combination of the given values, 0 where there is none."""
    spark, out = rows.sparkSession, None
    for column, values in grid.items():  # the grid is the product of given value sets, not of data
        one = spark.createDataFrame([(v,) for v in values], f"{column} {rows.schema[column].dataType.simpleString()}")
        out = one if out is None else out.crossJoin(one)
    counted = rows.groupBy(*grid).agg(F.count("*").alias(name))
    return out.join(counted, list(grid), "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))


def digest(rows: DataFrame, group: str, line: Column, order: str, block: int = 4096, levels: int = 2) -> DataFrame:
    """Tree digest of each group's lines in order of an integer column, and their number.

    Digests of block neighbouring numbers are joined by line feeds and hashed, level by level, so that no task holds more than block of them
    but the last, which has one for each block to the power of levels.
    """
    parts = rows.select(group, F.floor(F.col(order) / block).cast("bigint").alias("_block"), F.col(order).cast("bigint").alias("_at"), F.sha2(line, 256).alias("_d"), F.lit(1).cast("bigint").alias("_n"))
    joined = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_d"))), lambda s: s["_d"]), "\n"), 256)
    for _ in range(levels):
        parts = parts.groupBy(group, "_block").agg(joined.alias("_d"), F.sum("_n").alias("_n")).select(group, F.floor(F.col("_block") / block).cast("bigint").alias("_next"), F.col("_block").alias("_at"), "_d", "_n").withColumnRenamed("_next", "_block")
    return parts.groupBy(group).agg(joined.alias("digest"), F.sum("_n").alias("n_lines"))


def dispositions(rows: DataFrame, group: str, disposition: Column, names: Sequence[str]) -> DataFrame:
    """Number of rows of each disposition by group, in one pass."""
    return rows.select(group, disposition.alias("_d")).groupBy(group).agg(F.count("*").alias("raw"), *(F.count_if(F.col("_d") == n).alias(n) for n in names))


def key_violations(rows: DataFrame, key: str) -> DataFrame:
    """Keys that are null or occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side."""
    x = a.select(key).distinct().withColumn("a", F.lit(1)).join(b.select(key).distinct().withColumn("b", F.lit(1)), key, "full_outer")
    return x.where("a is null or b is null").select(key, F.when(F.col("a").isNull(), "right").otherwise("left").alias("only_in"))
