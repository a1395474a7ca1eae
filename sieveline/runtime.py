"""Session helpers: the shared folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, from spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        path = spark.sparkContext.getCheckpointDir()
    if path is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame, name: str = "cut", keep: bool = True) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends there, so a lost executor costs no recomputation of earlier rounds.

    Unlike checkpoint() it keeps columns prunable and carries no constraints on, which grow with each round of a loop.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path  # for discard()
    return out


def discard(df: DataFrame) -> None:
    """Deletes what stored() wrote; for rounds that a later one replaced."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
