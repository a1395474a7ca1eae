"""Scans and sinks at the edge: JSON lines, JSON documents, canonical JSON, digests, partitioned and atomic writes."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, tolerant: bool = False) -> DataFrame:
    """JSON lines under a given schema. A missing path is empty; blank lines are skipped; a broken line fails the read, or is left out if tolerant."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value") != "")
    if tolerant:
        kept = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
        parsed = lines.select(F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r")).select("r.*")
        return parsed.where("_broken is null").drop("_broken")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_document(spark: SparkSession, path: str, default: Any) -> Any:
    """One JSON document; the default where it is missing or not an object."""
    if not exists(spark, path):
        return default
    try:
        found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    except ValueError:
        return default
    return found if isinstance(found, dict) else default


def write_file(spark: SparkSession, path: str, data: bytes, overwrite: bool = True) -> None:
    """Writes a file beside its place and renames it there in one step: readers see nothing, the old or the new one. Fails where there is one already unless overwrite."""
    fs, p = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(p)
    out.write(bytearray(data))
    out.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if overwrite else kind.NONE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, _fs(spark, path)[1], how)
    except Exception as e:
        fs.delete(p, False)
        raise FileExistsError(f"{path} exists or cannot be replaced") from e


def write_document(spark: SparkSession, path: str, document: Any) -> None:
    """Replaces one JSON document; readers see the old or the new one."""
    write_file(spark, path, json.dumps(document, sort_keys=True, ensure_ascii=False).encode())


def sorted_struct(c: Column, kind: T.DataType) -> Column:
    """The value with the fields of all structs in order of their names."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*(sorted_struct(c[f.name], f.dataType).alias(f.name) for f in fields)))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda x: sorted_struct(x, kind.elementType))
    return c


def canonical_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One line of JSON with sorted keys and explicit nulls."""
    chosen = sorted(columns or df.columns)
    return F.to_json(F.struct(*(sorted_struct(F.col(f"`{n}`"), df.schema[n].dataType).alias(n) for n in chosen)), {"ignoreNullFields": "false"})


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_by_key(df: DataFrame, path: str, key: str, every: list[str]) -> DataFrame:
    """A folder for each key, and the number of rows of every key, with those that got none."""
    df.write.mode("overwrite").partitionBy(key).parquet(path)
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    return df.sparkSession.createDataFrame([(k,) for k in every], f"{key} string").join(counted, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file's bytes."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("digest"), "length")


def step_output(values: dict[str, Any]) -> str:
    """key=value lines: booleans in lower case, lists joined by commas."""
    show = lambda v: str(v).lower() if isinstance(v, bool) else ",".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    return "".join(f"{k}={show(v)}\n" for k, v in values.items())
