"""Keeping one copy of messages that are delivered at least once.

Identifiers are dictionary-encoded exactly (no fingerprints, so no false duplicate) into dense ids per shard. What was
accepted so far is a set of bitmaps, one per shard and bucket of 32768 ids, kept as an append-only log of versions that
are OR-ed on reading, until compact() makes one of them. A batch looks its identifiers up in the dictionary and the ids in the bitmaps, selects one arrival per unseen bit and publishes its new bits
and dictionary entries: a marker that names them is renamed to the next version's name, which fails if another run took it. So a run that dies leaves no trace, of two runs
that race one is refused and publishes nothing, and a batch that is run again finds its own bits and accepts nothing.

Cases: rows whose identifier is null or blank (spaces and angle brackets around it do not count) or whose second key is
null are never copies; a null or unreadable time counts as last; ties go to the smallest sequence number; repeated rows
with one sequence number are one row; an empty batch gives empty results.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sieveline.functions.time import instant
from sieveline.runtime import discard, shared_dir, stored
from sieveline.sources.files import read_document, write_file

ENTRY = "key string, shard int, id bigint, seq bigint, is_new boolean, unseen boolean"
BITMAP = "shard int, bucket bigint, bits binary"
#: Parts of a shard that new ids are ranked in.
PIECES = 16


def message_key(message_id: Column, part: Column) -> Column:
    """Exact key of a message and its part; null where either is missing."""
    bare = F.regexp_replace(message_id, r"^[\s<>]+|[\s<>]+$", "")
    return F.when(F.length(bare) > 0, F.concat(bare, F.lit("\x1f"), part))


def bit_is_set(bits: Column, position: Column) -> Column:
    """Reads one bit of what bitmap_construct_agg writes."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, (position % 8).cast("int")) == 1


class SeenStore:
    """Dictionary and seen-bitmaps of one stream in a shared folder: data/<run>/{entries,bitmaps}, and a marker versions/<n> for each published run that names its data."""

    def __init__(self, spark: SparkSession, path: str | None = None, shards: int = 16):
        self.spark, self.shards = spark, shards
        self.path = path or f"{shared_dir(spark)}/seen-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[str]:
        root = self._path(f"{self.path}/versions")
        return sorted(n for s in self._fs.listStatus(root) if "." not in (n := s.getPath().getName())) if self._fs.exists(root) else []

    def live(self) -> list[str]:
        """Folders of the published runs since the last compaction."""
        out: list[str] = []
        for v in self.versions():
            said = read_document(self.spark, f"{self.path}/versions/{v}", {})
            out = [said["data"]] if said["whole"] else [*out, said["data"]]
        return out

    def _read(self, kind: str, schema: str, live: list[str]) -> DataFrame:
        paths = [f"{d}/{kind}" for d in live]
        return reduce(DataFrame.unionByName, (self.spark.read.schema(schema).parquet(p) for p in paths)) if paths else self.spark.createDataFrame([], schema)

    def dictionary(self, live: list[str] | None = None) -> DataFrame:
        return self._read("entries", ENTRY, self.live() if live is None else live).where("is_new").select("key", "shard", "id")

    def bitmaps(self, live: list[str] | None = None) -> DataFrame:
        return self._read("bitmaps", BITMAP, self.live() if live is None else live).groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def publish(self, data: str, after: int, whole: bool = False) -> None:
        """Makes the data the version after so many; refused if another run was faster."""
        write_file(self.spark, f"{self.path}/versions/{after:08d}", json.dumps({"data": data, "whole": whole}).encode(), overwrite=False)

    def compact(self) -> None:
        """One dictionary and one set of bitmaps instead of those of all versions."""
        after, live = len(self.versions()), self.live()
        data = f"{self.path}/data/{uuid.uuid4().hex}"
        kept = self.dictionary(live).select("key", "shard", "id", F.lit(None).cast("bigint").alias("seq"), F.lit(True).alias("is_new"), F.lit(False).alias("unseen"))
        kept.repartition("shard").write.partitionBy("shard").parquet(f"{data}/entries")
        self.bitmaps(live).repartition("shard").write.partitionBy("shard").parquet(f"{data}/bitmaps")
        self.publish(data, after, whole=True)


@dataclass
class Delivered:
    kept: DataFrame
    superfluous: DataFrame


def deliver_once(batch: DataFrame, store: SeenStore, *, message_id: Column, part: Column, received_at: Column, seq: str) -> Delivered:
    """Splits a batch into the sequence numbers that stay and those that are superfluous, and publishes what was accepted.

    Rows without identifier are in kept. Hot identifiers are combined before the shuffle; the split itself joins by the unique sequence number.
    """
    rows = batch.select(message_key(message_id, part).alias("key"), instant(received_at).alias("at"), F.col(seq).cast("bigint").alias("seq"))
    first = rows.where("key is not null").groupBy("key").agg(F.min(F.struct(F.col("at").isNull().alias("late"), "at", "seq")).alias("first"))
    first = first.select("key", F.pmod(F.xxhash64("key"), F.lit(store.shards)).cast("int").alias("shard"), F.col("first.seq").alias("seq"))
    after, live = len(store.versions()), store.live()
    known = store.dictionary(live)
    used = known.groupBy("shard").agg(F.max("id").alias("used"))
    # Bitmaps of the ids known before, looked up by shard and bucket.
    seen = first.join(known.select("key", "id"), "key", "left").join(F.broadcast(used), "shard", "left")  # a row per shard
    # New ids are dense: ranks within small hashed parts of a shard, each after those of the parts before it.
    seen = seen.withColumns({"is_new": F.col("id").isNull(), "piece": F.pmod(F.xxhash64("key", F.lit(1)), F.lit(PIECES)).cast("int")})
    staged = f"{store.path}/data/{uuid.uuid4().hex}"
    seen = stored(seen.withColumn("rank", F.row_number().over(W.partitionBy("shard", "piece", "is_new").orderBy("key"))), "ranked")
    sizes = seen.where("is_new").groupBy("shard", "piece").agg(F.max("rank").alias("n"))
    start = sizes.select("shard", "piece", F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    coded = seen.join(F.broadcast(start), ["shard", "piece"], "left")  # a row per shard and piece
    coded = coded.select("key", "shard", "seq", "is_new", F.coalesce("id", F.coalesce("used", F.lit(-1)) + F.col("start") + F.col("rank")).cast("bigint").alias("id"))
    coded = coded.withColumns({"bucket": F.floor(F.col("id") / 32768), "position": F.col("id") % 32768})
    coded = coded.join(store.bitmaps(live), ["shard", "bucket"], "left").withColumn("unseen", ~F.coalesce(bit_is_set(F.col("bits"), F.col("position")), F.lit(False)))
    coded.select("key", "shard", "id", "seq", "is_new", "unseen").repartition("shard").write.partitionBy("shard").parquet(f"{staged}/entries")
    discard(seen)
    entries = batch.sparkSession.read.schema(ENTRY).parquet(f"{staged}/entries")
    bits = entries.where("unseen").groupBy("shard", F.floor(F.col("id") / 32768).alias("bucket")).agg(F.bitmap_construct_agg(F.col("id") % 32768).alias("bits"))
    bits.select("shard", "bucket", "bits").repartition("shard").write.partitionBy("shard").parquet(f"{staged}/bitmaps")
    store.publish(staged, after)
    accepted = batch.sparkSession.read.schema(ENTRY).parquet(f"{staged}/entries").where("unseen").select("seq")
    keyed = rows.where("key is not null").select("seq")
    return Delivered(rows.where("key is null").select("seq").unionAll(accepted).distinct(), keyed.join(accepted, "seq", "left_anti").distinct())


def deliver_in_order(rows: DataFrame, store: SeenStore, *, message_id: Column, part: Column, received_at: Column, seq: str, slices: int = 4) -> DataFrame:
    """Superfluous rows (column seq) of a stream that is replayed in order of arrival: slices of equal shares of the times, those without a time last, each a batch that reads what the ones
    before it published. So of all copies the earliest stays, whatever batch brought it."""
    at = F.unix_micros(instant(received_at))
    cuts = sorted(set(rows.select(F.percentile_approx(at, [i / slices for i in range(1, slices)], 1000).alias("c")).first()[0] or []))
    out = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True) if low is None else (at >= low)
        inside = F.coalesce(inside, F.lit(False)) & F.coalesce(at < high, F.lit(False)) if high is not None else inside | at.isNull()
        done = deliver_once(rows.where(inside), store, message_id=message_id, part=part, received_at=received_at, seq=seq).superfluous
        out = done if out is None else out.unionAll(done)
    return out
