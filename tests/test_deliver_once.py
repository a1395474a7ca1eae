import pytest
from pyspark.sql import functions as F

from sieveline.operators.deliver_once import SeenStore, bit_is_set, deliver_in_order, deliver_once

SCHEMA = "delivery_seq bigint, message_id string, candidate_id string, received_at string, key string"
ROWS = [
    (1, "m1", "a", "2026-01-02T00:00:00Z", "x"), (2, "<m1>", "a", "2026-01-01T23:00:00-05:00", "x"), (3, " m1 ", "a", "2026-01-01T12:00:00Z", "x"), (4, "m1", "b", None, "x"), (5, "m1", "b", "bad", "x"),
    (6, None, "a", "2026-01-01T00:00:00Z", "x"), (7, None, "a", "2026-01-01T00:00:00Z", "x"), (8, " <> ", "a", None, "x"), (9, "m2", None, None, "x"), (10, "m2", None, None, "x"), (11, "m3", "c", "2026-01-01T00:00:00", "x"), (11, "m3", "c", "2026-01-01T00:00:00", "x"),
]


def run(spark, rows, store):
    d = deliver_once(spark.createDataFrame(rows, SCHEMA), store, message_id=F.col("message_id"), part=F.col("candidate_id"), received_at=F.col("received_at"), seq="delivery_seq")
    return sorted(r.seq for r in d.kept.collect()), sorted(r.seq for r in d.superfluous.collect())


def test_one_batch_then_history(spark):
    store = SeenStore(spark, shards=4)
    assert run(spark, ROWS, store) == ([3, 4, 6, 7, 8, 9, 10, 11], [1, 2, 5])
    # A later batch finds its old identifiers seen, and accepts only new ones; ids go on densely.
    assert run(spark, [(20, "m1", "a", "2025-01-01T00:00:00Z", "x"), (21, "m9", "z", None, "x"), (22, "m9", "z", None, "x")], store) == ([21], [20, 22])
    assert len(store.versions()) == 2
    ids = store.dictionary().collect()
    assert len(ids) == len({(r.shard, r.id) for r in ids}) == 4
    assert run(spark, [], store) == ([], [])


def test_bits(spark):
    df = spark.range(40).where("id % 7 = 0").agg(F.bitmap_construct_agg(F.col("id")).alias("bits")).crossJoin(spark.range(40))
    assert {r.id for r in df.where(bit_is_set(F.col("bits"), F.col("id"))).collect()} == {0, 7, 14, 21, 28, 35}


def test_replay_in_order_keeps_the_earliest(spark):
    df = spark.createDataFrame([*ROWS, *((100 + i, f"k{i % 20}", "a", f"2026-02-{1 + i % 27:02d}T00:00:00Z", "x") for i in range(60))], SCHEMA)
    out = deliver_in_order(df, SeenStore(spark, shards=4), message_id=F.col("message_id"), part=F.col("candidate_id"), received_at=F.col("received_at"), seq="delivery_seq")
    got = {r.seq for r in out.collect()}
    first = {}
    for i in range(60):
        first.setdefault(i % 20, []).append((i % 27, i))
    assert got == {1, 2, 5} | {100 + i for copies in first.values() for _, i in sorted(copies)[1:]}


def test_of_two_racing_publishers_one_is_refused(spark):
    store = SeenStore(spark, shards=2)
    run(spark, ROWS, store)
    other = SeenStore(spark, store.path, shards=2)
    after = len(other.versions())
    run(spark, [(30, "m7", "a", None, "x")], store)
    with pytest.raises(FileExistsError):
        other.publish(f"{store.path}/data/late", after)
    assert len(store.versions()) == 2


def test_compaction_changes_no_answer(spark):
    store = SeenStore(spark, shards=2)
    run(spark, ROWS, store)
    run(spark, [(30, "m7", "a", None, "x")], store)
    before = sorted(map(tuple, store.dictionary().collect()))
    store.compact()
    assert len(store.live()) == 1 and sorted(map(tuple, store.dictionary().collect())) == before
    assert run(spark, [(31, "m7", "a", None, "x"), (32, "m1", "a", None, "x"), (33, "m8", "a", None, "x")], store) == ([33], [31, 32])
