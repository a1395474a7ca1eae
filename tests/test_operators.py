import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.operators import discover, incremental, manifest, resolve, rules, score, select, textops
from sieveline.operators.joins import salted_lookup
from sieveline.sources import files, mail
from sieveline.sources.paged import PagedSource


def test_rules(spark):
    df = spark.createDataFrame([(1, "Optical tests", "no"), (2, "x", "an OPTICAL y"), (3, None, None)], "id int, title string, body string")
    e = df.select("id", rules.first_matches({"title": F.col("title"), "body": F.col("body")}, ["optical", "y$"]).alias("e")).collect()
    assert [[(x.field, x.matched_text) for x in r.e] for r in e] == [[("title", "Optical")], [("body", "OPTICAL"), ("body", "y")], []]
    tiers = [("one", ["annals of light"]), ("two", ["annals of lightning"])]
    got = [spark.range(1).select(rules.tier_of(F.lit(n), tiers, F.lit(raw)).alias("t")).first().t for n, raw in (("annals of light", "x"), ("annals of light", "Annals of Light…"), ("annals of lightn", "Annals of Lightn…"), ("annals", "Annals…"))]
    assert got == ["one", "one", "two", "unresolved"]


def test_score_and_decision(spark):
    parts = score.breakdown({"a": F.lit(0.5), "b": F.lit(None).cast("double"), "c": F.lit(0.0), "d": F.lit(0.7)})
    r = spark.range(1).select(F.size(parts).alias("n"), score.folded(parts).alias("s"), score.decision(F.lit(0.72), [(0.85, "urgent"), (0.72, "summarize")], "retain").alias("d"), score.overridden(F.lit(0.3), F.lit(True), 0.85).alias("o"), score.capped(F.array(F.lit(0.5), F.lit(0.9)), 0.2).alias("c")).first()
    assert (r.n, r.s, r.d, r.o, r.c) == (2, 1.0, "summarize", 0.85, 0.2)


def test_selection(spark):
    df = spark.createDataFrame([(i, i % 3, i * 7 % 11) for i in range(30)], "id int, g int, v int")
    top = select.cascade(df, [F.desc("v"), F.col("id")], [("slot", 2), ("queue", 4)]).collect()
    assert [(r["rank"], r.status) for r in sorted(top, key=lambda r: r["rank"])] == [(1, "slot"), (2, "slot"), (3, "queue"), (4, "queue")]
    assert select.carried_forward(df, df.where("id < 29"), "id", F.lit(True)).count() == 1
    assert [(r.turn, r.g) for r in select.round_robin(df, "g", [F.col("id")], 4).collect()] == [(1, 0), (1, 1), (1, 2), (2, 0)]
    assert select.first_of(spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id int, k string"), F.col("k"), "id").count() == 3


def test_entities_and_survivors(spark):
    keyed = spark.createDataFrame([(i, f"k{i // 2}") for i in range(20)] + [(i, f"c{(i + 1) // 2}") for i in range(20)] + [(50, "z"), (51, "z"), (60, "alone")], "seq bigint, key string")
    got = {r.seq: r.entity for r in resolve.entities(keyed).collect()}
    assert got == {**{i: 0 for i in range(20)}, 50: 50, 51: 50, 60: 60}
    rows = spark.createDataFrame([(1, 1, "ab"), (1, 2, "abc"), (1, 3, "xyz"), (2, 4, None)], "entity int, seq int, title string")
    assert {r.entity: (r.title, r.members) for r in resolve.survived(rows, "entity", "seq", {"title": F.length("title")}).collect()} == {1: ("abc", 3), 2: (None, 1)}
    modes = resolve.mode_first_seen(spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, None, 0)], "g int, v string, s int"), "g", "v", "s").collect()
    assert [(r.g, r.v) for r in modes] == [(1, "b")]


def test_incremental(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, incremental.overlaid(old, new, "k").collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert {r.k: r.disposition for r in incremental.guarded_upsert(old, new, "k", "v").collect()} == {2: "conflict", 3: "inserted"}
    work = incremental.due_split(spark.createDataFrame([(i, "d") for i in range(5)], "k int, v string"), spark.createDataFrame([(0, "d"), (1, "x")], "k int, v string"), "k", "v", "k", 2)
    assert {r.k: r.work for r in work.collect()} == {0: "reused", 1: "processed", 2: "processed", 3: "deferred", 4: "deferred"}


def test_manifest(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    assert {r.k: r.c for r in manifest.zero_filled(df, {"k": ["a", "b"]}, "c").collect()} == {"a": 2, "b": 0}
    assert {r.k for r in manifest.key_violations(df, "k").collect()} == {"a", None}
    assert manifest.set_difference(df, df, "n").count() == 0


def test_texts(spark):
    spans = spark.createDataFrame([(1, 0, 5), (1, 5, 7), (1, 9, 10), (1, 1, 2), (2, 0, 1)], "g int, s int, e int")
    assert sorted((r.g, r.s, r.e, r.n) for r in textops.islands(spans, "g", "s", "e").collect()) == [(1, 0, 7, 3), (1, 9, 10, 1), (2, 0, 1, 1)]
    assert sorted((r.g, r.s, r.e, r.n) for r in textops.islands(spans, "g", "s", "e", width=2).collect()) == [(1, 0, 7, 3), (1, 9, 10, 1), (2, 0, 1, 1)]
    texts = spark.createDataFrame([(1, 1, "aaaa"), (1, 2, "bbbb"), (1, 3, "cc")], "g int, o int, t string")
    assert [(r.o, r.t) for r in textops.within_budget(texts, "g", "o", "t", 9).orderBy("o").collect()] == [(1, "aaaa"), (2, "bbb")]
    c = spark.createDataFrame([(1, "a", "abcd", "abcd"), (1, "b", "abcd", "abxx"), (2, "a", "abcd", "abcd"), (2, "b", "abcd", "abcd"), (3, "a", "q", "")], "k int, candidate string, x string, y string")
    assert [(r.k, r.candidate) for r in textops.best_match(c, "k", textops.similarity(F.col("x"), F.col("y")), F.lit(0.0), 0.8, 0.1).collect()] == [(1, "a")]


def test_greedy(spark):
    works = [(1, ["a", "b"], True), (2, ["b", "c"], True), (3, ["c"], True), (4, ["k"], True), (5, ["d"], False), (6, ["d"], True), (7, [], True)]
    df = spark.createDataFrame(works, "at int, keys array<string>, wanted boolean")
    got = {r["at"]: r.disposition for r in discover.greedy_accept(df, spark.createDataFrame([("k",)], "key string"), "at").collect()}
    assert got == {1: "accepted", 2: "duplicate", 3: "accepted", 4: "known", 5: "filtered", 6: "accepted", 7: "accepted"}


def test_greedy_equals_a_scan_in_order(spark):
    rng = np.random.default_rng(6)
    works = [(i, [f"k{k}" for k in rng.choice(25, int(rng.integers(0, 4)))], bool(rng.random() < 0.7)) for i in range(80)]
    seen, want = set(), {}
    for i, ks, ok in works:
        want[i] = "known" if "k0" in ks else "duplicate" if seen & set(ks) else "accepted" if ok else "filtered"
        seen |= set(ks) if want[i] == "accepted" else set()
    df = spark.createDataFrame(works, "at int, keys array<string>, wanted boolean")
    assert {r["at"]: r.disposition for r in discover.greedy_accept(df, spark.createDataFrame([("k0",)], "key string"), "at").collect()} == want


def test_files(spark, tmp_path):
    schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.StructType([T.StructField("z", T.StringType()), T.StructField("y", T.StringType())]))])
    p = tmp_path / "x.jsonl"
    p.write_text('{"b": 1, "a": {"z": "é", "y": null}}\n\n{"b": 2}\n')
    df = files.read_jsonl(spark, str(p), schema)
    assert sorted(r[0] for r in df.select(files.canonical_json(df)).collect()) == ['{"a":null,"b":2}', '{"a":{"y":null,"z":"é"},"b":1}']
    p.write_text('{"b": 1}\n{broken\n')
    assert files.read_jsonl(spark, str(p), schema, tolerant=True).count() == 1
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(p), schema).collect()
    assert files.read_jsonl(spark, str(tmp_path / "none"), schema).count() == 0
    files.write_document(spark, str(tmp_path / "d.json"), {"b": 1})
    files.write_document(spark, str(tmp_path / "d.json"), {"b": 2})
    assert files.read_document(spark, str(tmp_path / "d.json"), {}) == {"b": 2} and files.read_document(spark, str(tmp_path / "e.json"), {"x": 1}) == {"x": 1}
    counts = files.write_by_key(spark.createDataFrame([("a", 1)], "k string, v int"), str(tmp_path / "parts"), "k", ["a", "b"])
    assert {r.k: r.n for r in counts.collect()} == {"a": 1, "b": 0}
    assert files.file_digests(spark, str(tmp_path / "d.json")).count() == 1
    assert files.step_output({"a": True, "b": ["x", 1]}) == "a=true\nb=x,1\n"


def test_mail(spark):
    raw = 'From: s@x.example\nSubject: Alert\nMessage-ID: <m1>\nDate: Mon, 05 Jan 2026 00:12:28 +0000\nAuthentication-Results: mx; spf=pass; dkim=fail\nContent-Type: text/html; charset=utf-8\n\n<h3><a href="https://p.example/1">A long enough title</a></h3><div>A Bee, C Dee - Annals of X, 2020</div><div>A snippet.</div><a href="https://p.example/share">share this page now</a>'
    df = spark.createDataFrame([(base64.urlsafe_b64encode(raw.encode()).decode().rstrip("="),), (None,), ("!!",)], "raw string").select(mail.parsed_message("raw").alias("m")).select("m.*")
    r = mail.trusted(df, ["s@x.example"]).select("message_id", "spf", "sent_at", mail.result_blocks("html").alias("b")).collect()
    assert len(r) == 1 and (r[0].message_id, r[0].spf, r[0].sent_at) == ("<m1>", "pass", "2026-01-05T00:12:28+00:00")
    assert [(b.title, b.metadata, b.snippet) for b in r[0].b] == [("A long enough title", "A Bee, C Dee - Annals of X, 2020", "A snippet.")]


def test_paged_source(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"results": [{"id": f"w{i}{j}"} for j in range(2)]}))
    spark.dataSource.register(PagedSource)
    assert spark.read.format("paged").option("path", str(tmp_path)).option("page_size", "2").option("max_rows", "4").load().count() == 4


def test_copies_of_a_lookup_are_not_broadcast(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else str(i)) for i in range(60)] + [(60, None)], "id int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("3", 2)], "k string, v int")
    joined = salted_lookup(rows, lookup, "k", "id", "left")
    got = {(r.id, r.v) for r in joined.collect()}
    assert got == {(i, 1 if i % 3 else 2 if i == 3 else None) for i in range(60)} | {(60, None)}
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
