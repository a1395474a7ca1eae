"""Gates, closures and fuzzy pairs against plain Python."""

import itertools
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from sieveline.functions import pieces as P
from sieveline.operators import gates as G
from sieveline.operators import textops
from sieveline.operators.resolve import title_closure
from sieveline.operators.textops import best_match, sharing_words, similarity
from sieveline.sources.files import read_document, write_document


def test_title_closure_bridges_over_nulls(spark):
    t = "a title that is long enough"
    rows = [(1, t, 2018, "a"), (2, t, None, None), (3, t, 2025, "b"), (4, t + "!", 2018, "a"), (5, t + "!", 2019, "a"), (6, t + "!", 2021, "a"), (7, "short", 2018, "a"), (8, "short", 2018, "a"), (9, None, None, None), (10, t, 2018, "a")]
    got = {r.seq: r.entity for r in title_closure(spark.createDataFrame(rows, "seq bigint, title string, year int, author string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9, 10: 1}


def test_pairs_sharing_half_of_their_words_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdef"), 5)) for _ in range(40)]
    texts = [" ".join(rng.choice(words, int(rng.integers(3, 9)))) for _ in range(60)]
    texts += [x.replace("a", "aa", 1) for x in texts[:20]] + ["", "one"]
    a, b = list(enumerate(texts[::2])), list(enumerate(texts[1::2]))
    x, y = spark.createDataFrame([(i, t, i % 2) for i, t in a], "later int, ta string, year int"), spark.createDataFrame([(i, t, i % 2) for i, t in b], "candidate int, tb string, year int")
    got = {(r.later, r.candidate) for r in sharing_words(x, y, "ta", "tb", ["year"]).collect()}
    sets = lambda t: set(t.split())
    want = {(i, j) for (i, t), (j, u) in itertools.product(a, b) if i % 2 == j % 2 and sets(t) and len(sets(t) & sets(u)) * 2 >= max(len(sets(t)), len(sets(u)))}
    assert got == want and len(want) >= 10
    found = best_match(sharing_words(x, y, "ta", "tb", ["year"]), "later", similarity(F.col("ta"), F.col("tb")), F.lit(0.0), 0.8, 0.0)
    for r in found.collect():
        assert abs(r.ratio - max(SequenceMatcher(None, a[r.later][1], u).ratio() for j, u in b if (r.later, j) in want)) < 1e-9


def test_pairs_of_many_titles_in_blocks_keep_every_match(spark, monkeypatch):
    monkeypatch.setattr(textops, "ROWS_A", 150), monkeypatch.setattr(textops, "ROWS_B", 400)
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(3, 8)))) for _ in range(60)]
    b = [" ".join(rng.choice(words, int(rng.integers(1, 13)))) for _ in range(1500)]
    a = [t.replace("a", "x", 1) + rng.choice(["", " b", "s"]) for t in b[:500]] + ["", "  ", "é \U0001f600 z" * 30]
    x = spark.createDataFrame([(i, t, None if i == 7 else 1) for i, t in enumerate(a)], "later int, ta string, year int")
    y = spark.createDataFrame([(i, t, 1) for i, t in enumerate(b)] + [(-1, None, 1), (-2, b[7], None)], "candidate int, tb string, year int")
    pairs = sharing_words(x, y, "ta", "tb", ["year"], 0.8)
    got = {(r.later, r.candidate) for r in pairs.collect()}
    sets = [[set(t.split()) for t in side] for side in (a, b)]
    shared = {(i, j) for i, s in enumerate(sets[0]) for j, u in enumerate(sets[1]) if i != 7 and s and len(s & u) * 2 >= max(len(s), len(u))}
    high = {(i, j) for i, j in shared if (m := SequenceMatcher(None, a[i], b[j])).quick_ratio() >= 0.8 and m.ratio() >= 0.8}
    assert high <= got <= shared and len(high) > 300 and len(got) < len(shared)
    assert pairs.count() == len(got)


def test_gates(spark):
    rows = spark.createDataFrame([(1, True), (1, True), (2, False), (2, True), (3, True)], "b int, ok boolean")
    assert [(r.b, r.advances, r.checkpoint) for r in G.checkpoints(rows, "b", ~F.col("ok")).orderBy("b").collect()] == [(1, True, 1), (2, False, 1), (3, True, 3)]
    old, new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "s string, v int"), spark.createDataFrame([("a", 9)], "s string, v int")
    assert sorted(map(tuple, G.replaced_by_source(old, new, "s").collect())) == [("a", 9), ("b", 3)]
    many = spark.createDataFrame([(g, i) for i in range(30) for g in "xy"], "g string, o int").withColumn("o", F.col("o") * 2 + (F.col("g") == "y").cast("int"))
    assert [r.o for r in G.capped_run(many, "g", "o", 3, 5).collect()] == [0, 1, 2, 3, 4]


def test_pieces(spark):
    df = spark.createDataFrame([("a [b] c", "X <Y@z.Example>", None), ("none", "y@z", "-"), (None, None, " v ")], "t string, m string, v string")
    got = df.select(P.between(F.col("t"), "[", "]").alias("i"), P.email_address(F.col("m")).alias("e"), P.as_list(F.col("v"), ["-"]).alias("v"), P.excerpt(F.col("t"), "b", 2).alias("x")).collect()
    assert [tuple(r) for r in got] == [("b", "y@z.example", [], " [b] "), ("", None, [], "no"), (None, None, [" v "], None)]


def test_documents_are_replaced_in_one_step(spark, tmp_path):
    path = f"file://{tmp_path}/x.json"
    for i in range(3):
        write_document(spark, path, {"n": i})
        assert read_document(spark, path, None) == {"n": i}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.json"]
