import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm.canonical import KINDS, Matcher, Trie, map_to_list
from pyspark.sql import functions as F

LIST = [(1, "Annals of Chromatic Signal Theory"), (2, "Letters in Chromatic Signal Theory"), (3, "Annals of Lumenal Computing"), (4, "International Conference on Lumenal Computing")]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=8, unique=True), st.text("abcd", max_size=7), st.integers(0, 3))
def test_automaton_equals_brute_force(words, query, most):
    trie = Trie()
    for i, w in enumerate(words):
        trie.add(w, i)
    want = {i: d for i, w in enumerate(words) if (d := levenshtein(w, query)) <= most}
    assert trie.near(query, most) == want


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("annals of  chromatic signal theory ", 1), ("Ann. Chrom. Signal Theory", 1), ("Ann Chrom Signal Theory", 1), ("Chromatic Signal Theory, Annals of", 1),
        ("Anals of Chromatic Sgnal Theory", 1), ("Annals оf Chromatic Signal Theory", 1), ("The Annals of Chromatic Signal Theory 12 (3)", 1), ("2019 Letters in Chromatic Signal Theory", 2),
        ("Orrin House: Annals of Lumenal Computing", 3), ("Annals of Lumenal Computing, Orrin House", 3), ("Annals of Lumenal Computing (ALC)", 3), ("International Conference on Lume …", 4), ("International Conference on Lu...", 4),
        ("Letters in Lumenal Computing", 0), ("Lett. Lumen. Compu.", 0), ("Nordic Letters on Soil Acoustics", 0), ("x" * 20_000, 0),
    ],
)
def test_matches(raw, expected):
    assert Matcher(LIST, ["Orrin House"]).of(raw) == expected


def test_rows(spark):
    names = spark.createDataFrame([(k, n, "Orrin House") for k, n in LIST] + [(1, LIST[0][1], None), (None, "x", None)], "venue_id int, name string, publisher string")
    rows = spark.createDataFrame([(1, "ann. chrom. signal theory", 5), (2, LIST[0][1], 5), (3, None, 5), (4, " ", 5), (5, "nothing like it", 5), (1, "ann. chrom. signal theory", 5)], "delivery_seq bigint, value string, venue_id int")
    got = map_to_list(rows, "delivery_seq", F.col("value"), names, key="venue_id", name="name", affix="publisher")
    assert sorted((r.delivery_seq, r.venue_id) for r in got.collect()) == [(1, 1), (1, 1), (5, 0)]
    assert map_to_list(rows.limit(0), "delivery_seq", F.col("value"), names.limit(0), key="venue_id", name="name").count() == 0


def test_combinations_off_a_sparse_list_are_none():
    # 40 kinds and 40 topics, but 44 entries: the combinations are not built, and still not pulled to their neighbours.
    words = [w.title() for w in KINDS]
    kinds = [f"{a} {b} of" for a in words for b in words if a != b][:40]
    topics = ["".join(x) + " Studies" for x in zip("abcdefghijklmnopqrst" * 2, "eiou" * 10, "nrtlsm" * 7, "ae" * 20, "klmnv" * 8)]
    entries = [(i + 1, f"{kinds[i % 40]} {topics[i % 40]}") for i in range(40)] + [(50, "Journal of Lumenal Optics"), (51, "Letters in Lumenal Optics"), (52, "Journal of Spectral Optics"), (53, "Annals of Lumenal Optics")]
    m = Matcher(entries, [])
    assert m.pairs and m.of("Journal of Lumenal Optcs") == 50
    assert m.of("Letters in Spectral Optics") == 0 and m.of("Leters in Spectral Optics") == 0
    assert m.within("Journal of Lumenal Optcs")[50] == 1
