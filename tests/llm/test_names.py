import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm.names import linked_names, near, parse, similar_tokens


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("Elizabeth Prirfenkilhor", ("person", "prirfenkilhor", "elizabeth", "")),
        ("PRIRFENKILHOR Elizabeth", ("person", "prirfenkilhor", "elizabeth", "")),
        ("Prirfenkilhor, Liz M.", ("person", "prirfenkilhor", "elizabeth", "m")),
        ("Prof. E. M. Prirfenkilhor", ("person", "prirfenkilhor", "", "em")),
        ("Prirfenkilhor EM", ("person", "prirfenkilhor", "", "em")),
        ("Grunruklendul DR", ("person", "grunruklendul", "", "dr")),
        (" elizabeth  prirfenkilhor", ("person", "prirfenkilhor", "elizabeth", "")),
        ("Falkalkleljin Lab Evane. Mater.", ("lab", "falkalkleljin", "evan mate", "")),
        ("Laboratory for Evanescent Materials, Falkalkleljin", ("lab", "falkalkleljin", "evan mate", "")),
        ("The Falkalkleljin Laboratory (Evanescent Materials)", ("lab", "falkalkleljin", "evan mate", "")),
        ("--", None),
    ],
)
def test_parse(name, expected):
    assert parse(name) == expected


def test_links(spark):
    names = ["Elizabeth Prirfenkilhor", "Prirfenkilhor, Liz", "E Prirfenkilhor", "Elizabeth Prirfenklihor", "Thierry Prirfenkilhor", "Falkalkleljin Lab Evane. Mater.", "Falkalkleljin Laboratory for Evanescent Materials", "Falkalkleljin Institute for Evanescent Materials", None, "", " ", "--", "x" * 3000]
    df = spark.createDataFrame([(n, n, 1) for n in names + names[:3]], "name string, other string, entity int")
    got = {(r.name_a, r.name_b) for r in linked_names(df, "name").collect()}
    same = [names[:4], names[5:7]]
    assert got == {tuple(sorted((a, b))) for g in same for a in g for b in g if a != b}


def test_nothing(spark):
    assert linked_names(spark.createDataFrame([], "name string"), "name").count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text("abcde", min_size=5, max_size=9), min_size=2, max_size=25, unique=True))
def test_similar_tokens_equal_brute_force(spark, tokens):
    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def fits(a, b):
        d = lev(a, b)
        d = 1 if d == 2 and sorted(a) == sorted(b) else d
        return d <= (1 if min(len(a), len(b)) < 7 else 2) and abs(len(a) - len(b)) <= 2

    want = {(a, b) for a in tokens for b in tokens if a < b and fits(a, b)}
    got = {(r.a, r.b) for r in similar_tokens(spark.createDataFrame([(t,) for t in tokens], "own string")).collect()}
    assert got <= want
    # Texts over five letters repeat their grams; the count bound holds for grams that differ.
    distinct = {(a, b) for a, b in want if all(len({f"^^{t}$$"[i : i + 3] for i in range(len(t) + 2)}) == len(t) + 2 for t in (a, b)) and lev(a, b) <= (1 if min(len(a), len(b)) < 7 else 2)}
    assert distinct <= got


def test_transposition_beside_another_edit(spark):
    # Levenshtein distances 3, 4, and 3 without a transposition: different families.
    tokens = ["tanhnabrulpon", "tannhanbrulpon", "zelgardalprul", "zelgradaplrul", "brengortulgrur", "prennornulgrur"]
    got = {(r.a, r.b) for r in similar_tokens(spark.createDataFrame([(t,) for t in tokens], "own string")).collect()}
    assert got == {("tanhnabrulpon", "tannhanbrulpon"), ("zelgardalprul", "zelgradaplrul")}


def test_transposition_in_short_tokens(spark):
    # Other tokens make the grams of the swapped letters rare and those of the ends frequent; the last pairs repeat their grams.
    ends = [f"s{x}{y}th" for x in "abcdef" for y in "uvwxyz"]
    tokens = ["smith", "simth", "abcde", "ebcda", "banan", "bnaan", "aaaaaab", "aaaaabb", "nananas", "nanans", "marten", "matren", *ends]
    got = {(r.a, r.b) for r in similar_tokens(spark.createDataFrame([(t,) for t in tokens], "own string")).collect()}
    want = {("simth", "smith"), ("abcde", "ebcda"), ("banan", "bnaan"), ("aaaaaab", "aaaaabb"), ("nananas", "nanans"), ("marten", "matren")}
    assert {(a, b) for a, b in got if not {a, b} & set(ends)} == want


def test_near():
    assert near("abcd", "abdc", 1) and not near("abcd", "badc", 1) and near("", "", 0)
