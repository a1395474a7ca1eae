import pytest
from pyspark.sql import functions as F

from sieveline.functions import text as X
from sieveline.functions import time as TM


def one(spark, column, *values, types=None):
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types or ["string"] * len(values)))
    return spark.createDataFrame([values], schema).select(column(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x


@pytest.mark.parametrize(
    ("function", "given", "expected"),
    [
        (X.matchable, "  On–Line   Tests ", "on-line tests"), (X.unpunctuated, "A: b-c_d!", "a b c_d"), (X.clean_title, "[PDF] [HTML]  A  title", "A title"), (X.normal_title, "2024 - A Title: Part", "a title part"),
        (X.normal_venue, "Nature & Light…", "nature light"), (X.doi_key, "https://doi.org/10.1/AB.", "10.1/ab"), (X.doi_key, "", None), (X.strict_doi, "doi:10.1234/Ab", "10.1234/Ab"), (X.strict_doi, "10.1234/a b", None),
        (X.cut_doi, "10.1/x.short.", "10.1/x"), (X.clean_url, "https://a.b/c?utm_x=1&q=2#top", "https://a.b/c?q=2"), (X.clean_url, "ftp://a", None), (X.unwrapped_url, "https://s.example/url?url=https%253A%252F%252Fa.b%252Fc%252B1&sa=X", "https://a.b/c+1"),
        (X.host, "https://A.b:80/c", "a.b"), (X.last_segment, "https://x/y/W12/", "W12"), (X.author_key, "Jean O'Neil-Smith ", "oneilsmith"), (X.safe_year, "20x", None), (X.han_count, "a光b学", 2), (X.nfkc, "ﬁne ²", "fine 2"), (X.unescaped, "a &amp; b", "a & b"),
        (X.plain_text, "<p>a<b>b</b></p> &lt;", "a b <"), (X.plain_text, "<p></p>", None), (X.sentences, "One. Two! Three", ["One.", "Two!", "Three"]), (X.numbers, "−3.5 and 7", [-3.5, 7.0]), (TM.sortable_day, "2026-05", 20260500), (TM.sortable_day, None, 0),
    ],
)
def test_scalar(spark, function, given, expected):
    assert one(spark, function, given) == expected


@pytest.mark.parametrize(("y", "m", "d", "expected"), [("2026", None, None, "2026"), ("2026", "8", None, "2026-08"), ("2025", "12", "31", "2025-12-31"), ("2026", "2", "31", "2026-02"), ("not-a-year", "1", "1", None), ("2026", "13", "1", "2026")])
def test_partial_dates(spark, y, m, d, expected):
    assert one(spark, TM.partial_date, y, m, d) == expected


@pytest.mark.parametrize(("text", "expected"), [("2026-01-02T03:04:05Z", 1767323045), ("2026-01-02T03:04:05+08:00", 1767294245), ("2026-01-02T03:04:05.000", 1767323045), ("2026-01-02", 1767312000), ("2026-01", None), ("x", None), (None, None)])
def test_instant(spark, text, expected):
    assert one(spark, lambda c: F.unix_timestamp(TM.instant(c)), text) == expected


def test_arrays(spark):
    assert one(spark, X.first_wins, ["Ann", "ann", None, "Bob"], types=["array<string>"]) == ["Ann", "Bob"]
    assert one(spark, X.inverted_text, {"b": [1, 3], "a": [0], "c": [2]}, types=["map<string,array<int>>"]) == "a b c b"
    assert one(spark, X.unsupported_numbers, "gain 3.01 and 9", "gain 3") == [9.0]
    assert one(spark, X.metadata_line, ["A", None, " ", "B"], None, 2020, types=["array<string>", "string", "int"]) == "A, B - 2020"
    parts = spark.createDataFrame([("A Bee, C Dee… - 2019 Conf, 2020",)], "l string").select(*(c.alias(k) for k, c in X.split_metadata(F.col("l")).items())).first()
    assert (parts.names, parts.venue, parts.year) == (["A Bee", "C Dee"], "2019 Conf", 2020)
    assert one(spark, lambda y: TM.age_days(F.lit("2026-05"), y, F.lit("2026-01-11 00:00:00").cast("timestamp")), 2026, types=["int"]) == 10
