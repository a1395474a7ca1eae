import pytest

from sieveline.llm.truncation import OK, STRONG, WEAK, judge, truncated, truncation_report

ENDS = {"noise", "drift", "sensing"}


@pytest.mark.parametrize(
    ("field", "value", "venue", "expected"),
    [
        ("title", "On Filters under Noise", None, OK),
        ("title", "On Filters under No", None, WEAK),
        ("title", "On Filters under …", None, STRONG),
        ("title", "On Filters under Noise: Volume 3", None, OK),
        ("title", "… On Filters under Noise", None, OK),
        ("title", "Untitled", None, None),
        ("snippet", "It works well.", None, OK),
        ("snippet", "It works (very well.)", None, OK),
        ("snippet", "It works well [12].", None, OK),
        ("snippet", "It works well. [12]", None, OK),
        ("snippet", "It works wel", None, WEAK),
        ("snippet", "It works, see [12", None, STRONG),
        ("snippet", "We prove it. The result (obtained with the method of the second part under all of the conditions that hold", None, STRONG),
        ("snippet", "A habit (never closed. It is so here and works without an end", None, WEAK),
        ("snippet", "It works &am", None, STRONG),
        ("snippet", "It works <i", None, STRONG),
        ("snippet", "It works �", None, STRONG),
        ("snippet", "It gained 36.", None, WEAK),
        ("snippet", "It works. Keywords: a, b, noise", None, OK),
        ("snippet", "It works. Keywords: a, noi", None, WEAK),
        ("snippet", "It works. doi:10.5555/7f82ee11", None, OK),
        ("snippet", "It works. doi:10.5555/7f", None, WEAK),
        ("snippet", "Begins … and ends.", None, OK),
        ("snippet", "", None, None),
        ("snippet", None, None, None),
        ("snippet", "-", None, None),
        ("raw_metadata_line", "A Bee - Annals of X, 2020", "Annals of X", OK),
        ("raw_metadata_line", "A Bee - Annals of X", "Annals of X", OK),
        ("raw_metadata_line", "A Bee - Annals of X, 20", "Annals of X", WEAK),
        ("raw_metadata_line", "A Bee - Annals", "Annals of X", WEAK),
        ("raw_metadata_line", "A Bee… - Annals of X, 2020", "Annals of X", OK),
        ("raw_metadata_line", "A Bee - Annals of…", "Annals of…", STRONG),
    ],
)
def test_judge(field, value, venue, expected):
    assert judge(field, value, venue, ENDS, 3) == expected


def test_very_long_value():
    assert judge("snippet", "(" * 200_000 + " word.", None, ENDS, 3) == OK


ROW = "delivery_seq bigint, source struct<sender: string>, title string, snippet string, raw_metadata_line string, venue struct<raw: string>, lost int"


def test_baseline_of_the_source(spark):
    good = [(i, ("a",), "Big Noise", "All is well.", None, (None,), 1) for i in range(6)]
    rows = good + [(10, ("a",), "Big Noise", "All is wel", None, (None,), 1), (11, (None,), None, None, None, None, None)] + [(20 + i, ("b",), None, "no marks here", None, (None,), 1) for i in range(4)]
    found = truncated(spark.createDataFrame(rows, ROW), seq="delivery_seq", source="source.sender", ends=ENDS)
    assert [(r.seq, r.field) for r in found.where("lost").collect()] == [(10, "snippet")]
    report = {(r.source, r.field): r.n_truncated for r in truncation_report(found).collect()}
    assert report[("a", "snippet")] == 1 and report[("b", "snippet")] == 0


def test_empty_table(spark):
    assert truncated(spark.createDataFrame([], ROW), seq="delivery_seq", source="source.sender").count() == 0
