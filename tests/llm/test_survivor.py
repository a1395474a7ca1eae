from sieveline.llm.survivor import damage, merged, survivors

ROW = "delivery_seq bigint, title string, venue struct<raw: string, normalized: string, verification_status: string>, snippet string, raw_metadata_line string, source struct<received_at: string, authentication: struct<dkim: string>>, group_id string"
GOOD = "On Holographic Filters for Sensing under Noise"
SNIP = "We propose a filter. It works well on all devices."


def row(seq, title, venue, status, snippet, line):
    return (seq, title, ("Annals of X", venue, status), snippet, line, ("2026-01-01T00:00:00Z", ("pass",)), "z")


def frames(spark):
    rows = [
        row(1, GOOD[:30], "Ann. X", "raw_email", "We propose a filter.", "A Bee - Annals of X, 20"),
        row(2, "&lt;i&gt;On&lt;/i&gt; Holographic Filters for Sensing under Noise", "Annals of X", "metadata_verified", SNIP, "A Bee - 2020"),
        row(3, GOOD, "Annals of Y", "raw_email", SNIP.replace("works", "Ã©orks"), "A Bee, C Dee - Annals of X, 2020"),
        row(4, GOOD, "Annals of X", "metadata_verified", "It…", "A Bee, C Dee - Annals of X, 2020"),
        row(5, None, None, None, None, None),
        row(6, "Untitled", "-", "raw_email", "-", ""),
    ]
    groups = [(1, s) for s in (1, 2, 3, 4, 5, 6, 6)] + [(2, 5), (2, 99), (None, 1), (3, 6)]
    return spark.createDataFrame(groups, "group_id bigint, delivery_seq bigint"), spark.createDataFrame(rows, ROW), spark.createDataFrame([(1, "Annals of X"), (2, "Annals of Y")], "venue_id int, name string")


def test_winners(spark, monkeypatch):
    monkeypatch.setattr("sieveline.llm.survivor.ending_words", lambda rows, field: {"noise"})
    g, r, n = frames(spark)
    got = {(x.group_id, x.field): x.delivery_seq for x in survivors(g, r, n, group="group_id", seq="delivery_seq").collect()}
    assert got == {(1, "title"): 3, (1, "venue_normalized"): 2, (1, "snippet"): 2, (1, "raw_metadata_line"): 3}
    one = merged(g, r, n, group="group_id", seq="delivery_seq").collect()
    assert [(x.title, x.venue_normalized, x.snippet) for x in one] == [(GOOD, "Annals of X", SNIP)]


def test_empty(spark):
    g, r, n = frames(spark)
    assert survivors(g.limit(0), r, n, group="group_id", seq="delivery_seq").count() == 0
    assert survivors(g, r.limit(0), n.limit(0), group="group_id", seq="delivery_seq").count() == 0


def test_damage():
    ends = {"noise"}
    assert damage("title", GOOD, None, ends) == 0
    for bad in (GOOD.upper(), GOOD.replace("for", "fоr"), GOOD.replace(" ", ""), GOOD.replace(" for", "  for"), "[PDF] " + GOOD, GOOD[:25]):
        assert damage("title", bad, None, ends) > 0
    assert damage("title", "Untitled", None, ends) is None
    assert damage("snippet", "Word " * 50_000 + "end.", None, ends) == 0
