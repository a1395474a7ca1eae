from pyspark.sql import functions as F

from sieveline.functions import documents as D

PAGE = "<h1>Top</h1>intro<h2>Methods <b>used</b></h2><p>one<script>var x='</p>'</script><h3>Detail</h3>two<p>three<h2>Results</h2>four"


def test_html_sections(spark):
    got = [(s["level"], s["heading"], s["text"]) for s in D.html_sections_of(PAGE)]
    assert got == [(1, "Top", "intro Methods used one Detail two three Results four"), (2, "Methods used", "one Detail two three"), (3, "Detail", "two three"), (2, "Results", "four")]
    df = spark.createDataFrame([(PAGE,), (None,), ("",)], "page string").select(D.wanted_sections(D.html_sections("page"), ["method", "approach"]).alias("s"))
    assert [[x.heading for x in r.s] for r in df.collect()] == [["Methods used"], [], []]


def test_jats_sections():
    xml = "<article><body><sec><title>Methods</title><p>a</p><sec><title>Setup</title><p>b</p></sec></sec></body></article>"
    assert [(s["level"], s["heading"], s["text"]) for s in D.jats_sections_of(xml)] == [(1, "Methods", "a Setup b"), (2, "Setup", "b")]
    assert D.jats_sections_of("<broken") == [] == D.jats_sections_of(None)


def test_windows_and_redaction(spark):
    text = "key " + "x" * 50 + " KEY key " + "y" * 50
    df = spark.createDataFrame([(text,), ("none",), ("",)], "t string").select(D.keyword_windows(F.col("t"), "key", 5, 10).alias("w"))
    assert [[(x.start, x.end) for x in r.w] for r in df.collect()] == [[(0, 10), (50, 69)], [], []]
    r = spark.range(1).select(D.redacted(F.lit("Gain 3. Loss 7. Noise 8. Fine."), F.lit("gain 3")).alias("t")).first()
    assert r.t == "Gain 3. [not supported] Fine."
