"""Queries over whole tables that have no SQL, against plain Python."""

import re

import __spark_entry__ as entry


def test_keyword_windows_of_long_texts(spark, tmp_path):
    texts = ["x" * 2000 + "Sensor" + "y" * 2000 + "sensor" + "z" * 50, "a sensor", "no", None, "sensor " * 400]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for i, t in enumerate(texts):
        merged = []
        for x in (m.start() for m in re.finditer("sensor", (t or "").lower())):
            s, e = max(x - 100, 0), min(x + 200, len(t))
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(e, merged[-1][1])
            else:
                merged.append([s, e])
        want |= {(i, s, e) for s, e in merged}
    got = {(r.doc_id, r.s, r.e) for r in entry.queries()["keyword_windows"](spark, str(tmp_path)).collect()}
    assert got == want and len(got) == 4


def test_index_of_all_words(spark, tmp_path):
    titles = ["the  red fox", "the fox", None, "", "a", "double  space  end "]
    rows = [(i + 65_534, t) for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "registry_seq bigint, normalized_title string").write.parquet(f"{tmp_path}/openalex_candidate.parquet")
    want: dict = {}
    for i, t in rows:
        for w in (t or "").split():
            want.setdefault((w, i // 65_536), set()).add(i)
    got = {(r.key, r.block): {int(i) for i in r.ids.split(",")} for r in entry.queries()["inverted_index"](spark, str(tmp_path)).collect()}
    assert got == want
    assert {(r.registry_seq, r.rebuilt) for r in entry.queries()["inverted_abstract"](spark, str(tmp_path)).collect()} == {(i, t) for i, t in rows if t is not None}


def test_urls_and_names_of_any_form(spark, tmp_path):
    urls = ["https://A.example/x?utm_source=q&y=1#z", "http://b.example/p", "ftp://c", None]
    spark.createDataFrame([(i, (u,)) for i, u in enumerate(urls)], "delivery_seq int, links struct<primary_url: string>").write.parquet(f"{tmp_path}/alert_candidate.parquet")
    got = {r.delivery_seq: (r.url, r.host) for r in entry.queries()["url_canonicalize"](spark, str(tmp_path)).collect()}
    assert len(got) == 4 and got[0] == ("https://A.example/x?y=1", "a.example") and got[1] == ("http://b.example/p", "b.example") and got[2][0] is None
    names = ["Ana Pérez-Gómez", "Li 王", "J. O’Neil", "Smith"]
    spark.createDataFrame(list(enumerate(names)), "mention_id bigint, name string").write.parquet(f"{tmp_path}/optical_zo.parquet")
    got = {r.mention_id: r.author_key for r in entry.queries()["author_keys"](spark, str(tmp_path)).collect()}
    assert got == {0: "pérezgómez", 1: "王", 2: "oneil", 3: "smith"}
