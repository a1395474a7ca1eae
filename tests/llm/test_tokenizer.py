import pytest

from sieveline.llm.tokenizer import VOCABULARY, Encoder, encode_corpus

TEXTS = [None, "", "   ", "Hello world, don't  stop\n\n now", "aaaaaaaaaaaaaaa", "é世界🙂 12345 <|endoftext|>", "x" * 5000 + " end", "tab\there"]


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_ids_equal_the_library(reference):
    assert Encoder(VOCABULARY).encode(TEXTS).to_pylist() == [reference(x) for x in TEXTS]


def test_known_words_may_be_dropped(reference, monkeypatch):
    monkeypatch.setattr("sieveline.llm.tokenizer.KEPT_WORDS", 3)
    e = Encoder(VOCABULARY)
    for x in ("one two three four five", "six seven one two"):
        assert e.encode([x]).to_pylist() == [reference(x)]


def test_corpus_rows(spark, reference):
    df = spark.createDataFrame([(i, x, i) for i, x in enumerate(TEXTS)] + [(3, TEXTS[3], 0)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, list(r.ids)) for r in encode_corpus(df, "doc_id", "text").collect())
    assert got == sorted([(i, reference(x)) for i, x in enumerate(TEXTS)] + [(3, reference(TEXTS[3]))])
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0


def test_long_words_in_several_queries(reference):
    x = "".join(chr(97 + (i * i + 7 * i) % 23) for i in range(20_000))
    assert Encoder(VOCABULARY).encode([x, "short " + x[:3000]]).to_pylist() == [reference(x), reference("short " + x[:3000])]
