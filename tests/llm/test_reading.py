import numpy as np

from sieveline.llm.reading import BUCKETS, Classes, Ordinal, features, reading_levels

EASY = "The cat can see the ball. We put the cup on the box. He did see my red hat. "
HARD = "Notwithstanding the representational indeterminacy of interferometric architectures, whose commensurability presupposes differentiability, the interpretation that circumscribes parameterization necessitates, insofar as regularization is heterogeneous, an epistemological reconfiguration of the formalism. "


def test_what_is_prose():
    idf, c = np.zeros(BUCKETS, np.float32), Classes()
    assert features(EASY * 4, c, idf) is not None and features(HARD * 3, c, idf) is not None
    german = "Wir zeigen, dass das neue Netz ohne Kühlung stabil bleibt. Die Schaltung wurde im Labor mit zwei Lasern geprüft. " * 5
    for text in (None, "", "  ", EASY, "a\t1.2\t3\tOK\n" * 60, german, "光学神经网络" * 100, "alpha beta gamma delta " * 40, "12 34 56 " * 50):
        assert features(text, c, idf) is None
    assert features(EASY * 20_000, c, idf) is not None


def test_ordinal_model_recovers_levels():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 6))
    score = x @ np.array([2.0, -1.0, 0, 0, 0.5, 0])
    y = np.digitize(score + 0.3 * rng.logistic(size=1500), [-2, -0.7, 0.7, 2]) + 1
    m = Ordinal(x[:1000], y[:1000])
    assert np.mean(np.abs(m.levels(x[1000:]) - y[1000:]) <= 1) > 0.97 and np.mean(m.levels(x[1000:]) == y[1000:]) > 0.6


def test_levels(spark):
    docs = [(i, EASY * (4 + i % 3), "en") for i in range(20)] + [(100 + i, HARD * (2 + i % 3), None) for i in range(20)] + [(300, None, "en"), (301, "", "en"), (302, EASY, "en"), (0, EASY * 4, "en")]
    d = spark.createDataFrame([(i, t, x, 3) for i, t, x in docs], "doc_id bigint, text string, lang string, reading_level int")
    labels = spark.createDataFrame([(i, 1, "r") for i in range(12)] + [(100 + i, 5, "r") for i in range(12)] + [(None, 3, "r"), (5, None, "r"), (999, 2, "r"), (301, 2, "r"), (3, 77, "r")], "doc_id bigint, reading_level int, text string")
    got = reading_levels(d, labels, key="doc_id", text="text", level="reading_level").collect()
    assert sorted({(r.doc_id, r.reading_level) for r in got}) == sorted({(i, 1) for i in range(20)} | {(100 + i, 5) for i in range(20)})
    assert len(got) == 41
    assert reading_levels(d, labels.limit(0), key="doc_id", text="text", level="reading_level").count() == 0
    assert reading_levels(d.limit(0), labels, key="doc_id", text="text", level="reading_level").count() == 0
