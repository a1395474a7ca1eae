import numpy as np

from sieveline.llm.leakage import BUCKETS, RANK, STEP, WINDOW, Hashes, Items, leaked, misspelt, padded, window_vectors, words_of


def texts(n, seed, words=60):
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("bcdfghklmnprst"), 2)) + x for x in ("ola", "umi", "eran", "isto", "ander", "okal") for _ in range(60)]
    return [" ".join(rng.choice(vocab, words)) for _ in range(n)]


def test_whole_part_and_altered_passages(spark):
    items = texts(6, 1, 80)
    noise = texts(120, 2, 90)
    part = items[1].split()[20:56]
    altered = [w if i % 5 else w[1:] + "x" for i, w in enumerate(items[2].split())]
    docs = [(i, t) for i, t in enumerate(noise)] + [
        (200, noise[0] + " " + items[0]), (201, " ".join(part) + ". " + noise[1]), (202, noise[2] + "\n" + " ".join(altered).upper()), (203, " ".join(items[3].split()[:6]) + " " + noise[3]),
        (204, "  ".join(items[4].replace("o", "o­").split())), (205, None), (206, ""), (207, "..."), (200, noise[0] + " " + items[0]), (208, (noise[4] + " ") * 40 + items[5]),
    ]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, tokens int")
    e = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(9, None), (None, "x"), (8, "short one")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaked(d, e, key="doc_id", text="text", item_key="item_id", item_text="text").collect()}
    assert got == {(200, 0), (201, 1), (202, 2), (204, 4), (208, 5)}


def test_short_passages_across_both_grids(spark):
    items, noise = texts(4, 5, 90), texts(130, 6, 90)
    docs, want = list(enumerate(noise)), set()
    for at in range(0, 64, 3):
        for altered in (0, 4):
            k, words = at % 4, items[at % 4].split()[at % 61 : at % 61 + 25]
            for i in range(altered):
                words[3 + 6 * i] = f"other{at}x{i}"
            before = noise[at].split()
            docs.append((1000 + 2 * at + (altered > 0), " ".join(before[: at + 7] + words + before[at + 7 :])))
            want.add((docs[-1][0], k))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    e = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaked(d, e, key="doc_id", text="text", item_key="item_id", item_text="text").collect()}
    assert got <= want
    assert {x for x in want if x[0] % 2 == 0} <= got and len(got) >= 0.8 * len(want)


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    e = spark.createDataFrame([], "item_id bigint, text string")
    assert leaked(d, e, key="doc_id", text="text", item_key="item_id", item_text="text").count() == 0


def test_windows_equal_plain_sums():
    rng = np.random.default_rng(0)
    v = np.append(rng.standard_normal((BUCKETS, RANK)).astype(np.float32), np.zeros((1, RANK), np.float32), axis=0)
    ends = np.cumsum([0, 5, 0, 40, 16, 100])
    bucket = rng.integers(0, BUCKETS, ends[-1])
    text, first, unit = window_vectors(v, bucket, ends)
    assert set(text.tolist()) == {0, 2, 3, 4}
    for t, f, u in zip(text, first, unit):
        x = v[bucket[f : min(f + WINDOW, ends[t + 1])]].sum(0)
        assert np.allclose(u, x / np.linalg.norm(x), atol=1e-5)
    assert (padded(bucket, ends, STEP)[2] == BUCKETS).sum() == 3 + 0 + 0 + 4


def test_alignment_counts_words_in_order():
    vectors, idf = np.ones((BUCKETS + 1, RANK), np.float32), np.ones(BUCKETS, np.float32)
    it = Items([(1, " ".join(f"w{i}" for i in range(40)))], vectors, idf)
    t = np.array(list(it.hashes[0][5:35]), np.uint32)
    assert it.aligned([(0, t, -5, None)]) == [(30, 1.0, 1.0)]
    assert it.aligned([(0, t[::-1].copy(), -5, None), (0, t[:9], -5, None)])[0][0] <= 2
    assert misspelt("resonator", "resontaor") and not misspelt("resonator", "detector")
    assert words_of("Acousto-\nOptic​ X") == ["acousto", "optic", "x"] and words_of(None) == []
    assert np.array_equal(Hashes().of("Acousto-Optic x_1's 2"), Hashes().of("Acousto-\u00adOptic x_1’s 2")) and len(Hashes().of(None)) == 0


def test_lists_find_what_exhaustive_search_finds():
    items, noise = texts(60, 11, 90), texts(300, 12, 60)
    rng = np.random.default_rng(1)
    vectors = np.append(rng.standard_normal((BUCKETS, RANK)).astype(np.float32), np.zeros((1, RANK), np.float32), axis=0)
    it = Items(list(enumerate(items)), vectors, np.ones(BUCKETS, np.float32))
    planted = [n + " " + " ".join(w for i, w in enumerate(items[k % 60].split()[k % 50 : k % 50 + 30]) if i % 6) for k, n in enumerate(noise)]
    each = [Hashes().of(x) for x in planted]
    unit = window_vectors(vectors, (np.concatenate(each) % BUCKETS).astype(np.int64), np.cumsum([0, *map(len, each)]))[2]
    i, j = np.nonzero(unit @ it.unit.T >= 0.65)
    got = set(zip(*map(np.ndarray.tolist, it.near(unit, 0.65))))
    assert len(i) > 200 and got <= set(zip(i.tolist(), j.tolist())) and len(got) >= 0.95 * len(i)
    assert Items([], vectors, np.ones(BUCKETS, np.float32)).candidates(each[0], np.array([0, len(each[0])])) == {}
