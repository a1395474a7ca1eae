"""Evaluation passages in a corpus: latent semantic retrieval, then the longest common subsequence and a check of the answers.

Texts become sequences of word hashes. A distributed randomised singular value decomposition of the TF-IDF matrix of the
corpus' passages (the directions are fitted to the passages of about SAMPLE documents, those of least hash; word counts, search and alignment cover all. Each task multiplies
its passages with a random test matrix and back; the small products are summed in a tree, and the Nystroem form gives directions and weights from one pass) yields a vector for each word
bucket. Windows of WINDOW words, every STEP words in documents and every ITEM_STEP words in items, are compared by cosine: a passage of 25 words holds a whole window of the document
wherever it lies, and a window of the item that is shifted against it by at most half of ITEM_STEP. Of the similar windows, those that share enough weight of words are kept, and around them
the longest common subsequence is taken, words weighted by rarity, misspelt words as equal, gaps at a cost so that it is that of a passage. A document leaks
an item if the subsequence has enough words and most of the weight of the item's part, and holds its answers: the rarest words of
that part, which questions on it would ask for.

Nothing is stored: texts are read once for the counts and once for the search, and their words are hashed anew, which costs less than writing them.

Cases: null and blank texts hold nothing; items shorter than a window are compared whole; documents of any length are searched whole; copies of a
document give a row each; the items are a stated set of bounded size, which is checked.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.names import near

BUCKETS, RANK, EXTRA = 8192, 128, 32
WINDOW, STEP, ITEM_STEP, PASSAGE = 16, 8, 4, 32
#: Documents that the directions are fitted to, at most about.
SAMPLE = 10_000
#: Least cosine of a candidate, and least share of an item window's weight that the document must hold, in any order, within AROUND words of its window.
SIMILAR, LEAST_HELD, AROUND = 0.68, 0.6, 4
#: Words of an item window that are in order in the document, and least weight of its rarest ANSWERS among them: two such windows at one place, or one with more, are aligned.
#: Measured on planted passages: all of 25 words that are whole or have 15 % altered are aligned, 98 % with 25 %, three quarters with 30 %; of 32 words 99 and 92 %; all from 40 words on.
IN_ORDER, MORE_IN_ORDER, LEAST_ANSWERED = 10, 12, 0.45
#: An item leaks if the common subsequence has so many words and so much of the weight of the item's words in its span, and its answers, the rarest ANSWERS of the span's words, are held too:
#: the two shares must reach LEAST_BOTH together, and MORE for each word under ENOUGH: texts of one template share many words, but those that matter least, and the shorter, the more by chance.
LEAST_WORDS, LEAST_SHARE, ANSWERS = 17, 0.62, 0.25
LEAST_BOTH, MORE, ENOUGH = 1.15, 0.015, 40
#: Item windows are kept in inverted lists by nearest centre, CENTRES times the root of their number; a document window looks into the lists whose centre has this cosine.
#: Measured against exhaustive search: 99.9 % of the similar windows are found in 5 % of the products.
CENTRES, PROBED = 2.0, 0.2
#: Words by which the places of a passage's words in document and item may drift apart, and pairs that are aligned at once.
SLACK, ALIGNED = 12, 128
MOST_ITEMS = 20_000
NO_WORD = np.uint32(0xFFFFFFFF)

HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff\u202a-\u202e]")
WORDS = re.compile(r"\w+")
#: Of plain texts, lower case and spaces for everything between words.
PLAIN = bytes(ord(chr(c).lower()) if chr(c).isalnum() or chr(c) == "_" else 32 for c in range(128)) + bytes(range(128, 256))


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(unicodedata.normalize("NFKC", HIDDEN.sub("", text)).lower()) if text else []


class Hashes(dict):
    """Hash of each word, kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = zlib.crc32(word)
        return h

    def of(self, text: str | None) -> np.ndarray:
        words = encoded_words(text)
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


def encoded_words(text: str | None) -> list[bytes]:
    """words_of(text), encoded; plain texts take a shorter way to the same."""
    if not text:
        return []
    return text.encode().translate(PLAIN).split() if text.isascii() else [w.encode("utf-8", "replace") for w in words_of(text)]


def blocks(batches: Iterator[pa.RecordBatch], most: int = 400_000) -> Iterator[tuple[list, np.ndarray, np.ndarray, list]]:
    """(keys, word hashes joined, where each text's begin, texts) of about so many words at a time; columns key and text."""
    hashes = Hashes()
    keys: list = []
    parts: list[np.ndarray] = []
    texts: list = []
    size = 0
    for b in batches:
        for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            part = hashes.of(text)
            keys.append(k), parts.append(part), texts.append(text)
            size += len(part)
            if size >= most:
                yield keys, np.concatenate(parts), np.cumsum([0, *map(len, parts)]), texts
                keys, parts, texts, size = [], [], [], 0
    if keys:
        yield keys, np.concatenate(parts), np.cumsum([0, *map(len, parts)]), texts


def summed(parts: DataFrame, shape: tuple[int, ...], dtype: str) -> np.ndarray:
    """Sum of the arrays in column part over all tasks, in a tree."""

    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = np.zeros(shape, dtype)
        for raw in t.column("part").to_pylist():
            total += np.frombuffer(raw, dtype).reshape(shape)
        return pa.table({"slot": pa.array([0], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    first = parts.groupBy("slot").applyInArrow(add, "slot int, part binary")
    rows = first.groupBy("slot").applyInArrow(add, "slot int, part binary").collect()
    return np.frombuffer(rows[0].part, dtype).reshape(shape) if rows else np.zeros(shape, dtype)


def document_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for keys, t, ends, _ in blocks(batches):
            row = np.repeat(np.arange(len(keys)), np.diff(ends))
            pair = np.unique(row * BUCKETS + (t % BUCKETS).astype(np.int64))
            total[:BUCKETS] += np.bincount(pair % BUCKETS, minlength=BUCKETS)
            total[BUCKETS] += len(keys)
        yield pa.RecordBatch.from_arrays([pa.array([int(total[BUCKETS]) % 16], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "part"])

    total = summed(texts.mapInArrow(run, "slot int, part binary"), (BUCKETS + 1,), "int64")
    return total[:BUCKETS], int(total[BUCKETS])


def test_matrix() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((BUCKETS, RANK + EXTRA)).astype(np.float32)


def word_vectors(texts: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Vector of each bucket: its weight times the directions, damped by their strength."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = np.append(test_matrix() * idf[:, None], np.zeros((1, RANK + EXTRA), np.float32), axis=0)
        square = np.append(idf**2, np.float32(0))
        total = np.zeros((BUCKETS, RANK + EXTRA), np.float32)
        n = 0
        for keys, t, ends, _ in blocks(batches, most=100_000):
            n += len(keys)
            bucket = (t % BUCKETS).astype(np.int64)
            if not len(bucket):
                continue
            # Passages: so many words each, none over the end of its document.
            _, starts, passages = padded(bucket, ends, PASSAGE)
            rows = np.concatenate([np.take(weighted, p.ravel(), axis=0).reshape(len(p), PASSAGE, -1).sum(1) for p in np.array_split(passages, -(-len(passages) // 100))])
            rows /= np.maximum(square[passages].sum(1), 1e-12)[:, None]
            back = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(bucket))))
            order = np.argsort(bucket, kind="stable")
            own, first = np.unique(bucket[order], return_index=True)
            total[own] += np.add.reduceat(rows[back[order]], first, axis=0)
        total *= idf[:, None]
        yield pa.RecordBatch.from_arrays([pa.array([n % 16], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "part"])

    y = summed(texts.mapInArrow(run, "slot int, part binary"), (BUCKETS, RANK + EXTRA), "float32").astype(np.float64)
    omega = test_matrix().astype(np.float64)
    shift = 1e-6 * max(np.linalg.norm(y), 1e-9)
    y = y + shift * omega
    core = omega.T @ y
    root = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(len(core)))
    u, s, _ = np.linalg.svd(np.linalg.solve(root, y.T).T, full_matrices=False)
    damped = u[:, :RANK] / np.sqrt(np.maximum(s[:RANK], 1e-9))
    return np.append(damped / max(np.abs(damped).max(), 1e-12) * idf[:, None], np.zeros((1, RANK)), axis=0).astype(np.float32)


def padded(bucket: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, buckets) of each block of size words; the last of a text is filled up with BUCKETS, the bucket of nothing."""
    count = -(-np.diff(ends) // size)
    text = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = ends[:-1][text] + inside * size
    places = first[:, None] + np.arange(size)[None, :]
    return text, first, np.where(places < ends[1:][text][:, None], np.append(bucket, BUCKETS)[np.minimum(places, len(bucket))], BUCKETS)


def window_vectors(v: np.ndarray, bucket: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, unit vector) of each window: blocks of STEP words are summed once, and each window is two of them."""
    text, first, blocks = padded(bucket, ends, STEP)
    if not len(first):
        return text, first, np.zeros((0, RANK), np.float32)
    block = np.take(v, blocks.ravel(), axis=0).reshape(len(blocks), STEP, -1).sum(1)
    following = np.zeros_like(block)
    joined = text[1:] == text[:-1]
    following[:-1][joined] = block[1:][joined]
    block += following
    block /= np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-9)
    # The last block alone is a window only of texts of one block.
    keep = (first == ends[:-1][text]) | np.append(joined, False)
    return text[keep], first[keep], block[keep]


def centred(x: np.ndarray, count: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres of the unit vectors x, and the nearest of each."""
    centres = x[np.linspace(0, len(x) - 1, count).astype(int)].copy() if len(x) else np.zeros((1, RANK), np.float32)
    for _ in range(rounds if len(x) else 0):
        nearest = (x @ centres.T).argmax(1)
        own, first = np.unique(np.sort(nearest), return_index=True)
        centres[own] = np.add.reduceat(x[np.argsort(nearest, kind="stable")], first, axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres, (x @ centres.T).argmax(1)


@lru_cache(500_000)
def misspelt(a: str, b: str) -> bool:
    n = min(len(a), len(b))
    return n >= 3 and abs(len(a) - len(b)) <= 2 and near(a, b, 1 if n < 6 else 2)


@lru_cache(500_000)
def letters(word: str) -> int:
    mask = 0
    for c in word:
        mask |= 1 << (ord(c) % 61)
    return mask


class Items:
    """The evaluation items, their words and windows."""

    def __init__(self, rows: list[tuple[int, str]], vectors: np.ndarray, idf: np.ndarray):
        self.ids = [i for i, _ in rows]
        self.words = [words_of(t) for _, t in rows]
        self.vectors, self.idf = vectors, idf
        hashed = [np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in ws], np.uint32) for ws in self.words]
        self.hashes = hashed
        self.weights = [idf[h % BUCKETS] for h in hashed]
        # Windows every ITEM_STEP words: those of the items without their first words.
        owners, starts, units = [], [], []
        for skipped in range(0, STEP, ITEM_STEP):
            rest = [h[skipped:] if len(h) > STEP + skipped or not skipped else h[:0] for h in hashed]
            ends = np.cumsum([0, *map(len, rest)])
            owner, first, unit = window_vectors(vectors, (np.concatenate([*rest, np.zeros(0, np.uint32)]) % BUCKETS).astype(np.int64), ends)
            owners.append(owner), starts.append(first - ends[owner] + skipped), units.append(unit)
        self.owner, self.starts, self.unit = np.concatenate(owners), np.concatenate(starts), np.concatenate(units)
        # Of each window its words and the share of its weight, by place; a repeated word has its weight once.
        self.window_words, self.window_weights = np.full((WINDOW, len(self.owner)), NO_WORD, np.uint32), np.zeros((WINDOW, len(self.owner)), np.float32)
        self.window_answers = np.zeros_like(self.window_weights)  # the shares of its rarest words, which the answers are among
        for row, (k, a) in enumerate(zip(self.owner, self.starts)):
            h = hashed[k][a : a + WINDOW]
            first_at = np.unique(h, return_index=True)[1]
            w = self.weights[k][a : a + WINDOW][first_at]
            self.window_words[: len(h), row] = np.minimum(h, NO_WORD - 2)
            self.window_weights[first_at, row] = w / max(w.sum(), 1e-9)
            rare = first_at[np.argsort(-w, kind="stable")[: max(1, int(len(h) * ANSWERS))]]
            self.window_answers[rare, row] = self.window_weights[rare, row] / max(self.window_weights[rare, row].sum(), 1e-9)
        self.centres, nearest = centred(self.unit, max(1, int(CENTRES * len(self.unit) ** 0.5)))
        self.lists = [np.flatnonzero(nearest == c) for c in range(len(self.centres))]
        self.across = [np.ascontiguousarray(self.unit[x].T) for x in self.lists]
        #: The items' words side by side, and their letters as bits, for misspelt words.
        self.lengths = np.array([*map(len, hashed), 0])[: len(hashed)]
        shape = (len(hashed), max([*map(len, hashed), 0]) + 1)
        self.padded_hashes, self.padded_weights, self.padded_masks = np.full(shape, 1 << 41, np.int64), np.zeros(shape), np.zeros(shape, np.uint64)
        for k, (h, ws) in enumerate(zip(hashed, self.words)):
            self.padded_hashes[k, : len(h)], self.padded_weights[k, : len(h)], self.padded_masks[k, : len(h)] = h, self.weights[k], [letters(w) for w in ws]
        self.means = np.array([w.mean() if len(w) else 0.0 for w in self.weights])
        self.vocabulary: dict[int, str] = {int(h): w for hs, ws in zip(hashed, self.words) for h, w in zip(hs, ws)}

    def near(self, unit: np.ndarray, similar: float, probed: float = PROBED) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (document window, item window) that are similar, of the lists looked into."""
        asked = unit @ self.centres.T >= probed
        rows, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for c, each in enumerate(self.lists):
            who = np.flatnonzero(asked[:, c])
            if len(who) and len(each):
                at, to = np.divmod(np.flatnonzero((unit[who] @ self.across[c]).ravel() >= similar), len(each))
                rows.append(who[at]), items.append(each[to])
        return np.concatenate(rows), np.concatenate(items)

    def candidates(self, t: np.ndarray, ends: np.ndarray, similar: float = SIMILAR) -> dict[tuple[int, int], list[int]]:
        """(document, item) -> where the item would begin in the document by its similar windows."""
        if not len(t) or not len(self.unit):
            return {}
        doc, first, unit = window_vectors(self.vectors, (t % BUCKETS).astype(np.int64), ends)
        i, j = self.near(unit, similar)
        # The words around each document window, and after those of its document what no word equals.
        place = first[None, :] + np.arange(-AROUND, WINDOW + AROUND)[:, None]
        around = np.where((place >= ends[doc][None, :]) & (place < ends[doc + 1][None, :]), np.minimum(t, NO_WORD - 2)[np.clip(place, 0, len(t) - 1)], NO_WORD - 1)
        hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for at in range(0, len(i), 8192):
            a, b = i[at : at + 8192], j[at : at + 8192]
            met = around[:, a]
            share = np.zeros(len(a), np.float32)
            for c in range(WINDOW):
                share += self.window_weights[c, b] * (met == self.window_words[c, b]).any(0)
            held = np.flatnonzero(share >= LEAST_HELD)
            a, b, met = a[held], b[held], met[:, held]
            # Bit-parallel longest common subsequence: bit c is the window's word c.
            open_ = np.full(len(a), (1 << WINDOW) - 1, np.uint32)
            for words in met:
                bits = np.zeros(len(a), np.uint32)
                for c in range(WINDOW):
                    bits |= (words == self.window_words[c, b]).astype(np.uint32) << np.uint32(c)
                both = open_ & bits
                open_ = ((open_ + both) | (open_ - both)) & np.uint32((1 << WINDOW) - 1)
            ordered = WINDOW - np.bitwise_count(open_).astype(int)
            answered = np.zeros(len(a), np.float32)
            for c in range(WINDOW):
                answered += self.window_answers[c, b] * ((open_ >> np.uint32(c)) & np.uint32(1) == 0)
            keep = (ordered >= IN_ORDER) & (answered >= LEAST_ANSWERED)
            a, b, ordered = a[keep], b[keep], ordered[keep]
            for d, k, begin, n in zip(doc[a], self.owner[b], first[a] - self.starts[b], ordered):
                hits.setdefault((int(d), int(k)), []).append((int(begin), int(n)))
        found = {x: places_of(each) for x, each in hits.items()}
        return {x: begins for x, begins in found.items() if begins}

    def aligned(self, asked: list[tuple[int, np.ndarray, int, list[bytes] | None]]) -> list[tuple[int, float, float]]:
        """For each (item, words, where the item would begin among them, the words spelled out): of the weightiest common subsequence its words, their share of the weight of the item's
        words in its span, and the share of the answers among them. Of each word of the document, the item's words up to SLACK places from its own place are compared."""
        out = [(0, 0.0, 0.0)] * len(asked)
        order = sorted(range(len(asked)), key=lambda x: len(asked[x][1]))
        band = np.arange(-SLACK, SLACK + 1)
        for at in range(0, len(order), ALIGNED):
            part = order[at : at + ALIGNED]
            k = np.array([asked[x][0] for x in part])
            m = max(len(asked[x][1]) for x in part)
            t = np.full((len(part), m), 1 << 40, np.int64)
            for row, x in enumerate(part):
                t[row, : len(asked[x][1])] = asked[x][1]
            # Place in the item, of each word of the document and each of the band.
            places = (np.arange(m)[None, :] - np.array([asked[x][2] for x in part])[:, None])[:, :, None] + band[None, None, :]
            inside = (places >= 0) & (places < self.lengths[k][:, None, None])
            places = np.where(inside, places, self.lengths.max())
            there = self.padded_hashes[k[:, None, None], places]
            same = there == t[:, :, None]
            w = self.padded_weights[k[:, None, None], places]
            self.misspellings(same, places, k, t, [asked[x][3] for x in part])
            mean = self.means[k]
            gap = 0.45 * mean
            score = np.where(same, w, -np.maximum(0.6 * w, gap[:, None, None]))
            score[~inside] = -1e6
            score = np.ascontiguousarray(score.transpose(1, 0, 2))
            gaps = gap[:, None]
            ramp = gaps * np.arange(len(band))[None, :]
            table = np.zeros((m + 1, len(part), len(band)))
            for i in range(m):
                above, row = table[i], table[i + 1]
                np.add(above, score[i], out=row)
                np.maximum(row[:, :-1], above[:, 1:] - gaps, out=row[:, :-1])
                np.maximum(row, 0, out=row)
                row += ramp
                np.maximum.accumulate(row, axis=1, out=row)
                row -= ramp
            top = table.max((0, 2))
            for row, x in enumerate(part):
                # No passage of LEAST_WORDS words with its share of the weight has so low a sum.
                if top[row] >= 5 * mean[row]:
                    out[x] = self.traced(table[:, row], score[:, row], float(gap[row]), same[row], places[row], self.weights[k[row]].astype(np.float64))
        return out

    def misspellings(self, same: np.ndarray, places: np.ndarray, k: np.ndarray, t: np.ndarray, spelled: list[list[bytes] | None]) -> None:
        """Marks as the same what is a misspelt word of the item."""
        for row in range(len(k)):
            words = spelled[row]
            if not words:
                continue
            odd = [i for i in np.flatnonzero(~same[row].any(1)[: len(words)]).tolist() if int(t[row, i]) not in self.vocabulary]
            if odd:
                texts = [words[i].decode("utf-8", "replace") for i in odd]
                # An edit changes at most two letters of the sets of letters.
                apart = np.bitwise_count(np.array([letters(x) for x in texts], np.uint64)[:, None] ^ self.padded_masks[k[row]][places[row, odd]])
                for i, b in zip(*np.nonzero(apart <= 4)):
                    j = places[row, odd[i], b]
                    if j < len(self.words[k[row]]) and misspelt(texts[i], self.words[k[row]][j]):
                        same[row, odd[i], b] = True

    @staticmethod
    def traced(table: np.ndarray, score: np.ndarray, gap: float, same: np.ndarray, places: np.ndarray, w: np.ndarray) -> tuple[int, float, float]:
        i, b = map(int, np.unravel_index(table.argmax(), table.shape))
        held = np.zeros(len(w), bool)
        start = end = int(places[i - 1, b]) + 1
        while i > 0 and b >= 0 and table[i, b] > 1e-9:
            j = int(places[i - 1, b])
            if abs(table[i, b] - (table[i - 1, b] + score[i - 1, b])) < 1e-9:
                held[j] |= same[i - 1, b]
                start = j
                i -= 1
            elif b + 1 < table.shape[1] and abs(table[i, b] - (table[i - 1, b + 1] - gap)) < 1e-9:
                i, b = i - 1, b + 1
            else:
                b -= 1
        span, got = w[start:end], held[start:end]
        if not len(span):
            return 0, 0.0, 0.0
        asked = span >= np.sort(span)[-max(1, int(len(span) * ANSWERS))]
        return int(got.sum()), float(span[got].sum() / span.sum()), float(span[got & asked].sum() / span[asked].sum())


def leaked(docs: DataFrame, items: DataFrame, *, key: str, text: str, item_key: str, item_text: str) -> DataFrame:
    """Columns key, item_key, words, share, answered: the documents that hold passages of items."""
    rows = items.select(F.col(item_key).cast("bigint").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null").distinct().limit(MOST_ITEMS + 1).collect()
    if len(rows) > MOST_ITEMS:
        raise ValueError(f"there are more than {MOST_ITEMS} items; compare them in parts")
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    df, n = document_counts(texts)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + 0.05
    part = min(1.0, SAMPLE / max(n, 1))
    fitted = texts if part == 1.0 else texts.where(F.xxhash64("key") < int(-(2**63) + part * 2**64))
    vectors = word_vectors(fitted, idf)
    given = sorted((r.i, r.t) for r in rows)
    kept = docs.sparkSession.sparkContext.broadcast((vectors, idf, given))  # 8192 short vectors, and the items, whose number is checked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, idf, given = kept.value
        it = Items(given, vectors, idf)
        for keys, t, ends, texts in blocks(batches, most=60_000):
            out: tuple[list, ...] = ([], [], [], [], [])
            who, asked = [], []
            spelled: tuple[int, list[bytes]] = (-1, [])
            for (d, k), begins in sorted(it.candidates(t, ends).items()):
                s, e = int(ends[d]), int(ends[d + 1])
                if spelled[0] != d:
                    spelled = (d, encoded_words(texts[d]))
                for begin in begins:
                    a, z = max(s, begin - SLACK), min(e, begin + len(it.words[k]) + SLACK)
                    who.append((d, k)), asked.append((k, t[a:z], begin - a, spelled[1][a - s : z - s]))
            best: dict[tuple[int, int], tuple[int, float, float]] = {}
            for x, got in zip(who, it.aligned(asked)):
                if leaks(*got):
                    best[x] = max(best.get(x, got), got)
            for (d, k), got in best.items():
                for column, x in zip(out, (keys[d], it.ids[k], *got)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64()))], names=[key, item_key, "words", "share", "answered"])

    return texts.mapInArrow(run, f"`{key}` bigint, `{item_key}` bigint, words int, share double, answered double")


def leaks(words: int, share: float, answered: float) -> bool:
    return words >= LEAST_WORDS and share >= LEAST_SHARE and share + answered >= LEAST_BOTH + MORE * max(0, ENOUGH - words)


def places_of(hits: list[tuple[int, int]]) -> list[int]:
    """Of the (place where an item would begin, words in order) those at most half of SLACK apart taken as one; left out is what only one window with few words in order speaks for."""
    groups: list[list[tuple[int, int]]] = []
    for hit in sorted(hits):
        if groups and hit[0] - groups[-1][0][0] <= SLACK // 2:
            groups[-1].append(hit)
        else:
            groups.append([hit])
    return [sum(b for b, _ in g) // len(g) for g in groups if len(g) > 1 or g[0][1] >= MORE_IN_ORDER]
