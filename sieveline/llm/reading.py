"""Reading level of English prose: regularised ordinal regression, calibrated to labelled texts.

Features are lexical diversity, rarity of words in this corpus, connectives and other word classes, proxies of clause depth (commas,
subordinators and relatives in a sentence) and lengths. A proportional-odds model with a ridge penalty is fitted to the ratings of at most
MOST_LABELS rows; rarity is counted over all documents, and every document is scored.

Cases: texts that aren't English running prose of at least LEAST_WORDS words (null, blank, short, tables, fragments, other languages) give no row; rows that share a
key are scored each; without ratings of both ends of the scale there is no model and no row; texts of any length are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.leakage import summed

BUCKETS = 1 << 15
MOST_LABELS = 20_000
LEVELS = (1, 2, 3, 4, 5)
LEAST_WORDS = 40
RIDGE = 1.0
#: English prose has at least this share of common words, and sentence ends at least once in so many words.
LEAST_COMMON, MOST_PER_END = 0.13, 70

WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
SENTENCE_END = re.compile(r"[.!?。]+(?=[\s\"')\]”’]|$)")
#: Classes of English words.
COMMON = set("the of and a to in is that it for on with as by at from are was this be or an which not we can has have but their so when until after before because he she they you my our his her its while whose what into than been were had did do if there those these such upon also may".split())
OTHER_LANGUAGES = set("der die das und ist nicht ein eine wir dass mit ohne lässt sich wurde obwohl außerdem über bleibt le la les des et est une nous avec sans dans que été cependant reste deux pendant el los las una por con para del não uma como il che di non per".split())
CONNECTIVES = set("because although though while when whenever before after until since so if unless even still later then but and or where".split())
FORMAL = set("whereas notwithstanding irrespective insofar inasmuch consequently thereby therefore moreover furthermore principally provided hence whilst albeit nonetheless nevertheless according compared upon ordinarily conventionally however merely namely".split())
RELATIVES = set("which that whose whom who what whether wherein whereby".split())
PERSONAL = set("i you he she it we they me him her us them my your his our their".split())


def class_row(word: str) -> list[float]:
    vowels = len(re.findall(r"[aeiouy]+", word))
    n = len(word)
    return [n, n >= 7, n >= 11, vowels, vowels >= 4, word in COMMON, word in CONNECTIVES, word in FORMAL, word in RELATIVES, word in PERSONAL, "-" in word, word in OTHER_LANGUAGES]


class Classes:
    """Row numbers of words in a growing table of their classes."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows: list[list[float]] = []
        self.table = np.zeros((0, 12), np.float32)
        self.bucket = np.zeros(0, np.int64)
        self.buckets: list[int] = []

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.at) > 300_000:
            self.clear()
        new = set(words).difference(self.at)
        for w in new:
            self.at[w] = len(self.rows)
            self.rows.append(class_row(w))
            self.buckets.append(zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS)
        if len(self.table) < len(self.rows):
            self.table = np.concatenate([self.table, np.array(self.rows[len(self.table) :], np.float32)])
            self.bucket = np.array(self.buckets, np.int64)
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))


NAMES = ("length", "long", "longer", "syllables", "polysyllables", "common", "connectives", "formal", "relatives", "personal", "compounds", "rarity", "rare", "diversity", "sentence", "commas", "depth", "questions", "numbers", "sentence_log")


def features(text: str | None, classes: Classes, idf: np.ndarray) -> list[float] | None:
    """Features of English running prose; None for everything else."""
    if not text:
        return None
    n = len(text.split())
    if n < LEAST_WORDS:
        return None
    words = WORD.findall(text.lower())
    if len(words) < 0.5 * n or text.count("\t") + text.count("|") > 0.15 * n:
        return None
    at = classes.of(words)
    mean = classes.table[at].mean(0)
    if mean[5] < LEAST_COMMON or mean[11] > 0.6 * mean[5]:
        return None
    ends = len(SENTENCE_END.findall(text))
    if ends * MOST_PER_END < n:
        return None
    rarity = idf[classes.bucket[at]]
    commas = text.count(",") + text.count(";") + text.count(":")
    inside = (mean[6] + mean[7] + mean[8]) * len(words)
    kinds = len(np.unique(at))
    sentence = len(words) / ends
    return [*map(float, mean[:11]), float(rarity.mean()), float((rarity > 4).mean()), float(np.log(kinds) / np.log(len(words))), sentence, commas / ends, (commas + inside) / ends, (text.count("?") + text.count("!")) / ends, len(re.findall(r"\d+", text)) / len(words), float(np.log(sentence))]


class Ordinal:
    """Proportional odds with a ridge penalty, fitted by gradient steps with momentum scaled by their past size."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE):
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
        z = self.expand(x)
        k = len(LEVELS) - 1
        share = np.clip([np.mean(y <= v) for v in LEVELS[:-1]], 1e-3, 1 - 1e-3)
        cuts = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(k))
        theta = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3)), np.zeros(z.shape[1])])
        level = np.searchsorted(LEVELS, y)
        momentum = np.zeros_like(theta)
        square = np.zeros_like(theta)
        for step in range(1, 1501):
            g = self.gradient(theta, z, level, ridge)
            momentum = 0.9 * momentum + 0.1 * g
            square = 0.999 * square + 0.001 * g * g
            rate = 0.05 if step < 1000 else 0.01
            theta = theta - rate * (momentum / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        self.cuts, self.w = self.unpack(theta)

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z - 1], 1)

    @staticmethod
    def unpack(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = len(LEVELS) - 1
        return np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:k]))]), theta[k:]

    def gradient(self, theta: np.ndarray, z: np.ndarray, level: np.ndarray, ridge: float) -> np.ndarray:
        k, n = len(LEVELS) - 1, len(z)
        cuts, w = self.unpack(theta)
        score = z @ w
        full = np.concatenate([[-50.0], cuts, [50.0]])
        sig = lambda v: 1 / (1 + np.exp(-np.clip(v, -50, 50)))
        up, low = sig(full[level + 1] - score), sig(full[level] - score)
        p = np.maximum(up - low, 1e-9)
        du, dl = up * (1 - up) / p, low * (1 - low) / p
        g_score = du - dl
        g_cut = np.zeros(k + 2)
        np.add.at(g_cut, level + 1, -du)
        np.add.at(g_cut, level, dl)
        g_cut = g_cut[1:-1]
        tail = np.cumsum(g_cut[::-1])[::-1]
        g_theta = np.concatenate([[g_cut.sum()], tail[1:] * np.exp(theta[1:k])])
        return np.concatenate([g_theta, z.T @ g_score + ridge * w]) / n

    def levels(self, x: np.ndarray) -> np.ndarray:
        score = self.expand(x) @ self.w
        return np.array(LEVELS)[np.searchsorted(self.cuts, score)]


def rarity_of(docs: DataFrame, text: str) -> np.ndarray:
    """Logarithmic rarity of each word bucket over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, classes = np.zeros(BUCKETS + 1, np.int64), Classes()
        for b in batches:
            for t in b.column(0).to_pylist():
                words = set(WORD.findall(t.lower())) if t else ()
                if words:
                    at = classes.of(list(words))
                    np.add.at(total, np.unique(classes.bucket[at]), 1)
                    total[BUCKETS] += 1
        yield pa.RecordBatch.from_arrays([pa.array([int(total[BUCKETS]) % 16], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slot", "part"])

    total = summed(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "slot int, part binary"), (BUCKETS + 1,), "int64")
    return np.log((total[BUCKETS] + 1) / (total[:BUCKETS] + 1)).astype(np.float32)


def with_features(docs: DataFrame, key: str, text: str, idf: np.ndarray, extra: list[str] | None = None) -> DataFrame:
    """Columns key, extra, x for texts that are English prose."""
    extra = extra or []
    kept = docs.sparkSession.sparkContext.broadcast(idf)  # a fixed number of buckets
    schema = T.StructType([*(docs.schema[c] for c in [key, *extra]), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes()
        for b in batches:
            x = pa.array([features(t, classes, kept.value) for t in b.column(0).to_pylist()], pa.list_(pa.float64()))
            keep = x.is_valid()
            yield pa.RecordBatch.from_arrays([*(c.filter(keep) for c in b.columns[1:]), x.filter(keep)], names=[key, *extra, "x"])

    return docs.select(F.col(text).cast("string").alias("_text"), key, *extra).mapInArrow(run, schema)


def fitted(labelled: DataFrame, level: str, most: int = MOST_LABELS) -> Ordinal | None:
    """The model of at most so many ratings, those of least hash."""
    rows = labelled.where(F.col(level).between(LEVELS[0], LEVELS[-1])).orderBy(F.xxhash64("x", level), "x").limit(most).select("x", level).collect()
    y = np.array([r[1] for r in rows])
    return Ordinal(np.array([r[0] for r in rows]), y) if len(set(y.tolist())) > 1 else None


def reading_levels(docs: DataFrame, labels: DataFrame, *, key: str, text: str, level: str) -> DataFrame:
    """Columns key, level of every text of English prose."""
    idf = rarity_of(docs, text)
    # The ratings that the model is fitted to, at most MOST_LABELS, are chosen before the join, so they go to the documents and no text moves.
    rated = labels.select(key, level).where(f"{key} is not null").where(F.col(level).between(LEVELS[0], LEVELS[-1])).orderBy(F.xxhash64(key, level), key, level).limit(MOST_LABELS)
    labelled = with_features(docs.select(key, text).join(F.broadcast(rated), key), key, text, idf, [level])
    model = fitted(labelled, level)
    schema = T.StructType([docs.schema[key], T.StructField(level, T.IntegerType())])
    if model is None:
        return docs.sparkSession.createDataFrame([], schema)
    kept = docs.sparkSession.sparkContext.broadcast((model, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, idf = kept.value
        classes = Classes()
        for b in batches:
            x = [features(t, classes, idf) for t in b.column(1).to_pylist()]
            keep = pa.array([v is not None for v in x])
            found = model.levels(np.array([v for v in x if v is not None])) if any(v is not None for v in x) else []
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), pa.array(found, pa.int32())], names=[key, level])

    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)
