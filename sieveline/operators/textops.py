"""Windows over texts and intervals: islands, running budgets, evidence sentences, inverted indexes, fuzzy matches."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

#: Words that the rarest ones must share, classes that characters are counted in, and different texts of a block of pairs, about.
SHARED, LETTERS, ROWS_A, ROWS_B = 3, 32, 20_000, 100_000


def islands(rows: DataFrame, group: str, start: str, end: str, width: int = 7 * 86400) -> DataFrame:
    """Overlapping or touching intervals of a group merged: first within stretches of start of the given width, so that a hot group is spread over tasks, then what is left across them."""

    def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(start, end)
        reach = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
        marked = parts.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)).withColumn("_island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
        return marked.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n").alias("n")).drop("_island")

    near = rows.select(group, start, end, F.lit(1).cast("bigint").alias("n"), F.floor(F.col(start) / width).alias("_stretch"))
    return merged(merged(near, [group, "_stretch"]).drop("_stretch"), [group])


def within_budget(rows: DataFrame, group: str, order: str, text: str, budget: int, gap: int = 2) -> DataFrame:
    """The texts of a group, in order, until so many characters are used; the last is cut, each costs gap more."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.length(text) + gap).over(w), F.lit(0))
    return rows.withColumn("used", used).where(F.col("used") < budget).withColumn(text, F.left(F.col(text), F.lit(budget) - F.col("used")))


def evidence_sentences(sentences: Column, pattern: str) -> Column:
    return F.array_distinct(F.filter(sentences, lambda s: s.rlike(f"(?i){pattern}")))


def inverted_index(rows: DataFrame, keys: Column, id_: str, block: int = 65_536) -> DataFrame:
    """Each key with the sorted ids of its rows, in blocks of neighbouring ids, so that a frequent key is many rows of bounded size."""
    each = rows.select(F.col(id_).alias("id"), F.explode(keys).alias("key"), F.floor(F.col(id_) / block).cast("bigint").alias("block"))
    return each.groupBy("key", "block").agg(F.array_sort(F.collect_set("id")).alias("ids"))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks; 0 where either is blank."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)])


def alike_pairs(ta: list[str], tb: list[str], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that share at least half of the words of the longer text, and whose ratio of matching blocks can be least by their lengths and characters.

    Prefix filter by inverted lists: of n words the n - ceil(n / 2) + SHARED rarest are listed, of which both must have SHARED (all they share, if that is less); what does is counted whole.
    """
    known: dict[str, int] = {}
    words = [[known.setdefault(w, len(known)) for w in dict.fromkeys(t.split(" ")) if w] for t in (*ta, *tb)]
    sizes = np.array([len(w) for w in words])
    ids = np.array([i for w in words for i in w], np.int64)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(np.bincount(ids, minlength=len(known)), kind="stable")] = np.arange(len(known))
    row, ids = np.repeat(np.arange(len(words)), sizes), rank[ids]
    order = np.lexsort((ids, row))
    ids, start = ids[order], np.concatenate([[0], np.cumsum(sizes)])
    half = -(-sizes // 2)
    prefix = np.minimum(sizes, sizes - half + SHARED)
    listed = np.flatnonzero((row >= len(ta)) & (np.arange(len(ids)) - start[row] < prefix[row]))
    by_word = listed[np.argsort(ids[listed], kind="stable")]
    entries, ends = row[by_word] - len(ta), np.searchsorted(ids[by_word], np.arange(len(known) + 1))
    lengths = np.array([len(t) for t in (*ta, *tb)])
    letters = np.zeros((len(words), LETTERS), np.int32)
    for i, t in enumerate((*ta, *tb)):
        letters[i] = np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) % LETTERS, minlength=LETTERS)
    mine = np.zeros(len(known), bool)
    left, right = [], []
    for i in range(len(ta)):
        own = ids[start[i] : start[i + 1]]
        lists = [entries[ends[w] : ends[w + 1]] for w in own[: prefix[i]]]
        if not sum(map(len, lists)):
            continue
        met = np.flatnonzero(np.bincount(np.concatenate(lists)) >= min(SHARED, half[i]))
        other = met + len(ta)
        both = lengths[i] + lengths[other]
        fits = 2 * np.minimum(lengths[i], lengths[other]) >= (least - 1e-9) * both
        met, other, both = met[fits], other[fits], both[fits]
        fits = 2 * np.minimum(letters[i], letters[other]).sum(1) >= (least - 1e-9) * both
        met, other = met[fits], other[fits]
        if not len(met):
            continue
        n = sizes[other]
        first = np.cumsum(n) - n
        mine[own] = True
        shared = np.add.reduceat(mine[ids[np.repeat(start[other] - first, n) + np.arange(n.sum())]].astype(np.int64), first)
        mine[own] = False
        met = met[shared * 2 >= np.maximum(sizes[i], n)]
        left.append(np.full(len(met), i)), right.append(met)
    return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (left, right))


def sharing_words(a: DataFrame, b: DataFrame, ta: str, tb: str, on: list[str], least: float = 0.0) -> DataFrame:
    """All pairs of a and b, equal in on, whose texts share at least half of the words of the longer one; without those whose ratio is under least, as far as lengths and characters tell it.

    The different texts of a value of on are met in blocks of about ROWS_A by ROWS_B, so that neither a task nor its memory grows with a frequent value."""
    x, y = (f.select(t, *on).dropna().distinct() for f, t in ((a, ta), (b, tb)))
    blocks = x.groupBy(*on).agg(F.ceil(F.count("*") / ROWS_A).cast("int").alias("_na")).join(y.groupBy(*on).agg(F.ceil(F.count("*") / ROWS_B).cast("int").alias("_nb")), on)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = x.join(blocks, on).select(ta, *on, F.pmod(F.xxhash64(ta), F.col("_na")).cast("int").alias("_a"), every("_nb").alias("_b"))
    y = y.join(blocks, on).select(tb, *(F.col(c).alias(f"_{c}") for c in on), every("_na").alias("_ya"), F.pmod(F.xxhash64(tb), F.col("_nb")).cast("int").alias("_yb"))
    schema = T.StructType([x.schema[ta], y.schema[tb], *(x.schema[c] for c in on)])

    def run(p: pa.Table, q: pa.Table) -> pa.Table:
        i, j = alike_pairs(p.column(ta).to_pylist(), q.column(tb).to_pylist(), least)
        return pa.table([p.column(ta).take(i), q.column(tb).take(j), *(p.column(c).take(i) for c in on)], names=[ta, tb, *on])

    met = x.groupBy(*on, "_a", "_b").cogroup(y.groupBy(*(f"_{c}" for c in on), "_ya", "_yb")).applyInArrow(run, schema)
    return met.join(a, [ta, *on]).join(b, [tb, *on])


def best_match(candidates: DataFrame, key: str, ratio: Column, bonus: Column, least: float, margin: float) -> DataFrame:
    """The best candidate of each key by ratio plus bonus, if its ratio is high enough and not too near that of the second."""
    scored = candidates.withColumn("_ratio", ratio)
    w = W.partitionBy(key).orderBy(F.desc(F.col("_ratio") + bonus), "candidate")
    top = scored.withColumn("_second", F.lead("_ratio").over(w)).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return top.where((F.col("_ratio") >= least) & (F.col("_second").isNull() | (F.col("_ratio") - F.col("_second") >= margin))).drop("_second", "_n").withColumnRenamed("_ratio", "ratio")


def agreement(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Whether all values of a group are equal and present."""
    return rows.groupBy(group).agg(F.min(value).eqNullSafe(F.max(value)).alias("same"), F.count_if(F.col(value).isNull()).alias("missing"), F.count("*").alias("n")).select(group, (F.col("same") & (F.col("missing") == 0)).alias("agree"), "n")
