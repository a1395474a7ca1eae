"""Encoding a corpus with a public byte-level BPE vocabulary, merges contracted by recursive DuckDB queries.

The vocabulary files are read where they lie on each executor; only their path is passed on. Texts are cut into words by the
vocabulary's own pattern; each distinct word of a partition is encoded once: its bytes are rows (word, position, token) that join the merge
table, and each round contracts the occurrences of a word's lowest-ranked pair, leftmost first, until no pair is left (a query ends after ROUNDS and goes on from what is left). An
ordered aggregation gives the word's ids, and a text's ids are those of its words in order.

Cases: null and empty texts give an empty list; a blank text has the ids of its white space; special tokens in a text are
ordinary text; unpaired surrogates can't occur in Parquet strings; repeated ids give repeated rows; any length is encoded whole.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept encoded per task, and words contracted by one recursive query.
KEPT_WORDS, WORDS_AT_ONCE = 400_000, 4_000
#: Bytes of the words of one query (a longer word has its own), and rounds after which a query starts anew from what is left, so that it never holds more rounds than that.
BYTES_AT_ONCE, ROUNDS = 60_000, 32

CONTRACT = f"""
WITH RECURSIVE t AS (
  SELECT word, pos, tok, 0 AS round FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT t.word, t.pos, t.tok, t.round, lead(t.tok) OVER w AS nxt, row_number() OVER w AS n FROM t WINDOW w AS (PARTITION BY t.word ORDER BY t.pos)
   ), ranked AS (
     SELECT p.*, m.rank, m.merged, min(m.rank) OVER (PARTITION BY p.word) AS least FROM pairs p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt
   ), hits AS (
     SELECT *, coalesce(rank = least, false) AS hit, n - row_number() OVER (PARTITION BY word, coalesce(rank = least, false) ORDER BY n) AS run FROM ranked WHERE least IS NOT NULL AND round < {ROUNDS}
   ), chosen AS (
     SELECT *, hit AND (tok <> nxt OR row_number() OVER (PARTITION BY word, hit, run ORDER BY n) % 2 = 1) AS contract FROM hits
   ), marked AS (
     SELECT *, coalesce(lag(contract) OVER (PARTITION BY word ORDER BY n), false) AS gone FROM chosen
   )
   SELECT word, pos, CASE WHEN contract THEN merged ELSE tok END, round + 1 FROM marked WHERE NOT gone)
)
SELECT word, list(tok ORDER BY pos), any_value(last) FROM (SELECT *, max(round) OVER (PARTITION BY word) AS last FROM t) WHERE round = last GROUP BY word
"""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself where printable, else the next from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """Word-wise encoder of one task; words are contracted in DuckDB and kept."""

    def __init__(self, path: str):
        import duckdb
        import regex

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids = model["vocab"]
        self.words = regex.compile(PATTERN).findall
        self.byte_ids = [ids[x] for x in byte_letters()]
        self.known: dict[str, bytes] = {}  # ids as int32
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merges = pa.table({"a": pa.array([ids[a] for a, _ in pairs], pa.int32()), "b": pa.array([ids[b] for _, b in pairs], pa.int32()), "rank": pa.array(range(len(pairs)), pa.int32()), "merged": pa.array([ids[a + b] for a, b in pairs], pa.int32())})
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.con.register("given", merges)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.con.unregister("given")

    def learn(self, words: list[str]) -> None:
        open_ = [(x, [self.byte_ids[b] for b in x.encode("utf-8", "replace")]) for x in words]
        while open_:
            part: list[tuple[str, list[int]]] = []
            size = 0
            while open_ and (not part or len(part) < WORDS_AT_ONCE and size + len(open_[-1][1]) <= BYTES_AT_ONCE):
                part.append(open_.pop())
                size += len(part[-1][1])
            word, pos, tok = [], [], []
            for k, (_, tokens) in enumerate(part):
                word += [k] * len(tokens)
                pos += range(len(tokens))
                tok += tokens
            self.con.register("start", pa.table({"word": pa.array(word, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(tok, pa.int32())}))
            for k, out, last in self.con.execute(CONTRACT).fetchall():
                if last < ROUNDS:
                    self.known[part[k][0]] = array("i", out).tobytes()
                else:
                    open_.append((part[k][0], out))
            self.con.unregister("start")

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        cut = [self.words(x) if x else [] for x in texts]
        known = self.known
        new = set().union(*cut).difference(known)
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            new = set().union(*cut)
        if new:
            self.learn(sorted(new))
        out = [b"".join(map(known.__getitem__, words)) for words in cut]
        ends = array("i", accumulate(map(len, out), initial=0))
        values = pa.Array.from_buffers(pa.int32(), ends[-1] // 4, [None, pa.py_buffer(b"".join(out))])
        return pa.ListArray.from_arrays(pa.array([x // 4 for x in ends], pa.int32()), values)


ENCODERS: dict[str, Encoder] = {}


def encode_corpus(docs: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, ids: str = "ids") -> DataFrame:
    """Columns key and ids, a row for each row of docs."""
    schema = T.StructType([docs.schema[key], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = ENCODERS.get(vocabulary) or ENCODERS.setdefault(vocabulary, Encoder(vocabulary))
            out = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=[key, ids])

    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
