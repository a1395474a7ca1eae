"""Texts that lost their end: a completeness check with a stack automaton, against the baseline of each source.

The automaton reads the marks of a text (quotes, brackets, tags, entities, escapes, broken bytes) and keeps a stack of what is
open; strong evidence of a lost end is an ellipsis at the end, something open that the last words began, half an entity, tag or escape, or a
broken multibyte sequence at the end. Weak evidence is a missing terminator. What ends a value depends on the field: prose ends
in sentence punctuation, closers, a citation, a full list of keywords or a full identifier; titles end in words that end titles of this corpus; metadata
lines end in their year or in their full venue. Weak evidence counts where the source's values of that field mostly have terminators.

Cases: null, blank and placeholder values are never cases; an ellipsis inside a value that is complete at its end is none;
white space after the end doesn't count; very long texts are read whole; repeated rows give one row; any number of extra columns is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.canonical import fold
from sieveline.llm.names import near
from sieveline.runtime import stored

FIELDS = ("title", "snippet", "raw_metadata_line")
#: Texts that stand for a missing value.
PLACEHOLDERS = {"-", "n/a", "none", "null", "untitled", "untitled document", "full text", "view article", "no abstract available", "no abstract", "abstract not available", "[pdf] untitled document"}
#: Words that end at least this share of all titles, and end titles in at least this share of their occurrences, end titles.
END_SHARE, END_RATE = 0.0008, 0.025
#: A source's values of a field have terminators if this share of them has.
BASELINE = 0.5

OK, WEAK, STRONG = 0, 1, 2
TOKENS = re.compile(r"<[a-zA-Z/!][^<>]*>|<(?=[a-zA-Z/!])[^<>]*$|&#?\w{1,8};|[()\[\]{}“”\"]")
ELLIPSIS = re.compile(r"(…|\.\.\.|\[\.\.\.\]|\[…\])$")
HALF = re.compile(r"(&#?\w{0,8}|<[a-zA-Z/!][^<>]*|<|\\u[0-9a-fA-F]{0,3}|\\x[0-9a-fA-F]?|\\|%[0-9a-fA-F]?|�|[\xc3\xc2\xe2]|\xe2€)$")
PROSE_END = re.compile(r"([.!?。！？؟।]|\.\)|</\w+>)[)\]\"'”’»」]*(\s*\[\d+(,\s*\d+)*\])?$")
KEYWORDS = re.compile(r"\bKeywords: [^.]*$", re.I)
IDENTIFIER = re.compile(r"\bdoi:\s*10\.\d{4,9}/\S+$", re.I)
YEAR_END = re.compile(r"(?:^|[^\d])(?:19|20)\d\d$")
PART_END = re.compile(r"\b(?:volume|vol\.?|part|no\.?|number|chapter)\s+(?:\d+|[ivxlc]+)$", re.I)
WORD = re.compile(r"[\w'’-]+")


#: Ends that look like the end of a sentence: an abbreviation, a number whose decimals may be missing.
FALSE_END = re.compile(r"(\b(fig|cf|vs|approx|al|eq|sec)|(?<!fig\. )\b\d+)\.$", re.I)
#: Between sentences.
SENTENCE = re.compile(r"[.!?。！？][)\]\"'”’»]*\s+(?=[^\W\d_a-z]|[\"'“‘«(\[<])|[。！？]")
#: UTF-8 read as Latin: its quotation marks aren't quotation marks.
MISREAD = re.compile(r"â€.")


def open_at_end(text: str) -> bool:
    """Whether a bracket, tag or quote is still open at the end that the last sentence opened: one that a sentence left open before is a habit of its text, not a lost end."""
    stack: list[tuple[str, int]] = []
    if "â€" in text:
        text = MISREAD.sub("---", text)
    closers = {")": "(", "]": "[", "}": "{", "”": "“"}
    for m in TOKENS.finditer(text):
        t = m.group()
        if t in "([{“":
            stack.append((t, m.start()))
        elif t in closers:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == closers[t]:
                    del stack[i:]
                    break
        elif t == '"':
            if any(s == '"' for s, _ in stack):
                while stack.pop()[0] != '"':
                    pass
            else:
                stack.append((t, m.start()))
    last = max((m.end() for m in SENTENCE.finditer(text)), default=0)
    return any(at >= last for _, at in stack)


def judge(field: str, value: str | None, venue: str | None, ends: set[str], keywords: int) -> int | None:
    """OK, WEAK or STRONG evidence that the end is lost; None for values without content."""
    text = (value or "").rstrip()
    bare = text.strip()
    if not bare or bare.lower().rstrip(".") in PLACEHOLDERS or bare.lower() in PLACEHOLDERS:
        return None
    if ELLIPSIS.search(text) or HALF.search(text):
        return STRONG
    if field == "snippet":
        if PROSE_END.search(text):
            return WEAK if FALSE_END.search(text) else OK
        if m := KEYWORDS.search(text):
            words = [w.strip() for w in m.group()[9:].split(",")]
            return OK if len(words) >= keywords and words[-1].lower() in ends else WEAK
        if m := IDENTIFIER.search(text):
            return OK if len(m.group().rpartition("/")[2]) >= 8 else WEAK
        return STRONG if open_at_end(text) else WEAK
    if field == "title":
        if PART_END.search(text):
            return OK
        if open_at_end(text):
            return STRONG
        words = WORD.findall(text.rstrip(")]\"'”’.?! ").lower())
        last = words[-1] if words else ""
        if last in ends or len(last) > 18 and any(last.endswith(x) for x in ends):  # titles whose spaces are lost
            return OK
        return WEAK
    if YEAR_END.search(text):
        return OK
    shown, full = fold(text), fold(venue or "")
    if full and not ELLIPSIS.search((venue or "").rstrip()) and (shown.endswith(full) or near(shown[-len(full) :], full, 1)):
        return OK
    return STRONG if open_at_end(text) else WEAK


def ending_words(rows: DataFrame, field: str) -> set[str]:
    """Words that end titles in this corpus. As each ends at least END_SHARE of all, there are at most 1 / END_SHARE of them."""
    words = F.filter(F.split(F.lower(F.regexp_replace(field, r"[^\p{L}\p{N}'’-]+", " ")), " "), lambda w: w != "")
    each = rows.select(words.alias("w")).where(F.size("w") > 1)
    counted = each.select(F.posexplode("w").alias("i", "word"), F.size("w").alias("n")).groupBy("word").agg(F.count("*").alias("all"), F.count_if(F.col("i") == F.col("n") - 1).alias("last")).where("last > 0")
    total = each.count()
    return {r.word for r in counted.where((F.col("last") >= END_SHARE * total) & (F.col("last") >= END_RATE * F.col("all"))).select("word").collect()}


def judged(rows: DataFrame, seq: str, source: str, values: dict[str, str], venue: str, ends: set[str]) -> DataFrame:
    """Columns seq, source, field, evidence: a row for each value that has content. values: the column or path of each field."""
    names = list(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, sources, venues = (batch.column(i).to_pylist() for i in range(3))
            out: tuple[list, list, list, list] = ([], [], [], [])
            for k, field in enumerate(names):
                for s, source, venue, value in zip(seqs, sources, venues, batch.column(3 + k).to_pylist()):
                    found = judge(field, value, venue, ends, 3)
                    if found is not None:
                        for column, x in zip(out, (s, source, field, found)):
                            column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.string(), pa.string(), pa.int32()))], names=["seq", "source", "field", "evidence"])

    picked = rows.select(F.col(seq).cast("bigint").alias("seq"), F.col(source).alias("source"), F.col(venue).alias("venue"), *(F.col(path).alias(f"f{i}") for i, path in enumerate(values.values())))
    return picked.mapInArrow(run, "seq bigint, source string, field string, evidence int")


def truncated(rows: DataFrame, *, seq: str, source: str, title: str = "title", snippet: str = "snippet", metadata: str = "raw_metadata_line", venue: str = "venue.raw", ends: set[str] | None = None) -> DataFrame:
    """Columns seq, source, field, evidence and lost of every value with content."""
    ends = ending_words(rows, title) if ends is None else ends
    each = stored(judged(rows, seq, source, {"title": title, "snippet": snippet, "raw_metadata_line": metadata}, venue, ends), "judged")
    base = each.groupBy("source", "field").agg(F.avg((F.col("evidence") == OK).cast("double")).alias("ended")).where(F.col("ended") >= BASELINE)
    # One source may send a third of all rows: the weak rows are spread over 16 copies of the baseline.
    weak = each.where(F.col("evidence") == WEAK).withColumn("part", F.pmod(F.xxhash64("seq"), F.lit(16)).cast("int"))
    copies = base.select(F.coalesce("source", F.lit("\0")).alias("source_"), F.col("field").alias("field_"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("part_"))
    ended = (F.coalesce("source", F.lit("\0")) == F.col("source_")) & (F.col("field") == F.col("field_")) & (F.col("part") == F.col("part_"))
    judgedweak = weak.join(copies, ended, "left").select("seq", "source", "field", "evidence", F.col("source_").isNotNull().alias("lost"))
    return each.where(F.col("evidence") != WEAK).select("seq", "source", "field", "evidence", (F.col("evidence") == STRONG).alias("lost")).unionAll(judgedweak)


def truncation_report(found: DataFrame) -> DataFrame:
    """How often each source truncates, by field."""
    return found.groupBy("source", "field").agg(F.count("*").alias("n_values"), F.count_if("lost").alias("n_truncated")).withColumn("share", F.round(F.col("n_truncated") / F.col("n_values"), 6))
