"""One surviving record of each group of duplicates, field by field.

Fields are unpivoted to long rows. Each row votes for its value with the trust in it times a decay of its age; votes are summed per normalised value, max_by chooses the value with
the most, and the fields are pivoted back. The trust in a value is that in its source times that in its state: each sign of damage (cut, misread bytes, markup, lost spaces, changed case,
...) divides it by DAMAGED, and what is fuller has more by a rate that falls with the length. These factors are so strong that no number of copies of a damaged value outvotes an undamaged one;
among values in the same state the source and the age decide. For names from a list (venues), an entry of the list is trusted as much more as an undamaged value.

Cases: null, blank and placeholder values never win over a value; a field that no member has gives no row; members that are not in the
rows are ignored; repeated members vote once; ties go to the smallest sequence number; a time that can't be read counts as NOW; a group of any size is combined
before the shuffle, in steps by value, and no group is ever gathered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.time import instant
from sieveline.llm.canonical import LOOKALIKES, MARK, reference_list
from sieveline.llm.truncation import OK, ending_words, judge

HALF_LIFE_DAYS = 180.0
#: The instant that ages are counted from, unless another is given.
NOW = "2026-01-01T00:00:00Z"
#: Binary logarithms: of what a sign of damage divides trust by, and of what the fullest text has more than an empty one; words at which half of that is reached.
DAMAGED, FULLEST, HALF_FULL = 40.0, 900.0, 120.0
TRUST = {"metadata_verified": 1.0, "doi_extracted": 0.8, "regex_extracted": 0.6}
OTHER_TRUST = 0.5

#: Signs of damage that isn't a lost end; each counts once.
DAMAGE = {
    "misread": re.compile(r"Ã.|Â[\x80-\xbf\s]|â€|â\x80|ï»¿"),
    "broken": re.compile("[�\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"),
    "markup": re.compile(r"</?[a-zA-Z][^<>]*>|&(?:#\d+|#x[0-9a-fA-F]+|[a-zA-Z]{2,8});|\\u[0-9a-fA-F]{4}"),
    "hidden": re.compile("[­​-‏⁠﻿‪-‮]"),
    "joined": re.compile(r"[^\s/]{30,}"),
    "spaced": re.compile(r"(?:\b\w ){6,}|\s{2,}|[\xa0\t\r\n]|^\s|\s$"),
    "hyphenated": re.compile(r"\w-\s*\n\s*\w"),
    "ellipsis": re.compile(r"…|\.\.\."),
    "label": re.compile(r"^\s*\[(?:pdf|html|citation|book|doc)\]", re.I),
}


def damage(field: str, value: str, venue: str | None, ends: set[str]) -> int | None:
    """Number of kinds of damage; None if there is no content."""
    found = judge(field, value, venue, ends, 3)
    if found is None:
        return None
    bad = sum(1 for x in DAMAGE.values() if x.search(value)) + 3 * (found != OK)
    if value != value.translate(LOOKALIKES):
        bad += 1
    if field != "raw_metadata_line" and (value.upper() == value or value.lower() == value):
        bad += 1
    return bad


def judged_values(members: DataFrame, names: set[str], ends: set[str]) -> DataFrame:
    """Long rows: group, field, seq, norm, exact, good (signs of trust less signs of damage), full (words), trust (in the source), at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n).to_pylist() for n in ("venue_normalized", "title", "snippet", "raw_metadata_line", "venue", "status")}
            for field in ("title", "venue_normalized", "snippet", "raw_metadata_line"):
                rows, good, full, trust, norm = [], [], [], [], []
                for row, value in enumerate(column[field]):
                    if value is None or not value.strip():
                        continue
                    if field == "venue_normalized":
                        if value.strip() in ("-", "n/a", "null", "None"):
                            continue
                        status = column["status"][row]
                        g, f, t = (value in names) * 2 + (status == "metadata_verified") - 2 * bool(MARK.search(value)), 0, TRUST.get(status, OTHER_TRUST)
                    else:
                        bad = damage(field, value, column["venue"][row], ends)
                        if bad is None:
                            continue
                        g, f, t = -bad, len(value.split()), OTHER_TRUST
                    rows.append(row), good.append(g), full.append(f), trust.append(t), norm.append(" ".join(value.casefold().split()))
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("group").take(at), pa.array([field] * len(rows), pa.string()), batch.column("seq").take(at), pa.array(norm, pa.string()), batch.column(field).take(at), pa.array(good, pa.int32()), pa.array(full, pa.int32()), pa.array(trust, pa.float64()), batch.column("at").take(at), batch.column("auth").take(at)],
                    names=["group", "field", "seq", "norm", "exact", "good", "full", "trust", "at", "auth"],
                )

    return members.mapInArrow(run, "group bigint, field string, seq bigint, norm string, exact string, good int, full int, trust double, at double, auth double")


def survivors(groups: DataFrame, rows: DataFrame, names: DataFrame, *, group: str, seq: str, name: str = "name", now: str = NOW) -> DataFrame:
    """Columns group, field, seq: the row whose value survives, of each group and field."""
    listed = {n for _, n in reference_list(names.withColumn("_one", F.lit(1)), "_one", name)[0]}
    ends = ending_words(rows, "title")
    day = lambda c: F.unix_timestamp(instant(c)) / 86400.0
    picked = rows.select(
        F.col(seq).cast("bigint").alias("seq"), "title", F.col("venue.normalized").alias("venue_normalized"), "snippet", "raw_metadata_line", F.col("venue.raw").alias("venue"), F.col("venue.verification_status").alias("status"),
        (day(F.col("source.received_at")) - day(F.lit(now))).alias("at"),
        (0.75 + F.when(F.col("source.authentication.dkim") == "pass", 0.25).otherwise(0.0)).alias("auth"),
    )
    members = groups.select(F.col(group).cast("bigint").alias("group"), F.col(seq).cast("bigint").alias("seq")).where("`group` is not null").distinct().join(picked, "seq")
    state = DAMAGED * F.col("good") + FULLEST * F.col("full") / (F.col("full") + HALF_FULL)
    vote = F.pow(F.lit(2.0), state + F.coalesce("at", F.lit(0.0)) / HALF_LIFE_DAYS) * F.col("trust") * F.col("auth")
    long = judged_values(members, listed, ends).withColumn("vote", vote)
    # Combined by exact value (its digest: values may be long), then by normalised value, then by field: hot groups shrink at each step.
    exact = long.groupBy("group", "field", F.md5("norm").alias("norm"), F.md5("exact").alias("exact")).agg(F.min("seq").alias("seq"), F.sum("vote").alias("vote"))
    size = lambda c: F.round(F.log2(c), 6)  # noqa: E731  # sums in another order are equal
    normal = exact.groupBy("group", "field", "norm").agg(F.max_by("seq", F.struct(size(F.col("vote")), -F.col("seq"))).alias("seq"), F.sum("vote").alias("votes"))
    won = normal.groupBy("group", "field").agg(F.max_by("seq", F.struct(size(F.col("votes")), -F.col("seq"))).alias("seq"))
    return won.select(F.col("group").alias(group), "field", F.col("seq").alias(seq))


def merged(groups: DataFrame, rows: DataFrame, names: DataFrame, *, group: str, seq: str, name: str = "name") -> DataFrame:
    """The surviving record of each group: the winners' values pivoted back to one row."""
    won = survivors(groups, rows, names, group=group, seq=seq, name=name)
    values = rows.select(F.col(seq).cast("bigint").alias(seq), "title", F.col("venue.normalized").alias("venue_normalized"), "snippet", "raw_metadata_line")
    value = F.expr("CASE field WHEN 'title' THEN title WHEN 'venue_normalized' THEN venue_normalized WHEN 'snippet' THEN snippet ELSE raw_metadata_line END")
    joined = won.join(values, seq).select(group, "field", value.alias("value"))
    return joined.groupBy(group).pivot("field", ["title", "venue_normalized", "snippet", "raw_metadata_line"]).agg(F.first("value"))
