"""Pattern rules with evidence, confidence ladders, ordered tiers and first-match routes, expanded to literal column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EVIDENCE = "struct<field:string,pattern:string,matched_text:string>"


def first_match(fields: Mapping[str, Column], pattern: str) -> Column:
    """Evidence of the first field, in order, that the pattern hits without regard to case; null without a hit."""
    return F.coalesce(*(F.when(x.rlike(f"(?iu){pattern}"), F.struct(F.lit(name).alias("field"), F.lit(pattern).alias("pattern"), F.regexp_extract(x, f"(?iu)({pattern})", 1).alias("matched_text"))) for name, x in fields.items()))


def first_matches(fields: Mapping[str, Column], patterns: Sequence[str]) -> Column:
    """Evidence of each pattern that hits. One alternation is tried first, so most rows try no single pattern."""
    every = "(?iu)" + "|".join(f"(?:{p})" for p in patterns)
    any_hit = F.lit(False)
    for x in fields.values():
        any_hit = any_hit | F.coalesce(x.rlike(every), F.lit(False))
    found = F.array_compact(F.array(*(first_match(fields, p) for p in patterns)))
    return F.when(any_hit, found).otherwise(F.array().cast(f"array<{EVIDENCE}>"))


def confidence(precise: Column, supporting: Column, context: Column) -> Column:
    """confirmed: precise evidence in the title; probable: precise elsewhere, or support in its context; uncertain: support alone; else none."""
    return (
        F.when(F.exists(precise, lambda e: e["field"] == "title"), "confirmed")
        .when((F.size(precise) > 0) | ((F.size(supporting) > 0) & (F.size(context) > 0)), "probable")
        .when(F.size(supporting) > 0, "uncertain")
        .otherwise("none")
    )


def tier_of(name: Column, tiers: Sequence[tuple[str, Sequence[str]]], raw: Column, default: str = "unresolved", least: int = 7) -> Column:
    """First tier, in order, with an entry that equals the normalised name, or that a name marked as cut off (an ellipsis or & at its end) begins."""
    cut = (raw.contains("…") | raw.contains("...") | F.rtrim(raw).endswith("&")) & (F.length(name) >= least)
    out = None
    for tier, entries in tiers:
        hit = F.lit(False)
        for e in entries:
            hit = hit | (name == e) | (cut & F.lit(e).startswith(name))
        out = F.when(hit, tier) if out is None else out.when(hit, tier)
    return F.lit(default) if out is None else out.otherwise(default)


def route(branches: Sequence[tuple[Column, str, str]], default: tuple[str, str]) -> Column:
    """Struct (route, reason) of the first branch whose condition holds."""
    pair = lambda r, why: F.struct(F.lit(r).alias("route"), F.lit(why).alias("reason"))
    out = None
    for condition, r, why in branches:
        out = F.when(condition, pair(r, why)) if out is None else out.when(condition, pair(r, why))
    return pair(*default) if out is None else out.otherwise(pair(*default))


def tags(rules: Mapping[str, Column]) -> Column:
    """Sorted distinct names of the rules that hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(c, F.lit(t)) for t, c in rules.items())))))
