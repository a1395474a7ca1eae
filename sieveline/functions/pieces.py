"""Pieces of texts, flags and shapes, as column expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flags(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that hold, in their order; a null condition doesn't hold."""
    return F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))


def excerpt(text: Column, word: str, width: int) -> Column:
    """So many characters on both sides of the first mention of a word, spaces collapsed."""
    at = F.instr(text, word)
    before = F.least(at - 1, F.lit(width))
    return F.regexp_replace(F.substring(text, at - before, before + len(word) + width), r"\s+", " ")


def between(text: Column, first: str, last: str) -> Column:
    """What stands after the first occurrence of one marker and before the next of the other; to the end of the text without the other, empty without the one."""
    rest = F.when(F.instr(text, first) > 0, F.substring_index(F.substring(text, F.instr(text, first) + len(first), F.length(text)), first, 1)).otherwise(F.when(text.isNotNull(), F.lit("")))
    return F.substring_index(rest, last, 1)


def sorted_entries(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def email_address(x: Column) -> Column:
    """The address in angle brackets, or the whole text, in lower case; null unless it has the structure of one."""
    a = F.lower(F.trim(F.when(x.rlike("<[^<>]*>"), F.regexp_extract(x, "<([^<>]*)>", 1)).otherwise(x)))
    return F.when(a.rlike(r"^[^@\s<>]+@[^@\s<>]+\.[^@\s<>.]+$"), a)


def as_list(x: Column, blank: list[str]) -> Column:
    return F.when(x.isNull() | F.trim(x).isin(blank), F.array().cast("array<string>")).otherwise(F.array(x))


def quantities(text: Column, pattern: str) -> Column:
    """Numbers with units, in one spelling: no spaces, % for percent, ~ before approximations."""
    plain = lambda t: F.replace(F.replace(F.trim(t), F.lit("approximately "), F.lit("~")), F.lit("about "), F.lit("~"))
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda t: F.replace(F.regexp_replace(plain(t), " ?percent", "%"), F.lit(" "), F.lit("")))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("value", T.StringType())])))
def leaves(x: pd.Series) -> pd.Series:
    """Every string leaf of a JSON text with its path, at any depth; text after the value is ignored, and what is no JSON has none. The one walk that has no built-in."""

    def walk(value, path: str, out: list) -> list:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(v, f"{path}.{k}" if path else k, out)
        elif isinstance(value, list):
            for i, v in enumerate(value):
                walk(v, f"{path}[{i}]", out)
        elif isinstance(value, str):
            out.append({"path": path, "value": value})
        return out

    def of(text: str | None) -> list | None:
        if text is None:
            return None
        try:
            return walk(json.JSONDecoder().raw_decode(text.lstrip())[0], "", [])
        except ValueError:
            return []

    return x.map(of)


@F.pandas_udf(T.StringType())
def json_prefix(x: pd.Series) -> pd.Series:
    """The JSON value that a text begins with, without what stands after it; null where it begins with none."""

    def of(text: str | None) -> str | None:
        try:
            return None if text is None else text.lstrip()[: json.JSONDecoder().raw_decode(text.lstrip())[1]]
        except ValueError:
            return None

    return x.map(of)
