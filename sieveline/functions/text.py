"""Normalising projections and other scalar text functions, as column expressions.

Patterns avoid look-behind and Unicode classes that differ between engines; where Python's meaning of white space or word is needed, see nfkc().
"""

from __future__ import annotations

import html
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkc(x: pd.Series) -> pd.Series:
    """Compatibility form; the one Unicode normalisation that has no built-in."""
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


@F.pandas_udf(T.StringType())
def unescaped(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else html.unescape(s))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def _plain(s: str | None) -> str | None:
    if s is None:
        return None
    p = _Text()
    p.feed(s)
    p.close()
    return " ".join(" ".join(p.parts).split()) or None


@F.pandas_udf(T.StringType())
def plain_text(x: pd.Series) -> pd.Series:
    """Markup and entities removed, white space collapsed, empty to null."""
    return x.map(_plain)


def collapsed(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def matchable(x: Column) -> Column:
    """Lower case, one kind of dash, single spaces."""
    return collapsed(F.translate(F.lower(x), "–—−", "---"))


def unpunctuated(x: Column) -> Column:
    """As matchable, with punctuation as spaces."""
    return collapsed(F.regexp_replace(matchable(x), r"[^\p{L}\p{N}_\s]", " "))


def clean_title(x: Column) -> Column:
    """Leading format tags dropped."""
    return collapsed(F.regexp_replace(x, r"(?i)^\s*(\[(pdf|html|citation|book|doc)\]\s*)+", ""))


def normal_title(x: Column) -> Column:
    """Key of a title: no leading year, punctuation as spaces."""
    return unpunctuated(F.regexp_replace(F.trim(F.lower(x)), r"^(19|20)[0-9]{2}\s*[-_:]\s*", ""))


def normal_venue(x: Column) -> Column:
    return collapsed(F.regexp_replace(F.regexp_replace(matchable(x), r"…|\.\.\.|&", " "), r"[^a-z0-9]+", " "))


def doi_key(x: Column) -> Column:
    """Resolver prefix, label and closing punctuation dropped, lower case; empty to null."""
    bare = F.regexp_replace(F.lower(F.trim(x)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return F.nullif(F.regexp_replace(bare, r"[.,;:)\]}]+$", ""), F.lit(""))


def strict_doi(x: Column) -> Column:
    """The DOI with its case kept, of a resolver URL, a label or a bare value; null unless it is whole."""
    bare = F.regexp_replace(F.trim(x), r"^(?i)(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return F.when(bare.rlike(r"^10\.[0-9]{4,9}/[^\s]+$"), bare)


def cut_doi(x: Column) -> Column:
    """Closing punctuation, then one page suffix after another dropped."""
    out = F.regexp_replace(x, r"[.,;:)\]}]+$", "")
    for suffix in ("short", "abstract", "full", "pdf"):
        out = F.regexp_replace(out, rf"(?i)\.{suffix}$", "")
    return out


def clean_url(x: Column) -> Column:
    """Only http(s); tracking parameters and the fragment dropped."""
    base, query = F.substring_index(F.substring_index(x, "#", 1), "?", 1), F.regexp_extract(F.substring_index(x, "#", 1), r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ved|usg|sa|ei)=")), "&")
    return F.when(x.rlike(r"^https?://"), F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept)))


def unwrapped_url(x: Column) -> Column:
    """The target in a redirect's url parameter, decoded twice; + is kept in the second decoding. Without parameter the link itself."""
    inner = F.try_url_decode(F.regexp_extract(x, r"[?&]url=([^&#]*)", 1))
    twice = F.coalesce(F.try_url_decode(F.replace(inner, F.lit("+"), F.lit("%2B"))), inner)
    return clean_url(F.when(x.rlike(r"[?&]url="), twice).otherwise(x))


def host(x: Column) -> Column:
    return F.lower(F.regexp_extract(x, r"^https?://([^/?#:]+)", 1))


def host_in(h: Column, suffixes: list[str]) -> Column:
    """Whether a host is one of the suffixes or below it."""
    out = F.lit(False)
    for s in suffixes:
        out = out | (h == s) | h.endswith(f".{s}")
    return out


def last_segment(x: Column) -> Column:
    return F.element_at(F.split(F.rtrim(x, F.lit("/")), "/"), -1)


def author_key(name: Column) -> Column:
    """Letters and digits of the last word of a name."""
    return F.nullif(F.regexp_replace(F.element_at(F.split(F.trim(F.lower(name)), r"\s+"), -1), r"[^\p{L}\p{N}]", ""), F.lit(""))


def safe_year(x: Column) -> Column:
    return x.try_cast("int")


def metadata_line(names: Column, venue: Column, year: Column, most: int = 8) -> Column:
    """'names - venue, year', without what is missing."""
    people = F.array_join(F.filter(F.slice(names, 1, most), lambda n: n.isNotNull() & (F.trim(n) != "")), ", ")
    place = F.array_join(F.filter(F.array(F.nullif(F.trim(venue), F.lit("")), year.cast("string")), lambda v: v.isNotNull()), ", ")
    return F.array_join(F.filter(F.array(people, place), lambda v: v != ""), " - ")


def split_metadata(line: Column) -> dict[str, Column]:
    """Names, venue and year of a 'names - venue, year' line: split at the last dash, the last year wins, a terminal year leaves the venue."""
    left = F.regexp_extract(line, r"^(.*) [-–] (.*)$", 1)
    right = F.regexp_extract(line, r"^(.*) [-–] (.*)$", 2)
    years = F.regexp_extract_all(right, F.lit(r"\b((?:19|20)[0-9]{2})\b"), 1)
    return {
        "names": F.transform(F.split(F.regexp_replace(left, r"…$", ""), r",\s*"), lambda n: F.trim(n)),
        "venue": F.nullif(F.regexp_replace(F.trim(F.regexp_replace(right, r",?\s*(19|20)[0-9]{2}\s*$", "")), r",$", ""), F.lit("")),
        "year": F.when(F.size(years) > 0, F.element_at(years, -1).try_cast("int")),
    }


def han_count(x: Column) -> Column:
    return F.length(F.regexp_replace(x, "[^㐀-䶿一-鿿]", ""))


def sentences(x: Column) -> Column:
    return F.filter(F.split(x, r"(?<=[.!?])\s+"), lambda s: s != "")


def numbers(x: Column) -> Column:
    """Numbers of a text as doubles, in order; the Unicode minus counts."""
    return F.transform(F.regexp_extract_all(F.translate(x, "−", "-"), F.lit(r"(-?[0-9]+(?:\.[0-9]+)?)"), 1), lambda n: n.try_cast("double"))


def unsupported_numbers(text: Column, source: Column) -> Column:
    """Numbers of text that no number of source is near, within 2 percent or 0.02."""
    return F.filter(numbers(text), lambda o: ~F.exists(numbers(source), lambda s: F.abs(o - s) <= F.greatest(F.lit(0.02), F.abs(s) * 0.02)))


def first_wins(items: Column) -> Column:
    """Distinct, without regard to case, the first spelling of each."""
    return F.aggregate(items, F.array().cast("array<string>"), lambda acc, x: F.when(x.isNull() | F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))


def inverted_text(index: Column) -> Column:
    """Text of a map from word to positions."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word")))))
    return F.array_join(F.transform(F.array_sort(placed), lambda s: s["word"]), " ")


def record_id(*parts: Column) -> Column:
    """24 hex digits of the SHA-256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 24)


def fingerprint(title: Column, year: Column, venue: Column) -> Column:
    """SHA-256 of title|year|venue, nulls as empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(x.cast("string"), F.lit("")) for x in (title, year, venue))), 256)
