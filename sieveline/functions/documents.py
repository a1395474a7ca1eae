"""Sections and windows of documents: HTML by heading levels, JATS by sec elements, windows around keywords, and redaction of unsupported sentences."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.text import numbers, sentences

SECTIONS = T.ArrayType(T.StructType([T.StructField("level", T.IntegerType()), T.StructField("heading", T.StringType()), T.StructField("text", T.StringType())]))
HEADING = re.compile(r"h([1-6])$")


class _Sections(HTMLParser):
    """A section runs from its heading to the next one of the same or a higher level; script and style are no text, unclosed tags end with their section."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.flat: list[list] = []
        self.level = 0
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if m := HEADING.match(tag):
            self.level = int(m[1])
            self.flat.append([self.level, [], []])
        elif tag in ("script", "style"):
            self.hidden += 1

    def handle_endtag(self, tag: str) -> None:
        if HEADING.match(tag):
            self.level = 0
        elif tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)

    def handle_data(self, data: str) -> None:
        if self.flat and not self.hidden and data.strip():
            self.flat[-1][1 if self.level else 2].append(data)


def _squeezed(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


def html_sections_of(page: str | None) -> list[dict]:
    if not page:
        return []
    p = _Sections()
    p.feed(page)
    p.close()
    out = []
    for i, (level, heading, text) in enumerate(p.flat):
        body = list(text)
        for lower, h, t in p.flat[i + 1 :]:
            if lower <= level:
                break
            body += [*h, *t]
        out.append({"level": level, "heading": _squeezed(heading), "text": _squeezed(body)})
    return out


@F.pandas_udf(SECTIONS)
def html_sections(page: pd.Series) -> pd.Series:
    return page.map(html_sections_of)


def jats_sections_of(xml: str | None) -> list[dict]:
    if not xml:
        return []
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return []
    out: list[dict] = []

    def walk(node: ElementTree.Element, level: int) -> None:
        for child in node:
            if child.tag.rpartition("}")[2] == "sec":
                title = next((x for x in child if x.tag.rpartition("}")[2] == "title"), None)
                text = [t for x in child if x is not title for t in x.itertext()]
                out.append({"level": level, "heading": _squeezed(list(title.itertext())) if title is not None else "", "text": _squeezed(text)})
                walk(child, level + 1)
            else:
                walk(child, level)

    walk(root, 1)
    return out


@F.pandas_udf(SECTIONS)
def jats_sections(xml: pd.Series) -> pd.Series:
    """Nested sec elements in document order; a document that can't be parsed has none."""
    return xml.map(jats_sections_of)


def wanted_sections(found: Column, keywords: list[str]) -> Column:
    """Sections whose heading holds one of the keywords."""
    return F.filter(found, lambda s: s["heading"].rlike("(?i)" + "|".join(keywords)))


def keyword_windows(text: Column, pattern: str, before: int, after: int) -> Column:
    """Merged windows of characters around each hit: array<struct<start, end>>, from 0."""
    pieces = F.split(text, f"(?i)(?={pattern})")
    # Where each piece begins is where a hit is, but for a first piece that begins without one.
    starts = F.aggregate(pieces, F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    hits = F.filter(F.slice(starts, 1, F.size(pieces)), lambda s: F.substring(text, s + 1, F.length(text)).rlike(f"^(?i)(?:{pattern})"))
    spans = F.transform(hits, lambda s: F.struct(F.greatest(s - before, F.lit(0)).alias("start"), F.least(s + after, F.length(text)).alias("end")))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def join(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= x["start"]), joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(spans, empty, join)


def redacted(text: Column, source: Column, placeholder: str = "[not supported]") -> Column:
    """Sentences with numbers that the source doesn't support become the placeholder, neighbouring ones one."""
    supported = numbers(source)
    marked = F.transform(sentences(text), lambda s: F.when(F.exists(numbers(s), lambda o: ~F.exists(supported, lambda v: F.abs(o - v) <= F.greatest(F.lit(0.02), F.abs(v) * 0.02))), F.lit(placeholder)).otherwise(s))
    kept = F.aggregate(marked, F.array().cast("array<string>"), lambda acc, s: F.when((s == placeholder) & (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1) == placeholder), acc).otherwise(F.concat(acc, F.array(s))))
    return F.array_join(kept, " ")
