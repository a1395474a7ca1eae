"""Alert mail: raw base64url messages to structs, and their HTML to result blocks."""

from __future__ import annotations

import base64
import re
from email import message_from_bytes, policy
from email.utils import parsedate_to_datetime
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("message_id", "sender", "subject", "sent_at", "spf", "dkim", "html", "text")])
BLOCK = T.ArrayType(T.StructType([T.StructField("position", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("url", T.StringType()), T.StructField("metadata", T.StringType()), T.StructField("snippet", T.StringType())]))


def _message(raw: str | None) -> tuple | None:
    if raw is None:
        return None
    try:
        mail = message_from_bytes(base64.urlsafe_b64decode(raw + "=" * (-len(raw) % 4)), policy=policy.default)
    except ValueError:
        return None
    bodies = {"text/html": None, "text/plain": None}
    for part in mail.walk():
        kind = part.get_content_type()
        if kind in bodies and bodies[kind] is None and part.get_content_disposition() != "attachment":
            bodies[kind] = part.get_content()
    results = str(mail.get("Authentication-Results", ""))
    verdict = lambda name: (re.search(rf"\b{name}=(\w+)", results) or [None, None])[1]
    try:
        sent = parsedate_to_datetime(str(mail["Date"])).isoformat()
    except (TypeError, ValueError):
        sent = None
    return (mail.get("Message-ID"), mail.get("From"), mail.get("Subject"), sent, verdict("spf"), verdict("dkim"), bodies["text/html"], bodies["text/plain"])


@F.pandas_udf(MESSAGE)
def parsed_message(raw: pd.Series) -> pd.DataFrame:
    """Header fields, authentication verdicts and bodies; attachments are left out."""
    return pd.DataFrame([_message(x) or (None,) * len(MESSAGE) for x in raw], columns=MESSAGE.names)


class _Blocks(HTMLParser):
    """Anchors with enough text begin a block; the text up to the next one is its metadata, to the first line with a year, and its snippet."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.href: str | None = None
        self.words: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self.href, self.words = dict(attrs).get("href"), []

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.href:
            title = " ".join("".join(self.words).split())
            if len(title) >= 12 and "share" not in self.href:
                self.found.append({"title": title, "url": self.href, "parts": []})
            self.href = None

    def handle_data(self, data: str) -> None:
        if self.href:
            self.words.append(data)
        elif self.found and data.strip():
            self.found[-1]["parts"].append(" ".join(data.split()))


def _blocks(html: str | None) -> list[dict]:
    if not html:
        return []
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    out = []
    for i, b in enumerate(parser.found):
        line: list[str] = []
        rest = list(b["parts"])
        while rest and len(line) < 12 and not (line and re.search(r" [-–] .*\b(19|20)\d\d\b|\b(19|20)\d\d$", " ".join(line))):
            line.append(rest.pop(0))
        metadata = " ".join(line)
        if not re.search(r"\b(19|20)\d\d\b", metadata):
            metadata, rest = (line[0] if line else None), [*line[1:], *rest]
        out.append({"position": i, "title": b["title"], "url": b["url"], "metadata": metadata or None, "snippet": " ".join(rest) or None})
    return out


@F.pandas_udf(BLOCK)
def result_blocks(html: pd.Series) -> pd.Series:
    return html.map(_blocks)


def trusted(messages: DataFrame, senders: list[str]) -> DataFrame:
    """Messages of allowed senders with at least one passed check."""
    return messages.where(F.col("sender").isin(senders) & F.coalesce(F.array_contains(F.array_compact(F.array("spf", "dkim")), "pass"), F.lit(False)))
