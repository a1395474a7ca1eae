"""Time columns: RFC-3339 texts as instants, partial dates, local days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?\s*(Z|z|[+-]\d{2}:?\d{2})?$"
ZONE = r"(Z|z|[+-]\d{2}:?\d{2})$"


def instant(text: Column) -> Column:
    """Timestamp of an ISO-8601 text with at least a full date; a text without zone means UTC; null where it can't be read."""
    text = F.trim(text)
    zoned = F.when(text.rlike(r"T.*" + ZONE) | text.rlike(r" \d.*" + ZONE), text).otherwise(F.concat(F.regexp_replace(text, ZONE, ""), F.when(F.length(text) <= 11, F.lit("T00:00:00Z")).otherwise(F.lit("Z"))))
    return F.when(text.rlike(SHAPE), F.try_to_timestamp(zoned))


def sortable_day(date: Column) -> Column:
    """Digits of a partial date filled up to eight, as a number; 0 without a date."""
    return F.coalesce(F.substring(F.rpad(F.regexp_replace(date, r"[^0-9]", ""), 8, "0"), 1, 8).try_cast("int"), F.lit(0))


def partial_date(year: Column, month: Column, day: Column) -> Column:
    """YYYY-MM-DD, degraded to YYYY-MM or YYYY where a part is missing or impossible; null without a year."""
    y, m, d = (x.try_cast("int") for x in (year, month, day))
    ym = F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"))
    full = F.concat(ym, F.lit("-"), F.lpad(d.cast("string"), 2, "0"))
    return F.when(y.between(1, 9999), F.when(m.between(1, 12), F.when(F.try_to_timestamp(full, F.lit("yyyy-MM-dd")).isNotNull() & d.between(1, 31), full).otherwise(ym)).otherwise(F.lpad(y.cast("string"), 4, "0")))


def age_days(date: Column, year: Column, now: Column) -> Column:
    """Whole days since a full date, else since the first day of the year; not below 0; null without either."""
    at = F.coalesce(F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}"), instant(F.substring(date, 1, 10))), F.try_to_timestamp(F.concat(year.cast("string"), F.lit("-01-01")), F.lit("yyyy-MM-dd")))
    return F.when(at.isNotNull(), F.greatest(F.lit(0), F.floor((F.unix_timestamp(now) - F.unix_timestamp(at)) / 86400))).cast("int")


def local_day(at: Column, hours: int = 8) -> Column:
    """Calendar day at a fixed distance from UTC."""
    return F.to_date(at + F.expr(f"INTERVAL {hours} HOURS"))
