"""Date expressions. Dates come as text and are never trusted."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"^\s*\d{4}(-\d{1,2}-|/\d{1,2}/)\d{1,2}\s*$"


def safe_date(c: Column) -> Column:
    """Date in the first ten characters of a text, NULL when there is none."""
    head = F.substring(c.cast("string"), 1, 10)
    iso = F.replace(F.trim(head), F.lit("/"), F.lit("-"))
    return F.when(F.rlike(head, F.lit(_DATE)), iso.try_cast("date"))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def utc_text(ts: datetime | None = None) -> str:
    """Naive UTC text of a moment, by default now; fixed once on the driver for a whole run."""
    ts = ts or datetime.now(timezone.utc)
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc)
    return ts.strftime("%Y-%m-%d %H:%M:%S.%f")


def utc_stamp(ts: datetime | None = None) -> Column:
    """The same moment as a timestamp without time zone, whatever the session's zone is."""
    return F.to_timestamp_ntz(F.lit(utc_text(ts)))
