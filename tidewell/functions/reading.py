"""Reading rules that the comment tables share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Above this a stamp is in milliseconds.
MILLIS_ABOVE = 100_000_000_000


def reference(col: Column | str) -> Column:
    """A parent or link reference without the case and surrounding blanks that carry no meaning."""
    return F.lower(F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(" \t\r\n")))


def seconds(col: Column | str) -> Column:
    """Epoch seconds of a stamp that may be in milliseconds; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > MILLIS_ABOVE, F.floor(c / F.lit(1000)).cast("bigint")).otherwise(c)


def utc_day(sec: Column) -> Column:
    """The UTC date of epoch seconds as text; independent of the session's time zone."""
    return F.date_add(F.to_date(F.lit("1970-01-01")), F.floor(sec / F.lit(86400)).cast("int")).cast("string")


def known_author(col: Column | str) -> Column:
    """True where an author is given and not deleted."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & ~c.isin("", "[deleted]")
