"""Native string expressions shared by the operators (all JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def js_trim(col) -> Column:
    """Strip leading/trailing Unicode whitespace (JavaScript ``trim``)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def collapse_ws(col) -> Column:
    """``s.replace(/\\s+/g, ' ').trim()`` with Unicode whitespace."""
    return js_trim(F.regexp_replace(_c(col), r"(?U)\s+", " "))


def word_count(col) -> Column:
    """Number of non-empty whitespace-separated tokens."""
    return F.size(F.filter(F.split(_c(col), r"(?U)\s+"), lambda x: x != "")).cast("int")


def monitor_normalise(col) -> Column:
    """CRLF to LF, runs of spaces/tabs to one space, 3+ newlines to two, trim."""
    c = F.regexp_replace(_c(col), "\r\n", "\n")
    c = F.regexp_replace(c, "[ \t]+", " ")
    c = F.regexp_replace(c, "\n{3,}", "\n\n")
    return js_trim(c)


def iso_ts(col) -> Column:
    """Timestamp rendered like JavaScript ``toISOString`` (UTC session)."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
