"""Message headers: ordered (key, value) pairs whose names may repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HEADERS

# Fixed value: the header that carries the source time, nanoseconds since the
# epoch as decimal text.
SOURCE_TIME_HEADER = "_t"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_ns_text(timestamp: Column | str) -> Column:
    """Nanoseconds since the epoch as decimal text bytes; may be negative."""
    return (F.unix_micros(_column(timestamp)) * F.lit(1000)).cast("string").cast("binary")


def header_value(headers: Column | str, name: str, nth: int = 1) -> Column:
    """Value of the nth header called ``name``, NULL when there is none."""
    named = F.filter(_column(headers), lambda header: header["key"] == name)
    return F.try_element_at(named, F.lit(nth))["value"]


def header_text(headers: Column | str, name: str, nth: int = 1) -> Column:
    """``header_value`` read as UTF-8 text."""
    return header_value(headers, name, nth).cast("string")


def append_headers(headers: Column | str, *extra: Column | str) -> Column:
    """All header lists one after the other; a NULL list counts as empty."""
    empty = F.array().cast(HEADERS)
    lists = [F.coalesce(_column(h).cast(HEADERS), empty) for h in (headers, *extra)]
    return F.concat(*lists)


def single_header(name: str, value: Column | str) -> Column:
    """A header list holding one pair."""
    pair = F.struct(F.lit(name).alias("key"), _column(value).cast("binary").alias("value"))
    return F.array(pair).cast(HEADERS)
