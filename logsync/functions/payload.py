"""Comparing payloads without moving them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_fingerprint(*columns: str) -> Column:
    """64-bit hash of the named columns.

    ``xxhash64`` skips NULLs, so each column's null flag is hashed as well:
    a NULL value and an empty one stay apart, and so do (NULL, x) and (x, NULL).
    """
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)
