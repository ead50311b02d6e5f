"""Message filters: a record passes when every filter allows it.

A filter is a Column, or a function from the ``value`` column to one. Filters
are two-valued: NULL counts as denied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Filter = Column | Callable[[Column], Column]


def _allows(rule: Filter) -> Column:
    condition = rule if isinstance(rule, Column) else rule(F.col("value"))
    return F.coalesce(condition.cast("boolean"), F.lit(False))


def filter_messages(log: DataFrame, filters: Mapping[str, Filter]) -> DataFrame:
    """Records that every filter allows; all of them without filters."""
    if any(isinstance(rule, OpaqueFilter) for rule in filters.values()):
        return log.where(_denied_by(filters).isNull())
    allowed = [_allows(rule) for rule in filters.values()]
    return log.where(reduce(lambda a, b: a & b, allowed, F.lit(True)))


def attribute_filters(log: DataFrame, filters: Mapping[str, Filter]) -> DataFrame:
    """Add ``denied_by``: the first filter, as declared, that denies the record.

    NULL when all allow it. Later filters are not evaluated after a denial;
    opaque ones in a row take one pass of Arrow batches, in which each is asked
    for the records that are still allowed.
    """
    return log.withColumn("denied_by", _denied_by(filters))


def _denied_by(filters: Mapping[str, Filter]) -> Column:
    denied = F.lit(None).cast("string")
    for opaque, group in groupby(filters.items(), lambda item: isinstance(item[1], OpaqueFilter)):
        if opaque:
            denied = F.coalesce(denied, _asked_in_turn(list(group))(F.col("value"), denied.isNull()))
        else:
            for name, rule in group:
                denied = F.coalesce(denied, F.when(~_allows(rule), F.lit(name)))
    return denied


class OpaqueFilter:
    """User code as a filter; called with a column, the boolean it stands for."""

    def __init__(self, rule: Callable[..., Any], config: Mapping[str, Any]) -> None:
        self.rule, self.config = rule, dict(config)

    def __call__(self, value: Column) -> Column:
        return _asked_in_turn([("denied", self)])(value, F.lit(True)).isNull()


def opaque_filter(rule: Callable[..., Any], **config: Any) -> OpaqueFilter:
    """User code as a filter over the value bytes (None for a tombstone).

    ``rule(value, **config)`` returns whether the value may pass. A class is
    built once per task as ``rule(**config)`` and asked through ``is_allowed``.
    Values travel in Arrow batches; a Column filter is faster where one will do.
    """
    return OpaqueFilter(rule, config)


def _asked_in_turn(filters: Sequence[tuple[str, OpaqueFilter]]) -> Callable[[Column, Column], Column]:
    """The first filter that denies a value, or NULL; values not open are not shown to any."""
    # Plain parts only: workers need not have this package.
    rules = [(name, f.rule, isinstance(f.rule, type), f.config) for name, f in filters]

    def decide(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        asked = []
        for name, rule, build_once, config in rules:
            if build_once:
                asked.append((name, rule(**config).is_allowed, {}))
            else:
                asked.append((name, rule, config))
        for values, still in batches:
            denied = []
            for value, is_open in zip(values, still):
                given = None if value is None else bytes(value)
                denied.append(
                    next((name for name, ask, config in asked if not ask(given, **config)), None) if is_open else None
                )
            yield pd.Series(denied, dtype="object")

    return F.pandas_udf(decide, "string")


def filtered_counts(attributed: DataFrame) -> DataFrame:
    """Denied records per filter."""
    return (
        attributed.where(F.col("denied_by").isNotNull())
        .groupBy(F.col("denied_by").alias("filter"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
