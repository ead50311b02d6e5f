"""Routing, headers and filters."""

from datetime import datetime, timezone

import pytest
from helpers import pairs
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logsync.functions import append_headers, header_text, payload_fingerprint
from logsync.operators import (
    attribute_filters,
    expect_topic,
    filter_messages,
    filtered_counts,
    local_table,
    opaque_filter,
    relayed_counts,
    route_partition,
    route_topics,
    stamp_source_time,
    to_message,
    validate_routes,
)
from logsync.schemas import CATALOG_SCHEMA, MESSAGE_COLUMNS


def test_unrouted_topics_are_dropped(make_log, make_routes):
    log = make_log(("a", 1, 0, b"k", b"v"), ("b", 0, 0, b"k", b"v"))
    routed = route_topics(log, make_routes(("a", "x", None)))
    assert pairs(routed, "source_topic", "topic", "source_partition") == [("a", "x", 1)]


def test_many_routes_are_looked_up(make_log, make_routes, monkeypatch):
    log = make_log(("a", 1, 0, b"k", b"v"), ("b", 0, 0, b"k", b"v"), ("c", 2, 0, b"k", b"v"))
    routes = make_routes(("a", "x", None), ("c", "y", 5))
    columns = ["source_topic", "topic", "source_partition", "target_partition"]
    few = {tuple(row) for row in route_topics(log, routes).select(*columns).collect()}
    monkeypatch.setattr("logsync.operators.routing.LITERAL_ROWS", 1)
    many = {tuple(row) for row in route_topics(log, routes).select(*columns).collect()}
    assert few == many == {("a", "x", 1, None), ("c", "y", 2, 5)}


def test_partition_modes(make_log, make_routes):
    log = make_log(("a", 5, 0, b"k", b"v"), ("b", 6, 0, b"k", b"v"))
    routed = route_topics(log, make_routes(("a", "x", None), ("b", "x", 2)))
    assert pairs(route_partition(routed), "source_topic", "partition") == [("a", 5), ("b", 2)]
    hashed = route_partition(routed, "auto", 4).collect()
    assert all(0 <= row.partition < 4 for row in hashed)
    open_ended = {r.source_topic: r.partition for r in route_partition(routed, "auto").collect()}
    assert open_ended == {"a": None, "b": 2}
    with pytest.raises(PySparkException):
        route_partition(routed, "pinned").collect()
    with pytest.raises(ValueError):
        route_partition(routed, "elsewhere")


def test_records_without_key_spread(make_log, make_routes):
    log = make_log(*[("a", 0, o, None, b"v") for o in range(64)])
    routed = route_topics(log, make_routes(("a", "x", None)))
    assert len({r.partition for r in route_partition(routed, "auto", 4).collect()}) == 4


def test_same_key_same_partition(make_log, make_routes):
    log = make_log(*[("a", o % 3, o, b"same", b"v") for o in range(12)])
    routed = route_topics(log, make_routes(("a", "x", None)))
    assert len({r.partition for r in route_partition(routed, "auto", 4).collect()}) == 1


def test_stamp_goes_in_front_even_of_another_stamp(make_log):
    log = make_log(("a", 0, 0, b"k", b"v", [("_t", b"old"), ("h", b"1"), ("h", b"2")]))
    row = stamp_source_time(log).select(
        F.transform("headers", lambda h: h["key"]).alias("names"),
        header_text("headers", "_t").alias("stamp"),
        header_text("headers", "_t", 2).alias("old"),
        header_text("headers", "h", 2).alias("second"),
        header_text("headers", "h", 3).alias("third"),
    ).first()
    assert row.names == ["_t", "_t", "h", "h"]
    assert (row.stamp, row.old, row.second, row.third) == ("1704067200000000000", "old", "2", None)


def test_times_before_the_epoch_are_negative(make_log):
    before = datetime(1969, 12, 31, 23, 59, 59, tzinfo=timezone.utc)
    log = make_log(("a", 0, 0, b"k", b"v", [], before))
    assert stamp_source_time(log).select(header_text("headers", "_t")).first()[0] == "-1000000000"


def test_null_headers_key_and_value_survive(make_log, make_routes):
    log = make_log(("a", 0, 0, None, None, None))
    row = to_message(log, make_routes(("a", "x", None))).first()
    assert row.key is None and row.value is None
    assert [h.key for h in row.headers] == ["_t"]


def test_append_headers_keeps_order_and_skips_null(make_log):
    log = make_log(("a", 0, 0, b"k", b"v", [("x", b"1")]), ("a", 0, 1, b"k", b"v", None))
    twice = log.select("offset", append_headers("headers", "headers").alias("h"))
    assert {r.offset: [p.key for p in r.h] for r in twice.collect()} == {0: ["x", "x"], 1: []}


def test_message_columns(make_log, make_routes):
    log = make_log(("a", 3, 9, b"k", b"v"))
    message = to_message(log, make_routes(("a", "x", None)))
    assert message.columns == MESSAGE_COLUMNS
    row = message.first()
    assert (row.topic, row.partition, row.source_topic, row.source_partition, row.source_offset) == (
        "x", 3, "a", 3, 9,
    )


def test_expect_topic_fails_even_when_the_topic_is_not_selected(make_log):
    log = make_log(("a", 0, 0, b"k", b"v"), ("b", 0, 1, b"k", b"v"))
    assert expect_topic(log.where("topic = 'a'"), "a").count() == 1
    with pytest.raises(PySparkException, match="unexpected topic b"):
        expect_topic(log, "a").select("offset").collect()


def test_all_filters_must_allow(make_log):
    log = make_log(("a", 0, 0, b"k", b"1"), ("a", 0, 1, b"k", b"22"), ("a", 0, 2, b"k", None))
    filters = {
        "short": lambda value: F.length(value) < 2,
        "present": F.col("value").isNotNull(),
    }
    assert pairs(filter_messages(log, filters), "offset") == [(0,)]
    assert filter_messages(log, {}).count() == 3
    # The value is NULL, so "short" is neither: that denies.
    denied = attribute_filters(log, filters)
    assert {r.offset: r.denied_by for r in denied.collect()} == {0: None, 1: "short", 2: "short"}
    assert pairs(filtered_counts(denied), "filter", "n") == [("short", 2)]


def test_first_declared_filter_gets_the_blame(make_log):
    log = make_log(("a", 0, 0, b"k", b"v"))
    no = F.lit(False)
    assert attribute_filters(log, {"x": no, "y": no}).first().denied_by == "x"
    assert attribute_filters(log, {"y": no, "x": no}).first().denied_by == "y"
    assert attribute_filters(log, {}).first().denied_by is None


def test_opaque_filter_function(make_log):
    def starts(value, prefix):
        return value is not None and value.startswith(prefix)

    log = make_log(("a", 0, 0, b"k", b"ab"), ("a", 0, 1, b"k", b"ba"), ("a", 0, 2, b"k", None))
    kept = filter_messages(log, {"starts": opaque_filter(starts, prefix=b"a")})
    assert pairs(kept, "offset") == [(0,)]


def test_opaque_filter_class(make_log):
    class AllBut:
        def __init__(self, banned):
            self.banned = banned

        def is_allowed(self, value):
            return value != self.banned

    log = make_log(("a", 0, 0, b"k", b"ab"), ("a", 0, 1, b"k", b"ba"), ("a", 0, 2, b"k", None))
    kept = filter_messages(log, {"all_but": opaque_filter(AllBut, banned=b"ba")})
    assert pairs(kept, "offset") == [(0,), (2,)]


def test_filter_that_rejects_everything(make_log):
    log = make_log(("a", 0, 0, b"k", b"v"))
    assert filter_messages(log, {"no": opaque_filter(lambda value: False)}).count() == 0


def test_relayed_counts_mark_open_partitions(make_log, make_routes):
    log = make_log(("a", 0, 0, b"k", b"v"), ("a", 0, 1, b"k", b"v"))
    messages = to_message(log, make_routes(("a", "x", None)), "auto")
    assert [tuple(r) for r in relayed_counts(messages).collect()] == [("a", 0, "x", -1, 2)]


def test_validate_routes(spark, make_routes):
    catalog = local_table(spark, [("web", 0), ("web", 1), ("orders", 0)], CATALOG_SCHEMA)
    routes = make_routes(
        ("a", "web", None), ("b", "orders", 0), ("c", "orders", 1), ("d", "gone", None), ("e", "gone", 3)
    )
    found = pairs(validate_routes(routes, catalog), "source_topic", "reason")
    assert found == [("c", "partition missing"), ("d", "topic missing"), ("e", "topic missing")]


def test_fingerprint_tells_null_from_empty_and_position(spark):
    rows = spark.createDataFrame(
        [(None, b"a"), (b"a", None), (b"", b"a"), (b"a", b""), (None, None)],
        "key binary, value binary",
    )
    prints = {r[0] for r in rows.select(payload_fingerprint("key", "value")).collect()}
    assert len(prints) == 5


def test_denied_records_are_not_shown_to_later_filters(make_log):
    """A filter that cannot take what an earlier one denies is never asked about it."""

    def number(value):
        return int(value) < 50

    class Even:
        def is_allowed(self, value):
            return int(value) % 2 == 0

    log = make_log(*[("t", 0, o, None, v) for o, v in enumerate([b"4", b"x", b"7", None, b"60", b"-"])])
    filters = {
        "digits": F.col("value").cast("string").rlike("^[0-9]+$"),
        "small": opaque_filter(number),
        "even": opaque_filter(Even),
        "not_four": F.col("value").cast("string") != "4",
    }
    found = {r.offset: r.denied_by for r in attribute_filters(log, filters).collect()}
    assert found == {0: "not_four", 1: "digits", 2: "even", 3: "digits", 4: "small", 5: "digits"}
    assert filter_messages(log, {k: filters[k] for k in ("digits", "small")}).count() == 2
    # Opaque filters first, in one pass, each asked only for what is left.
    first = {"known": opaque_filter(lambda v: v is not None and v.isdigit()), **{k: filters[k] for k in ("small", "even")}}
    assert {r.offset: r.denied_by for r in attribute_filters(log, first).collect()} == {
        0: None, 1: "known", 2: "even", 3: "known", 4: "small", 5: "known",
    }
