from helpers import pairs
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logsync.operators import (
    after_offsets,
    assign_target_offsets,
    between_offsets,
    gap_report,
    high_watermarks,
    lookup_join,
    number_rows,
    reached_end,
    remaining_offsets,
    source_progress,
    until_offsets,
)
from logsync.operators.routing import to_message


def numbered(make_log, **sizes):
    return make_log(
        *[("t", int(p[1:]), o, b"k", b"v") for p, n in sizes.items() for o in range(n)]
    )


def plain(offsets):
    return pairs(offsets, "topic", "partition", "next_offset")


def test_high_watermarks(make_log):
    log = make_log(("t", 0, 4, b"k", b"v"), ("t", 0, 2, b"k", b"v"), ("u", 1, 0, b"k", b"v"))
    assert plain(high_watermarks(log)) == [("t", 0, 5), ("u", 1, 1)]


def test_high_watermarks_of_an_empty_log(make_log):
    assert plain(high_watermarks(make_log())) == []


# The literal form, the broadcast form, and the salted one must agree.
FORMS = [
    {},
    {"literal_rows": 0},
    {"literal_rows": 0, "broadcast_rows": 0},
]


def test_after_offsets_starts_at_the_next_offset(make_log, make_offsets):
    log = numbered(make_log, p0=4, p1=3)
    for form in FORMS:
        kept = after_offsets(log, make_offsets(("t", 0, 2), ("t", 7, 9)), **form)
        assert pairs(kept, "partition", "offset") == [(0, 2), (0, 3), (1, 0), (1, 1), (1, 2)]
        assert kept.columns == log.columns


def test_after_offsets_can_skip_unknown_partitions(make_log, make_offsets):
    log = numbered(make_log, p0=4, p1=3)
    for form in FORMS:
        kept = after_offsets(log, make_offsets(("t", 0, 2)), missing="skip", **form)
        assert pairs(kept, "partition", "offset") == [(0, 2), (0, 3)]


def test_after_no_offsets(make_log, make_offsets):
    log = numbered(make_log, p0=2)
    assert after_offsets(log, make_offsets()).count() == 2
    assert after_offsets(log, make_offsets(), missing="skip").count() == 0


def test_until_offsets_leaves_out_what_had_no_end(make_log, make_offsets):
    log = numbered(make_log, p0=4, p1=3)
    for form in FORMS:
        kept = until_offsets(log, make_offsets(("t", 0, 3)), **form)
        assert pairs(kept, "partition", "offset") == [(0, 0), (0, 1), (0, 2)]
    assert until_offsets(log, make_offsets()).count() == 0


def test_after_and_until_split_the_log(make_log, make_offsets):
    log = numbered(make_log, p0=6, p1=5)
    bounds = make_offsets(("t", 0, 4), ("t", 1, 0))
    both = after_offsets(log, bounds).unionByName(until_offsets(log, bounds))
    assert pairs(both, "partition", "offset") == pairs(log, "partition", "offset")


def test_between_offsets_equals_both_bounds(make_log, make_offsets):
    log = numbered(make_log, p0=6, p1=5, p2=3)
    start = make_offsets(("t", 0, 4), ("t", 1, 5), ("t", 9, 1))
    ends = make_offsets(("t", 0, 6), ("t", 1, 3), ("t", 2, 2))
    for missing in ("start", "skip"):
        both = until_offsets(after_offsets(log, start, missing), ends)
        for form in FORMS:
            kept = between_offsets(log, start, ends, missing, **form)
            assert pairs(kept, "partition", "offset") == pairs(both, "partition", "offset")


def test_remaining_and_reached(make_offsets):
    source = make_offsets(("t", 0, 10), ("t", 1, 4))
    target = make_offsets(("t", 0, 7), ("t", 5, 99))
    left = remaining_offsets(source, target)
    assert pairs(left, "partition", "remaining") == [(0, 3), (1, 4)]
    assert not reached_end(left).first().reached
    assert reached_end(remaining_offsets(source, source)).first().reached
    assert reached_end(remaining_offsets(make_offsets(), target)).first().reached


def brute_gaps(offsets):
    missing = sorted(set(range(min(offsets), max(offsets) + 1)) - set(offsets))
    gaps = []
    for offset in missing:
        if gaps and gaps[-1][1] == offset - 1:
            gaps[-1][1] = offset
        else:
            gaps.append([offset, offset])
    return [tuple(g) for g in gaps]


def test_gaps_within_and_across_stretches(make_log):
    offsets = [0, 1, 5, 6, 32_766, 32_767, 32_770, 98_305, 98_306]
    log = make_log(*[("t", 0, o, None, None, [], None) for o in offsets])
    assert pairs(gap_report(log), "gap_start", "gap_end") == brute_gaps(offsets)


def test_repeats_do_not_hide_gaps(make_log):
    # As many rows as the range is long, yet one offset is missing.
    log = make_log(*[("t", 0, o, b"k", b"v") for o in (0, 0, 2)])
    assert pairs(gap_report(log), "gap_start", "gap_end") == [(1, 1)]


def test_no_gaps(make_log):
    assert gap_report(numbered(make_log, p0=5, p1=1)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 70_000), min_size=1, max_size=30))
def test_gap_report_property(make_log, offsets):
    log = make_log(*[("t", 0, o, b"k", b"v") for o in offsets])
    assert pairs(gap_report(log), "gap_start", "gap_end") == brute_gaps(offsets)


def test_number_rows_is_dense_whatever_the_slice_width(spark):
    rows = spark.range(500).selectExpr("id % 3 AS part", "id * id AS place")
    for width in (1, 7, 1000, 1 << 20):
        result = number_rows(rows, ["part"], "place", "n", width=width)
        for part in range(3):
            found = pairs(result.where(f"part = {part}"), "place", "n")
            assert [n for _, n in found] == list(range(len(found)))


def test_target_offsets_continue_and_keep_source_order(make_log, make_offsets, make_routes):
    log = make_log(
        *[(topic, p, o, b"k", b"v") for topic in ("a", "b") for p in (0, 1) for o in (3, 5, 9, 40)]
    )
    messages = to_message(log, make_routes(("a", "all", 0), ("b", "all", 0)))
    placed = assign_target_offsets(messages, make_offsets(("all", 0, 100)), width=8)
    found = pairs(placed, "offset", "source_topic", "source_partition", "source_offset")
    assert [row[0] for row in found] == list(range(100, 116))
    assert [row[1:] for row in found] == sorted(row[1:] for row in found)


def test_progress_comes_from_source_coordinates(spark):
    target = spark.createDataFrame(
        [("x", 0, 7, "s", 2, 40), ("x", 0, 8, "s", 2, 43), ("x", 0, 9, None, None, None)],
        "topic string, partition int, offset long, source_topic string,"
        " source_partition int, source_offset long",
    )
    assert plain(source_progress(target)) == [("s", 2, 44)]


def test_lookup_join_forms_agree(spark):
    log = spark.range(200).selectExpr("id % 5 AS k", "id AS offset")
    table = spark.createDataFrame([(0, "a"), (3, "b")], "k long, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        columns = ["k", "offset"] + (["name"] if how in ("inner", "left") else [])
        hashed = lookup_join(log, table, ["k"], how)
        salted = lookup_join(log, table, ["k"], how, limit=0, salts=4)
        key = lambda rows: sorted(map(str, rows))
        assert key(hashed.select(*columns).collect()) == key(salted.select(*columns).collect())
