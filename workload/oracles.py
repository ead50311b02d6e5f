"""The queries' results stated in SQL over the same tables."""

from __future__ import annotations

_PARTS = {
    "log": """
        SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
               CAST(row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
               CAST(count(*) OVER (PARTITION BY user_id % 4) AS BIGINT) AS n,
               event_id, ts, CAST(user_id AS VARCHAR) AS key, props AS value, event_type
        FROM events""",
    "typed": """
        SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
               CAST(row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
               event_id
        FROM events""",
    "gappy": """SELECT * FROM log WHERE event_id % 10 <> 3""",
    "nodes": """SELECT * FROM (VALUES (0, 90), (1, 100), (2, 95)) AS v(node_id, share)""",
    "mirrors": """
        SELECT log.*, CAST(node_id AS INTEGER) AS node_id
        FROM log JOIN nodes ON "offset" * 100 < n * share""",
    "target": """SELECT * FROM log WHERE "offset" * 100 < n * 60""",
    "target_bad": """
        SELECT "partition", "offset", CASE WHEN "offset" % 50 = 9 THEN '{}' ELSE value END AS value
        FROM target WHERE "offset" % 50 <> 7""",
    "done": """SELECT "partition", max("offset") + 1 AS next FROM target GROUP BY ALL""",
    "routes": """
        SELECT * FROM (VALUES ('click', 'web', NULL), ('view', 'web', NULL),
                              ('purchase', 'orders', 0), ('signup', 'orders', 1))
               AS v(source_topic, target_topic, pinned)""",
    "judged": """
        SELECT *, CASE WHEN event_type = 'error' THEN 'not_error'
                       WHEN CAST(value->>'k' AS INTEGER) < 50 THEN NULL
                       ELSE 'small_k' END AS denied_by
        FROM log""",
    "routed": """
        SELECT source_topic, target_topic, pinned,
               CAST(coalesce(pinned, "partition") AS INTEGER) AS target_partition,
               "partition" AS source_partition, "offset" AS source_offset
        FROM typed JOIN routes ON topic = source_topic""",
    "ticks": """
        SELECT unnest(generate_series(TIMESTAMP '2024-01-01 06:00:00',
                                      TIMESTAMP '2024-01-31 00:00:00', INTERVAL 6 HOUR)) AS tick""",
    "polls": """
        SELECT tick, node_id,
               NOT (node_id = 0 AND tick >= TIMESTAMP '2024-01-06' AND tick < TIMESTAMP '2024-01-08') AS ok,
               CASE WHEN node_id = 1 AND tick >= TIMESTAMP '2024-01-14' AND tick < TIMESTAMP '2024-01-18'
                    THEN TIMESTAMP '2024-01-14' ELSE tick END - to_hours(delay) AS seen
        FROM ticks, (VALUES (0, 0), (1, 9), (2, 48)) AS v(node_id, delay)""",
    "arrivals": """
        SELECT ts, count(*) OVER (ORDER BY ts) AS total FROM events""",
    "weights": """
        SELECT tick, CAST(node_id AS INTEGER) AS node_id,
               CAST(CASE WHEN ok THEN coalesce(total, 0) ELSE -1 END AS BIGINT) AS weight
        FROM polls ASOF LEFT JOIN arrivals ON polls.seen >= arrivals.ts""",
    "best": """
        SELECT tick, weight AS best, node_id FROM weights WHERE weight >= 0
        QUALIFY row_number() OVER (PARTITION BY tick ORDER BY weight DESC, node_id) = 1""",
    "records": """
        SELECT tick, node_id, best,
               greatest(coalesce(max(best) OVER (ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS record
        FROM best""",
    "candidates": """
        SELECT tick,
               last_value(CASE WHEN best > record THEN node_id END IGNORE NULLS) OVER (ORDER BY tick) AS node_id,
               greatest(best, record) AS weight
        FROM ticks LEFT JOIN records USING (tick)""",
    "threshold": """SELECT count(*) // 50 AS t FROM events""",
    "may_stay": """
        SELECT tick, node_id FROM weights JOIN (SELECT tick, max(weight) AS most FROM weights GROUP BY tick) USING (tick)
        WHERE weight >= 0 AND most - weight <= (SELECT t FROM threshold)""",
    "follows": """
        SELECT row_number() OVER (ORDER BY c.tick) AS i, c.tick,
               CASE WHEN w.weight >= 0 THEN c.node_id END AS node_id
        FROM candidates c LEFT JOIN weights w ON w.tick = c.tick AND w.node_id = c.node_id""",
    "fold": """
        SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS TIMESTAMP) AS tick,
               CAST(NULL AS INTEGER) AS node_id, CAST(NULL AS INTEGER) AS previous_node
        UNION ALL
        SELECT f.i, f.tick, CASE WHEN s.node_id IS NOT NULL THEN s.node_id ELSE f.node_id END, p.node_id
        FROM fold p JOIN follows f ON f.i = p.i + 1
        LEFT JOIN may_stay s ON s.tick = f.tick AND s.node_id = p.node_id""",
    "active": """SELECT tick, node_id, previous_node FROM fold WHERE i > 0""",
    "breaches": """
        SELECT w.tick, a.previous_node AS active_node, w.node_id, w.weight - own.weight AS lead
        FROM weights w JOIN active a ON a.tick = w.tick
        JOIN weights own ON own.tick = w.tick AND own.node_id = a.previous_node
        WHERE own.weight >= 0 AND w.node_id <> a.previous_node
          AND w.weight - own.weight > (SELECT t FROM threshold)""",
}

# What each part reads, so that a query states only what it needs.
_NEEDS = {
    "gappy": ["log"],
    "mirrors": ["log", "nodes"],
    "target": ["log"],
    "target_bad": ["target"],
    "done": ["target"],
    "judged": ["log"],
    "routed": ["typed", "routes"],
    "polls": ["ticks"],
    "weights": ["polls", "arrivals"],
    "best": ["weights"],
    "records": ["best"],
    "candidates": ["ticks", "records"],
    "may_stay": ["weights", "threshold"],
    "follows": ["candidates", "weights"],
    "fold": ["follows", "may_stay"],
    "active": ["fold"],
    "breaches": ["active", "weights", "threshold"],
}


def _sql(select: str, *parts: str) -> str:
    order: list[str] = []

    def add(part: str) -> None:
        for needed in _NEEDS.get(part, []):
            add(needed)
        if part not in order:
            order.append(part)

    for part in parts:
        add(part)
    recursive = "RECURSIVE " if "fold" in order else ""
    stated = ",\n".join(f"{name} AS ({_PARTS[name].strip()})" for name in order)
    return f"WITH {recursive}{stated}\n{select.strip()}"


ORACLES: dict[str, str] = {
    "relay_resume_filtered": _sql(
        """
        SELECT 'events_copy' AS target_topic, j."partition" AS target_partition,
               j."partition" AS source_partition, j."offset" AS source_offset, key, value,
               CAST(epoch_us(ts) * 1000 AS VARCHAR) AS t_ns
        FROM judged j JOIN done d ON d."partition" = j."partition"
        WHERE j."offset" >= d.next AND denied_by IS NULL""",
        "judged", "done",
    ),
    "relay_multi_topic": _sql(
        """SELECT source_topic, target_topic, target_partition, source_partition, source_offset
           FROM routed""",
        "routed",
    ),
    "relay_until_end": _sql(
        """
        SELECT "partition" AS source_partition, "offset" AS source_offset FROM log
        WHERE "offset" * 100 >= n * 60 AND "offset" * 100 < n * 90""",
        "log",
    ),
    "failover_round": _sql(
        """
        SELECT "partition" AS source_partition, "offset" AS source_offset, node_id FROM mirrors
        WHERE "offset" * 100 >= n * 60
          AND node_id = (SELECT node_id FROM mirrors GROUP BY node_id ORDER BY count(*) DESC, node_id LIMIT 1)""",
        "mirrors",
    ),
    "message_headers": _sql(
        """
        SELECT "partition", "offset", '_t' AS first_name,
               CAST(epoch_us(ts) * 1000 AS VARCHAR) AS t_ns, event_type,
               'again' AS second_event_type, true AS same
        FROM log""",
        "log",
    ),
    "target_offsets": _sql(
        """
        SELECT target_topic AS topic, target_partition AS "partition", source_topic,
               source_partition, source_offset,
               CAST(coalesce(b.next, 0) + row_number() OVER (
                   PARTITION BY target_topic, target_partition
                   ORDER BY source_topic, source_partition, source_offset) - 1 AS BIGINT) AS target_offset
        FROM routed LEFT JOIN (SELECT 'web' AS topic, "partition", max("offset") + 1 AS next FROM log GROUP BY ALL) b
          ON b.topic = target_topic AND b."partition" = target_partition""",
        "routed", "log",
    ),
    "high_watermarks": _sql(
        """SELECT topic, "partition", max("offset") + 1 AS next_offset FROM log GROUP BY ALL""", "log"
    ),
    "gappy_high_watermarks": _sql(
        """SELECT topic, "partition", max("offset") + 1 AS next_offset FROM gappy GROUP BY ALL""", "gappy"
    ),
    "remaining_offsets": _sql(
        """
        SELECT l."partition", max(l."offset") + 1 - coalesce(max(d.next), 0) AS remaining
        FROM log l LEFT JOIN done d ON d."partition" = l."partition" GROUP BY l."partition" """,
        "log", "done",
    ),
    "reached_end": _sql(
        """
        SELECT 'full' AS node, NOT EXISTS (SELECT 1 FROM log l JOIN done d USING ("partition") WHERE l."offset" >= d.next) AS reached
        UNION ALL
        SELECT 'level', NOT EXISTS (SELECT 1 FROM target l JOIN done d USING ("partition") WHERE l."offset" >= d.next)""",
        "log", "done",
    ),
    "gap_report": _sql(
        """
        SELECT topic, "partition", "offset" + 1 AS gap_start, following - 1 AS gap_end
        FROM (SELECT topic, "partition", "offset",
                     lead("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS following
              FROM gappy)
        WHERE following > "offset" + 1""",
        "gappy",
    ),
    "filter_attribution": _sql(
        """SELECT "partition", "offset", denied_by FROM judged""", "judged"
    ),
    "filtered_counts": _sql(
        """SELECT denied_by AS filter, count(*) AS n FROM judged WHERE denied_by IS NOT NULL GROUP BY ALL""",
        "judged",
    ),
    "opaque_filter": _sql(
        """SELECT "partition", "offset" FROM log WHERE CAST(value->>'k' AS INTEGER) < 50""", "log"
    ),
    "relayed_counts": _sql(
        """
        SELECT source_topic, source_partition, target_topic, target_partition, count(*) AS n
        FROM routed GROUP BY ALL""",
        "routed",
    ),
    "relayed_counts_auto": _sql(
        """
        SELECT source_topic, source_partition, target_topic,
               CAST(coalesce(pinned, -1) AS INTEGER) AS target_partition, count(*) AS n
        FROM routed GROUP BY ALL""",
        "routed",
    ),
    "read_mirrors": _sql("""SELECT node_id, "partition", "offset" FROM mirrors""", "mirrors"),
    "merge_mirrors": _sql(
        """
        SELECT "partition", "offset", node_id, value FROM mirrors
        QUALIFY row_number() OVER (PARTITION BY topic, "partition", "offset"
                                   ORDER BY CASE WHEN node_id = 2 THEN -1 ELSE node_id END) = 1""",
        "mirrors",
    ),
    "stored_mirrors": _sql(
        """
        SELECT "partition", "offset", min(node_id) AS node_id FROM mirrors
        GROUP BY "partition", "offset" """,
        "mirrors",
    ),
    "validate_routes": _sql(
        """
        SELECT source_topic, target_topic, target_partition,
               CASE WHEN EXISTS (SELECT 1 FROM catalog c WHERE c.topic = target_topic)
                    THEN 'partition missing' ELSE 'topic missing' END AS reason
        FROM planned p
        WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.topic = target_topic
                          AND (target_partition IS NULL OR c."partition" = target_partition))""",
        "routed",
    ).replace(
        "\nSELECT source_topic, target_topic, target_partition,\n",
        """,
catalog AS (SELECT DISTINCT target_topic AS topic, target_partition AS "partition"
            FROM routed WHERE source_topic <> 'signup'),
planned AS (SELECT t.topic AS source_topic, coalesce(target_topic, 'alerts') AS target_topic,
                   CAST(pinned AS INTEGER) AS target_partition
            FROM (SELECT DISTINCT topic FROM typed) t LEFT JOIN routes ON source_topic = t.topic)
SELECT source_topic, target_topic, target_partition,
""",
        1,
    ),
    "reconcile": _sql(
        """
        SELECT coalesce(s."partition", t."partition") AS source_partition,
               coalesce(s."offset", t."offset") AS source_offset,
               CASE WHEN t."offset" IS NULL THEN 'missing'
                    WHEN s."offset" IS NULL THEN 'unexpected' ELSE 'different' END AS status
        FROM target s FULL JOIN target_bad t ON s."partition" = t."partition" AND s."offset" = t."offset"
        WHERE s."offset" IS NULL OR t."offset" IS NULL OR s.value IS DISTINCT FROM t.value""",
        "target", "target_bad",
    ),
    "replication_lag": _sql(
        """
        SELECT date_trunc('day', ts + to_seconds("offset" % 60)) AS window_start, "partition",
               count(*) AS n, CAST(max("offset" % 60) * 1000 AS BIGINT) AS max_lag_ms,
               round(avg("offset" % 60) * 1000, 3) AS avg_lag_ms
        FROM target GROUP BY ALL""",
        "target",
    ),
    "node_weights": _sql("SELECT tick, node_id, weight FROM weights", "weights"),
    "elect_source": _sql(
        "SELECT tick, node_id, best AS weight FROM best WHERE tick = (SELECT max(tick) FROM ticks)",
        "best", "ticks",
    ),
    "candidate_history": _sql("SELECT tick, node_id, weight FROM candidates", "candidates"),
    "active_history": _sql("SELECT tick, node_id, previous_node FROM active", "active"),
    "stream_active_history": _sql("SELECT tick, node_id, previous_node FROM active", "active"),
    "lag_breaches": _sql("SELECT tick, active_node, node_id, lead FROM breaches", "breaches"),
    "switch_counts": _sql(
        """
        SELECT 'events' AS topic,
               count(*) FILTER (WHERE node_id IS NOT NULL AND node_id IS DISTINCT FROM previous_node) AS switches
        FROM active""",
        "active",
    ),
    "node_health_summary": _sql(
        """
        SELECT w.node_id, max_by(w.weight, w.tick) AS last_weight,
               count(*) FILTER (WHERE w.weight < 0) AS failed,
               (SELECT count(*) FROM breaches b WHERE b.node_id = w.node_id) AS breaches,
               count(*) AS polls
        FROM weights w GROUP BY w.node_id""",
        "weights", "breaches",
    ),
    "write_read_back": _sql(
        """SELECT "partition", "offset", "offset" AS source_offset, value FROM log""", "log"
    ),
    "idempotent_batch": _sql(
        """SELECT "partition", "offset", "offset" AS source_offset FROM log""", "log"
    ),
    "stream_relay": _sql(
        """
        SELECT "partition", CAST(row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS BIGINT) AS "offset",
               "offset" AS source_offset
        FROM judged WHERE denied_by IS NULL""",
        "judged",
    ),
    "stream_merge_mirrors": _sql("""SELECT "partition", "offset" FROM log""", "log"),
    "stream_progress": _sql(
        """
        SELECT count(*) AS rows, count(*) FILTER (WHERE denied_by IS NULL) AS relayed,
               count(*) FILTER (WHERE denied_by IS NOT NULL) AS filtered, CAST(0 AS BIGINT) AS retries
        FROM judged""",
        "judged",
    ),
    "stream_filter_counts": _sql(
        """SELECT denied_by AS filter, count(*) AS n FROM judged WHERE denied_by IS NOT NULL GROUP BY denied_by""",
        "judged",
    ),
    "stream_multi_topic": _sql(
        """
        SELECT target_topic AS topic, target_partition AS "partition", source_topic, source_partition, source_offset
        FROM routed""",
        "routed",
    ),
    "mirrors_then_copy": _sql("""SELECT "partition", "offset" FROM log""", "log"),
    "covered_offsets": _sql(
        """
        SELECT 'events' AS topic, "partition", min("offset") AS low, max("offset") + 1 AS high
        FROM (SELECT "partition", "offset",
                     "offset" - row_number() OVER (PARTITION BY "partition" ORDER BY "offset") AS island FROM gappy)
        GROUP BY "partition", island""",
        "gappy",
    ),
    "row_target_resume": _sql(
        """SELECT "partition", "offset", "partition" AS source_partition, "offset" AS source_offset FROM log""", "log"
    ),
    "committed_write": _sql(
        """SELECT "partition", "partition" AS source_partition, "offset" AS source_offset FROM log""", "log"
    ),
    "ordered_write": _sql(
        """SELECT "partition", count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM log GROUP BY "partition" """, "log"
    ),
    "write_codecs": _sql(
        """
        SELECT codec, "partition", count(*) AS n, CAST(sum("offset") AS BIGINT) AS offsets,
               CAST(sum(strlen(value)) AS BIGINT) AS value_bytes
        FROM log, (VALUES ('gzip'), ('snappy'), ('lz4'), ('zstd'), ('none')) AS c(codec) GROUP BY ALL""",
        "log",
    ),
}
