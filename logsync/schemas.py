"""Fixed row shapes: message logs, offset tables, routes and health samples.

A log row is what Spark's Kafka source yields with ``includeHeaders`` on, so one
set of operators serves Kafka topics and table logs alike.
"""

from __future__ import annotations

from pyspark.sql import types as T

HEADER = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]
)
# An array, not a map: header names may repeat and their order counts.
HEADERS = T.ArrayType(HEADER)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
    ]
)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("source_partition", T.IntegerType()),
        T.StructField("source_offset", T.LongType()),
        T.StructField("source_timestamp", T.TimestampType()),
    ]
)

# ``offset`` is the target's own, ``timestamp`` the arrival time.
TARGET_LOG_SCHEMA = T.StructType(
    LOG_SCHEMA.fields
    + [
        T.StructField("source_topic", T.StringType()),
        T.StructField("source_partition", T.IntegerType()),
        T.StructField("source_offset", T.LongType()),
    ]
)

# NULL target_partition: the route does not pin one.
ROUTE_SCHEMA = T.StructType(
    [
        T.StructField("source_topic", T.StringType()),
        T.StructField("target_topic", T.StringType()),
        T.StructField("target_partition", T.IntegerType()),
    ]
)

OFFSETS_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("next_offset", T.LongType()),
    ]
)

# One row per poll, node and partition; a failed poll has ok=false, no offset.
HEALTH_SCHEMA = T.StructType(
    [
        T.StructField("tick", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("node_id", T.IntegerType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("end_offset", T.LongType()),
        T.StructField("ok", T.BooleanType()),
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
    ]
)

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("started", T.TimestampType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("relayed", T.LongType()),
        T.StructField("filtered", T.LongType()),
        T.StructField("retries", T.IntegerType()),
    ]
)

# Of each batch of a copy; sketches of value sizes and of lag can be merged.
METRICS_SCHEMA = T.StructType(
    PROGRESS_SCHEMA.fields
    + [
        T.StructField("denied", T.MapType(T.StringType(), T.LongType())),
        T.StructField("size_sketch", T.BinaryType()),
        T.StructField("lag_ms_sketch", T.BinaryType()),
    ]
)

LOG_COLUMNS = LOG_SCHEMA.fieldNames()
MESSAGE_COLUMNS = MESSAGE_SCHEMA.fieldNames()
TARGET_LOG_COLUMNS = TARGET_LOG_SCHEMA.fieldNames()
SOURCE_COORDINATES = ["source_topic", "source_partition", "source_offset"]
