"""The connector is not on the test class path: only its options are checked."""

import json

from helpers import pairs
from pyspark.sql import Row

from logsync.sources import KafkaLog, offsets_from_json, offsets_json

OFFSETS = [Row(topic="a", partition=0, next_offset=5), Row(topic="a", partition=2, next_offset=7)]


def test_plain_subscription():
    assert KafkaLog("h:9092").reader_options(["a", "b"]) == {
        "kafka.bootstrap.servers": "h:9092",
        "includeHeaders": "true",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
    }


def test_bounds_name_all_known_partitions():
    log = KafkaLog("h:9092", partitions={"a": [0, 1, 2]}, min_partitions=64)
    options = log.reader_options(["a"], OFFSETS, OFFSETS, max_per_trigger=10)
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 5, "1": -2, "2": 7}}
    assert json.loads(options["endingOffsets"]) == {"a": {"0": 5, "2": 7}}
    assert options["minPartitions"] == "64" and options["maxOffsetsPerTrigger"] == "10"


def test_skipping_unknown_partitions_assigns_the_known_ones():
    options = KafkaLog("h:9092", partitions={"a": [0, 1, 2]}).reader_options(["a"], OFFSETS, missing="skip")
    assert json.loads(options["assign"]) == {"a": [0, 2]}
    assert "subscribe" not in options
    assert json.loads(options["startingOffsets"]) == {"a": {"0": 5, "2": 7}}


def test_security_options_pass_through():
    options = KafkaLog("h:9092", {"kafka.security.protocol": "SASL_SSL"}).reader_options(["a"])
    assert options["kafka.security.protocol"] == "SASL_SSL"


def test_offsets_survive_json(spark):
    table = offsets_from_json(spark, offsets_json(OFFSETS))
    assert pairs(table, "topic", "partition", "next_offset") == [("a", 0, 5), ("a", 2, 7)]
