from __future__ import annotations

import sys
from datetime import timedelta

import pytest
from helpers import EPOCH, ROOT, SF_DIR

sys.path.insert(0, str(ROOT))

from logsync.operators import local_table  # noqa: E402
from logsync.schemas import HEALTH_SCHEMA, LOG_SCHEMA, OFFSETS_SCHEMA, ROUTE_SCHEMA  # noqa: E402
from logsync.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def make_log(spark):
    """Log rows from (topic, partition, offset, key, value[, headers[, time]])."""

    def make(*rows):
        full = []
        for row in rows:
            topic, partition, offset, key, value, *rest = row
            headers = rest[0] if rest else []
            when = rest[1] if len(rest) > 1 else EPOCH + timedelta(seconds=offset)
            full.append((topic, partition, offset, when, key, value, headers))
        # Rows, not Arrow: header lists may be NULL or hold pairs.
        return spark.createDataFrame(full, LOG_SCHEMA)

    return make


@pytest.fixture
def make_offsets(spark):
    return lambda *rows: local_table(spark, rows, OFFSETS_SCHEMA)


@pytest.fixture
def make_routes(spark):
    return lambda *rows: local_table(spark, rows, ROUTE_SCHEMA)


@pytest.fixture
def make_health(spark):
    """Health rows from per-tick lists of node weights; None: failed poll."""

    def make(*ticks, topic="t", hours=1):
        rows = []
        for i, weights in enumerate(ticks):
            tick = EPOCH + timedelta(hours=i * hours)
            for node, weight in enumerate(weights):
                rows.append((tick, topic, node, 0, weight, weight is not None))
        return local_table(spark, rows, HEALTH_SCHEMA)

    return make
