"""What several test modules share; conftest holds fixtures alone."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SF_DIR = "/root/testdata/sf0.001"
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def pairs(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
