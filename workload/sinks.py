"""Sinks as users write them, for the queries: a broker kept as files, and one that fails once."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator
from itertools import batched, groupby
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle

from logsync.sinks import FolderSink

# Rows that a broker holds in memory at a time.
ROWS_AT_ONCE = 10_000
_KEPT = pa.schema(
    [
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", "UTC")),
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("headers", pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))),
    ]
)

# Workers get the classes of this module with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def plain_path(folder: str) -> str:
    """A folder on a mounted file system as a path."""
    return urlparse(folder).path if folder.startswith("file:") else folder


class FileBroker:
    """Appends records to partitions kept as files, which it numbers itself.

    A partition has one writer at a time, which is what a relay's single-writer
    order gives; a file is named after its first and last offset.
    """

    def __init__(self, folder: str) -> None:
        self.folder = plain_path(folder)

    def __call__(self, rows: Iterator) -> None:
        for (topic, partition), own in groupby(rows, key=lambda r: (r.topic, r.partition)):
            place = f"{self.folder}/topic={topic}/partition={partition}"
            os.makedirs(place, exist_ok=True)
            ends = [int(name.split("-")[1].split(".")[0]) for name in os.listdir(place) if name[0] != "."]
            self._append(place, max(ends, default=-1) + 1, own)

    @staticmethod
    def _append(place: str, first: int, rows: Iterator) -> None:
        # There at once or not at all.
        hidden, end = f"{place}/.{uuid.uuid4().hex}", first
        with pq.ParquetWriter(hidden, _KEPT) as file:
            # A partition may be long: rows go on their way as they come.
            for some in batched(rows, ROWS_AT_ONCE):
                columns = [
                    range(end, end + len(some)),
                    [r.source_timestamp for r in some],
                    [r.key for r in some],
                    [r.value for r in some],
                    [[(h.key, h.value) for h in r.headers or []] for r in some],
                ]
                arrays = [pa.array(column, kind.type) for column, kind in zip(columns, _KEPT)]
                file.write_table(pa.Table.from_arrays(arrays, schema=_KEPT))
                end += len(some)
        os.replace(hidden, f"{place}/{first:012d}-{end - 1:012d}.parquet")


class FailsOnce(FolderSink):
    """A folder sink whose tasks are lost half-way in the first try of each batch."""

    def write(self, batches, batch_id):
        files, marker = self._at("tried", f"{batch_id}")
        files.create_dir(marker.rpartition("/")[0], recursive=True)
        lost = files.get_file_info(marker).type == fs.FileType.NotFound

        def some():
            for batch in batches:
                yield batch.slice(0, batch.num_rows // 2) if lost else batch
                if lost:
                    files.open_output_stream(marker).close()
                    raise RuntimeError("this task is lost")

        return super().write(some(), batch_id)
