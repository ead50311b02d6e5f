"""Targets that take whole Arrow batches from the executors, and count when the job commits.

A sink's ``write`` runs in each task and hands back what it wrote; only when all
tasks are done, ``commit`` gets what the successful tries handed back, once, on
the driver's side. What failed tries left behind is never named to it. If the
job fails, ``abort`` gets what there is.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.lookup import local_table
from ..schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA, OFFSETS_SCHEMA
from .order import order_for_write
from .targets import ORDERED_ROWS, with_source_headers

# Workers get the classes of this module with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BatchSink(Protocol):
    """What a sink must do; it is sent to the executors, so it must be picklable."""

    def write(self, batches: Iterator[pa.RecordBatch], batch_id: int) -> Any: ...

    def commit(self, written: list[Any], batch_id: int) -> None: ...

    def abort(self, written: list[Any], batch_id: int) -> None: ...


class _Written(WriterCommitMessage):
    def __init__(self, what: Any) -> None:
        self.what = what


class _Writer(DataSourceArrowWriter):
    def __init__(self, sink: BatchSink, batch_id: int) -> None:
        self.sink, self.batch_id = sink, batch_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _Written(self.sink.write(iterator, self.batch_id))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.sink.commit([m.what for m in messages if m is not None], self.batch_id)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.sink.abort([m.what for m in messages if m is not None], self.batch_id)


def write_committed(frame: DataFrame, sink: BatchSink, batch_id: int) -> None:
    """Write ``frame`` through a sink in two phases."""
    label = f"logsync_{uuid.uuid4().hex}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return _Writer(sink, batch_id)

    frame.sparkSession.dataSource.register(Source)
    frame.write.format(label).mode("append").save()


@dataclass(frozen=True)
class CommittedTarget:
    """A target whose backend takes Arrow batches in two phases.

    Source coordinates travel as headers, so that ``reader``, a log source over
    what the backend holds, can tell progress.
    """

    sink: BatchSink
    reader: Any = None
    max_per_round: int = ORDERED_ROWS
    margin: int = 0

    def write_batch(self, messages: DataFrame, batch_id: int) -> None:
        rows = with_source_headers(messages)
        write_committed(order_for_write(rows, single_writer=True).select(*MESSAGE_COLUMNS), self.sink, batch_id)

    def high_watermarks(self, spark: SparkSession) -> DataFrame:
        """Empty: ``tail_progress`` tells, where there is a reader."""
        return local_table(spark, [], OFFSETS_SCHEMA)


class FolderSink:
    """Files of batches below a folder, those named in a manifest count.

    Every file system that Arrow reaches will do. A batch that is written again
    replaces its manifest, so it counts once.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _at(self, *parts: str) -> tuple[fs.FileSystem, str]:
        files, path = fs.FileSystem.from_uri(self.folder) if "://" in self.folder or ":/" in self.folder else (
            fs.LocalFileSystem(), self.folder,
        )
        return files, "/".join([path, *parts])

    def write(self, batches: Iterator[pa.RecordBatch], batch_id: int) -> str | None:
        name, writer = f"{uuid.uuid4().hex}.parquet", None
        files, path = self._at("rows", name)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        try:
            for batch in batches:
                if writer is None:
                    writer = pq.ParquetWriter(files.open_output_stream(path), batch.schema)
                writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
        return None if writer is None else name

    def commit(self, written: list[str | None], batch_id: int) -> None:
        files, path = self._at("manifests", f"{batch_id:012d}.json")
        files.create_dir(path.rpartition("/")[0], recursive=True)
        with files.open_output_stream(f"{path}.new") as out:
            out.write(json.dumps(sorted(name for name in written if name)).encode())
        files.move(f"{path}.new", path)

    def abort(self, written: list[str | None], batch_id: int) -> None:
        for name in written:
            if name:
                files, path = self._at("rows", name)
                files.delete_file(path)

    def committed(self) -> list[str]:
        """Places of the files that count."""
        files, folder = self._at("manifests")
        if files.get_file_info(folder).type == fs.FileType.NotFound:
            return []
        names: list[str] = []
        for info in sorted(files.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
            if info.path.endswith(".json"):
                with files.open_input_stream(info.path) as given:
                    names += json.loads(given.read())
        return [f"{self.folder}/rows/{name}" for name in names]

    def read(self, spark: SparkSession) -> DataFrame:
        """Messages that count, as they were written."""
        places = self.committed()
        if not places:
            return local_table(spark, [], MESSAGE_SCHEMA)
        return spark.read.schema(MESSAGE_SCHEMA).parquet(*places)


class _RowSink:
    """Rows one after the other, for functions that know nothing of batches."""

    def __init__(self, write_rows: Callable[[Iterator[Row]], None]) -> None:
        self.write_rows = write_rows

    def _rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["headers"] is not None:
                    row["headers"] = [Row(**header) for header in row["headers"]]
                yield Row(**row)

    def write(self, batches: Iterator[pa.RecordBatch], batch_id: int) -> None:
        self.write_rows(self._rows(batches))

    def commit(self, written: list[None], batch_id: int) -> None:
        pass

    def abort(self, written: list[None], batch_id: int) -> None:
        pass


@dataclass(frozen=True)
class RowTarget:
    """Any backend, through a function that writes an iterator of messages.

    ``write_rows`` runs on the executors, once per task, and gets the messages
    of a topic-partition in order, their source coordinates among the headers
    where there is a ``reader``: a log source over what the backend holds, by
    which progress is read back. ``watermarks`` returns the backend's progress if
    it keeps any. ``margin`` as in ``tail_progress``.
    """

    write_rows: Callable[[Iterator[Row]], None]
    watermarks: Callable[[SparkSession], DataFrame] | None = None
    max_per_round: int = ORDERED_ROWS
    reader: Any = None
    margin: int = 0

    def write_batch(self, messages: DataFrame, batch_id: int) -> None:
        rows = messages if self.reader is None else with_source_headers(messages)
        ordered = order_for_write(rows, single_writer=True).select(*MESSAGE_COLUMNS)
        write_committed(ordered, _RowSink(self.write_rows), batch_id)

    def high_watermarks(self, spark: SparkSession) -> DataFrame:
        if self.watermarks is None:
            return local_table(spark, [], OFFSETS_SCHEMA)
        return self.watermarks(spark)
