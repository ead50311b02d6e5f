"""Token-ID output: one zstandard frame for each document, with a shared dictionary.

The dictionary is trained on the serialized ids of a bounded sample, so that
even short documents compress well by themselves. A block holds the frames of
neighbouring documents, and beside them its index: for each document the id,
the place of its frame, its number of ids and how many ids of its partition
come before it. Blocks are rows of a Parquet table below ``blocks``, sorted by
document; readers of the index alone skip the payload column, and a few
documents are found through the blocks' bounds and cut out of their frames
alone. ``dictionary`` holds the dictionary with its SHA-256, which every block
names and every reader compares. Spark commits both tables, so lost executors
leave no partial file, on any storage that Spark writes.

A payload begins with ``MAGIC`` and the byte width of the ids, and goes on with
the frames.

Defined results: a null or empty text is its end id alone; documents of the
same id keep the order of their texts; null ids come first; a table without
rows gives tables without rows, and an empty dictionary. Other columns than id
and text are not written.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsync.llm.text import text_blocks
from logsync.llm.tokens import ID, encoder

MAGIC = b"LTOK1"
WIDTH = np.dtype("<u2")
WIDE = np.dtype("<u4")
# The sample: so many documents of at most so many characters.
SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
BLOCK_BYTES = 1 << 20

BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("dictionary_sha256", T.StringType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("dictionary_sha256", pa.string()),
        *((c, pa.list_(pa.int64())) for c in ("doc_ids", "places", "sizes", "counts", "starts")),
        ("payload", pa.binary()),
    ]
)


def _texts(blocks: list[bytes | None]) -> list[str | None]:
    return [x.decode("utf-8", "replace") if x else None for x in blocks]


def _serialized(ids: np.ndarray) -> bytes:
    """Two bytes an id where all fit, else four; the first byte says which."""
    if len(ids) and ids.max() > 0xFFFF:
        return b"\x04" + ids.astype(WIDE).tobytes()
    return b"\x02" + ids.astype(WIDTH).tobytes()


def _parsed(data: bytes) -> np.ndarray:
    return np.frombuffer(data, WIDE if data[0] == 4 else WIDTH, offset=1)


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from the short texts with the lowest hashes of their ids."""
    known = docs.where(F.col("doc_id").isNotNull())
    rows = known.count()
    # Hashes below this are some twice as many as the sample takes.
    limit = -(1 << 63) + (1 << 64) * min(rows, 2 * SAMPLE_ROWS) // max(1, rows)
    ranked = known.select("doc_id", "text", F.xxhash64("doc_id").alias("rank")).where(
        F.col("rank") <= F.lit(min(limit, (1 << 63) - 1))
    )
    short = ranked.where(F.length("text").between(1, SAMPLE_CHARS))
    sample = short.orderBy("rank", "doc_id", "text").limit(SAMPLE_ROWS).select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer)
        for batch, texts in text_blocks(batches):
            ids = [_serialized(np.frombuffer(x, ID)) for x in encode_all(_texts(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
            )

    rows = sample.mapInArrow(encode, "doc_id long, ids binary").collect()
    samples = [bytes(r["ids"]) for r in sorted(rows, key=lambda r: (r["doc_id"], bytes(r["ids"])))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        # Too few samples to train on: the ids themselves serve as content.
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _zstd_dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dictionary(data), write_dict_id=False)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, partitions: int | None = None) -> None:
    """Write the ids of ``docs(doc_id, text)`` below ``path``, in ascending id order."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer)
    digest = hashlib.sha256(dictionary).hexdigest()
    table = spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, dictionary binary")
    table.write.mode("error").parquet(f"{path}/dictionary")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, compressor = encoder(tokenizer), _compressor(dictionary)
        block = _Block(TaskContext.get().partitionId(), digest)
        for batch, texts in text_blocks(batches):
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), encode_all(_texts(texts))):
                ids = np.frombuffer(data, ID)
                block.add(doc_id, len(ids), compressor.compress(_serialized(ids)))
                if block.size >= BLOCK_BYTES:
                    yield block.take()
        if block.doc_ids:
            yield block.take()

    ordered = docs.select(F.col("doc_id").cast("long"), "text")
    by_id = ordered.repartitionByRange(*([partitions] if partitions else []), F.col("doc_id"))
    blocks = by_id.sortWithinPartitions("doc_id", "text").mapInArrow(write, BLOCKS)
    blocks.write.mode("error").parquet(f"{path}/blocks")


class _Block:
    """Frames of one partition until they make a block."""

    def __init__(self, part: int, digest: str) -> None:
        self.part, self.digest, self.number, self.start = part, digest, 0, 0
        self._clear()

    def _clear(self) -> None:
        self.doc_ids, self.places, self.sizes, self.counts, self.starts = [], [], [], [], []
        self.frames, self.size = [MAGIC], len(MAGIC)

    def add(self, doc_id: int | None, count: int, frame: bytes) -> None:
        for values, value in (
            (self.doc_ids, doc_id),
            (self.places, self.size),
            (self.sizes, len(frame)),
            (self.counts, count),
            (self.starts, self.start),
            (self.frames, frame),
        ):
            values.append(value)
        self.size += len(frame)
        self.start += count

    def take(self) -> pa.RecordBatch:
        known = [x for x in self.doc_ids if x is not None]
        row = {
            "part": self.part,
            "block": self.number,
            "first_id": min(known, default=None),
            "last_id": max(known, default=None),
            "n_ids": sum(self.counts),
            "dictionary_sha256": self.digest,
            "doc_ids": self.doc_ids,
            "places": self.places,
            "sizes": self.sizes,
            "counts": self.counts,
            "starts": self.starts,
            "payload": b"".join(self.frames),
        }
        self.number += 1
        self._clear()
        return pa.RecordBatch.from_pylist([row], _ARROW)


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    (row,) = spark.read.parquet(f"{path}/dictionary").collect()
    data = bytes(row["dictionary"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return row["sha256"], data


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` and the place of each frame; no payload is read."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row for each partition that wrote.
    before = F.broadcast(_partition_starts(blocks))
    entry = F.explode(F.arrays_zip("doc_ids", "starts", "counts", "places", "sizes")).alias("e")
    return (
        blocks.select("part", "block", entry)
        .join(before, "part")
        .select(
            F.col("e.doc_ids").alias("doc_id"),
            (F.col("before") + F.col("e.starts")).alias("start"),
            F.col("e.counts").alias("n_tokens"),
            "part",
            "block",
            F.col("e.places").alias("place"),
            F.col("e.sizes").alias("size"),
        )
    )


def _partition_starts(blocks: DataFrame) -> DataFrame:
    """How many ids the partitions before each one hold.

    One row for each partition of the writing job: the number of its tasks
    bounds what the driver gets.
    """
    spark = blocks.sparkSession
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    before, rows = 0, []
    for part, n in sorted(sums):
        rows.append((part, before))
        before += n
    return spark.createDataFrame(rows, "part int, before long")


_READ = "doc_id long, start long, n_tokens long, ids binary"


def read_token_files(
    spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, crc: bool = False
) -> DataFrame:
    """Documents with their ids, as little-endian unsigned 32-bit integers.

    With ``doc_ids`` only blocks whose bounds hold one of them are read, and
    only their frames decompressed. ``crc``: the ids' crc32 instead of the ids.
    """
    digest, data = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = {row["part"]: row["before"] for row in _partition_starts(blocks).collect()}
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        near = [(F.col("first_id") <= x) & (F.col("last_id") >= x) for x in wanted]
        blocks = blocks.where(F.expr("false") if not near else _any(near))
    schema = _READ.replace("ids binary", "ids_crc32 long") if crc else _READ

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(dict_data=_zstd_dictionary(data))
        for batch in batches:
            for row in batch.to_pylist():
                yield _unpacked(row, reader, digest, before[row["part"]], wanted, crc)

    return blocks.mapInArrow(read, schema)


def _any(conditions: list):
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def _unpacked(row: dict, reader, digest: str, before: int, wanted, crc: bool) -> pa.RecordBatch:
    if row["dictionary_sha256"] != digest or not row["payload"].startswith(MAGIC):
        raise ValueError(f"block {row['part']}/{row['block']} belongs to another dictionary")
    payload = memoryview(row["payload"])
    out: list[tuple] = []
    for doc_id, start, count, place, size in zip(
        row["doc_ids"], row["starts"], row["counts"], row["places"], row["sizes"]
    ):
        if wanted is None or doc_id in wanted:
            ids = _parsed(reader.decompress(payload[place : place + size])).astype(ID)
            if len(ids) != count:
                raise ValueError(f"document {doc_id} is damaged")
            out.append((doc_id, before + start, count, ids.tobytes()))
    columns = list(zip(*out)) or [()] * 4
    last = pa.array([zlib.crc32(x) for x in columns[3]], pa.int64()) if crc else pa.array(columns[3], pa.binary())
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:3]), last],
        names=["doc_id", "start", "n_tokens", "ids_crc32" if crc else "ids"],
    )
