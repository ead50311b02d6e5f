"""N-gram Jaccard join: a grouped prefix join on sets of word shingles.

Sets are sorted by a global order, rare shingles first. Two sets that are
similar enough share a shingle among the first few of each (their prefixes), so
only sets that meet there are compared. Documents whose sets have the same size
and the same prefix make one group; groups meet in the lists of the prefix
shingles, are filtered there by size and by what can still be shared after the
place where they meet, and only then expand to members, which are verified on
the whole sets.

Links matter here by what they connect. In each list, the group that may share
the most is first compared with all others, and one member of each group with
its other members; most near copies come together that way, in as many
comparisons as there are members. Then every pair that the filters leave and
that is not yet connected is compared as well, so no link is lost.

The order comes from counts over all documents, in ``BUCKETS`` hashed buckets
of which only the logarithm is kept. Whatever the counts, any order gives the
same links; theirs only decides how many pairs are compared.

Sets are of 64-bit hashes. Defined results: a null or empty text, or one
without words, has no shingles and no link; equal sets are one class and linked;
rows that share an id are one document, linked by any of its texts; a null id
is linked with nothing and has no component. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsync.llm.components import _kept, components
from logsync.llm.text import WordHashes, combined, text_blocks

WIDTH = 4
PERCENT = 85
BUCKETS = 1 << 22
CHUNK = 1 << 16
# Tokens counted before they are added to the buckets of a task.
COUNTED = 1_000_000
# Classes that a task remembers to have handed on.
SEEN = 1_000_000
# A class with more than this share of the documents is sent to all tasks.
HOT_SHARE = 10_000
# So many ids are broadcast to fetch their texts: eight bytes each.
BROADCAST_IDS = 1_000_000


def shingle_set(text: bytes | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of a text's shingles, ascending; a short text is one shingle."""
    # bytes know A-Z and the six ASCII blanks only, as the definition does.
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(combined(hashes.of(words), min(width, len(words))))


def _class_key(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def _need(n: np.ndarray | int, percent: int):
    """Shared shingles that a set of ``n`` needs with any similar set, at least."""
    return -(-percent * n // 100)


def _need_equal(n: int, percent: int) -> int:
    """The same with a set at least as large."""
    return -(-2 * percent * n // (100 + percent))


_SCAN = "doc_id long, n long, class long, chunk int, counts binary"
_SCAN_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("class", pa.int64()),
        ("chunk", pa.int32()),
        ("counts", pa.binary()),
    ]
)


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """A row for each document, and the packed counts of each task, in one pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(BUCKETS, np.uint32)
        waiting: list[np.ndarray] = []
        load = 0
        for batch, texts in text_blocks(batches):
            sets = [shingle_set(t, hashes, width) for t in texts]
            waiting += sets
            load += sum(map(len, sets))
            if load > COUNTED:
                _count(counts, waiting)
                waiting, load = [], 0
            nothing = pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(list(map(len, sets)), pa.int64()),
                    pa.array([_class_key(s) for s in sets], pa.int64()),
                    *nothing,
                ],
                names=["doc_id", "n", "class", "chunk", "counts"],
            )
        _count(counts, waiting)
        pack = zstandard.ZstdCompressor(level=1)
        for chunk in range(BUCKETS // CHUNK):
            some = counts[chunk * CHUNK : (chunk + 1) * CHUNK]
            if some.any():
                row = {"chunk": chunk, "counts": pack.compress(some.tobytes())}
                yield pa.RecordBatch.from_pylist([row], _SCAN_ARROW)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, _SCAN)


def _count(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    if sets:
        np.add.at(counts, (np.concatenate(sets) % np.uint64(BUCKETS)).astype(np.int64), np.uint32(1))


def _levels(scanned: DataFrame) -> np.ndarray:
    """The logarithm of each bucket's count: a byte a bucket, so 4 MB at the driver.

    Tasks add up the counts as they stream in, a chunk of buckets at a time.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                own = sums.setdefault(chunk, np.zeros(CHUNK, np.uint64))
                own += np.frombuffer(unpack.decompress(counts), np.uint32)
        for chunk, own in sums.items():
            level = np.floor(2 * np.log2(np.maximum(own, 1))).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "levels": pa.array([level.tobytes()])})

    counted = scanned.where("chunk IS NOT NULL").select("chunk", "counts")
    levels = np.zeros(BUCKETS, np.uint8)
    for row in counted.repartition("chunk").mapInArrow(add, "chunk int, levels binary").collect():
        at = row["chunk"] * CHUNK
        levels[at : at + CHUNK] = np.frombuffer(row["levels"], np.uint8)
    return levels


def _prefixes(docs: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """``token, grp, class, n, place, strict`` for the prefix shingles of every set.

    ``strict``: the place lies in the shorter prefix that is enough for the
    smaller set of a pair. ``grp`` names a size and a prefix. A task hands on a
    class once for each ``SEEN`` others, so a hot group of copies is about one
    set of each task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, level = WordHashes(), sent.value
        seen: set[int] = set()
        for _, texts in text_blocks(batches):
            tokens, groups, classes, sizes, places, stricts = [], [], [], [], [], []
            for found in (shingle_set(t, hashes, width) for t in texts):
                n = len(found)
                if not n:
                    continue
                own = _class_key(found)
                if own in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(own)
                upto = n - _need(n, percent) + 1
                rank = level[(found % np.uint64(BUCKETS)).astype(np.int64)]
                prefix = found[np.lexsort((found, rank))[:upto]]
                tokens.append(prefix)
                grp = xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=n)
                groups.append(np.full(upto, grp, np.uint64))
                classes.append(np.full(upto, own, np.int64))
                sizes.append(np.full(upto, n, np.int32))
                places.append(np.arange(upto, dtype=np.int32))
                stricts.append(np.arange(upto) < n - _need_equal(n, percent) + 1)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.concatenate(groups).view(np.int64)),
                        *(pa.array(np.concatenate(x)) for x in (classes, sizes, places, stricts)),
                    ],
                    names=["token", "grp", "class", "n", "place", "strict"],
                )

    schema = "token long, grp long, class long, n int, place int, strict boolean"
    return docs.select("text").mapInArrow(cut, schema)


def _met(postings: DataFrame) -> DataFrame:
    """Postings of the tokens that several classes have, each class once.

    They are dealt by token once; what follows works on that, so no text is
    read twice.
    """
    dealt = postings.repartition("token")
    several = (
        dealt.groupBy("token")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("token")
    )
    return dealt.join(several, "token", "left_semi").distinct()


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether sizes and places of two rows of a list allow a link.

    Where two linked sets meet for the first time, what both have left from
    there on is at least what they share.
    """
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    rest = F.least(nx - F.col(f"{x}.place"), ny - F.col(f"{y}.place"))
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (
        (100 + percent) * rest >= percent * (nx + ny)
    )


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _verified(pairs: DataFrame, documents: DataFrame, keys: DataFrame, width: int, percent: int) -> DataFrame:
    """``pairs(a, b)`` of classes with ``linked``, on the whole sets of both.

    One text stands for each class; texts are fetched for the classes in
    question only.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    ids = _kept(keys.join(wanted, "class").select("class", "first_id"), "wanted")
    few = ids.count() <= BROADCAST_IDS
    texts = documents.select("doc_id", "text").join(
        F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("first_id")
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of an id that has several count for their own class only."""
        hashes = WordHashes()
        for batch, found in text_blocks(batches):
            own = [_class_key(shingle_set(t, hashes, width)) for t in found]
            same = [a == b for a, b in zip(own, batch.column("class").to_pylist())]
            yield batch.filter(pa.array(same))

    own = texts.select("class", "text").mapInArrow(keep, "class long, text string").dropDuplicates(["class"])
    own = _kept(own, "texts")
    left = own.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = own.select(F.col("class").alias("b"), F.col("text").alias("text_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, ours in text_blocks(batches, "text_a"):
            theirs = batch.column("text_b").cast(pa.large_binary()).to_pylist()
            linked = []
            for x, y in zip(ours, theirs):
                p, q = shingle_set(x, hashes, width), shingle_set(y, hashes, width)
                shared = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return _kept(joined.mapInArrow(verify, "a long, b long, linked boolean"), "verified")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest id reachable by links, itself included.
    """
    scanned = _kept(_scan(docs, width), "scan")
    rows = scanned.where("chunk IS NULL").select("doc_id", "n", "class")
    known = rows.where("doc_id IS NOT NULL AND n > 0")
    # Equal sets are one class, named by the smallest id that has it.
    keys = known.groupBy("class").agg(F.min("doc_id").alias("first_id"))

    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    lists = _kept(_met(_prefixes(texts, _levels(scanned), width, percent)), "lists")

    members = lists.select("grp", "class").distinct()
    first = members.groupBy("grp").agg(F.min("class").alias("first"))
    groups = lists.drop("class").distinct()

    # Each group of a list, and each member of a group, against one of them.
    hub = groups.groupBy("token").agg(
        F.min_by(F.struct("grp", "n", "place"), F.struct("place", "n", "grp")).alias("y")
    )
    near_hub = (
        groups.alias("x")
        .join(hub, "token")
        .where((F.col("x.grp") != F.col("y.grp")) & _may_link("x", "y", percent))
        .select(F.col("x.grp").alias("grp"), F.col("y.grp").alias("hub"))
        .distinct()
    )
    to_hub = near_hub.join(first.select(F.col("grp").alias("hub"), "first"), "hub").select("grp", "first")
    stars = (
        members.join(to_hub.unionByName(first), "grp")
        .where(F.col("class") != F.col("first"))
        .select(*_pair(F.col("class"), F.col("first")))
        .distinct()
    )
    tried = _verified(_kept(stars, "stars"), texts, keys, width, percent)
    label = components(tried.where("linked").select("a", "b")).withColumnRenamed("node", "class")

    # What is not connected yet, where the lists still allow a link.
    known_as = members.join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
    known_as = _kept(known_as.select("grp", "class", "component"), "members")
    span = known_as.groupBy("grp").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = groups.join(span, "grp")
    mixed = spread.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most"))
    mixed = mixed.where("least <> most").select("token")
    open_lists = _kept(spread.join(mixed, "token", "left_semi"), "open")
    apart = (
        (F.col("x.low") != F.col("y.low"))
        | (F.col("x.high") != F.col("y.high"))
        | (F.col("x.low") != F.col("x.high"))
    )
    # The smaller of a pair meets the other within its strict prefix.
    group_pairs = (
        open_lists.where("strict")
        .alias("x")
        .join(
            open_lists.alias("y"),
            (F.col("x.token") == F.col("y.token"))
            & (F.struct("x.n", "x.grp") < F.struct("y.n", "y.grp"))
            & apart
            & _may_link("x", "y", percent),
        )
        .select(F.col("x.grp").alias("p"), F.col("y.grp").alias("q"))
        .distinct()
    )
    within = span.where("low <> high").select(F.col("grp").alias("p"), F.col("grp").alias("q"))
    left = known_as.select(F.col("grp").alias("p"), F.col("class").alias("c"), F.col("component").alias("of_c"))
    right = known_as.select(F.col("grp").alias("q"), F.col("class").alias("d"), F.col("component").alias("of_d"))
    rest = (
        group_pairs.unionByName(within)
        .join(left, "p")
        .join(right, "q")
        .where("c <> d AND of_c <> of_d")
        .select(*_pair(F.col("c"), F.col("d")))
        .distinct()
        .join(tried.select("a", "b"), ["a", "b"], "left_anti")
    )
    checked = _verified(_kept(rest, "rest"), texts, keys, width, percent)
    links = tried.unionByName(checked).where("linked").select("a", "b")
    return _labelled(rows, known, keys, links)


def _named(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``first_id`` of their class.

    Classes that hold a large share of all rows, of which there can only be
    some thousands, are looked up in each task; texts without words are one of
    them, without a name.
    """
    sizes = rows.groupBy("class").agg(F.count(F.lit(1)).alias("members"))
    least = rows.count() // HOT_SHARE + 1
    hot = _kept(sizes.where(F.col("members") > least).join(keys, "class", "left").select("class", "first_id"), "hot")
    # At most HOT_SHARE rows.
    hot = F.broadcast(hot.withColumn("is_hot", F.lit(True)))
    marked = rows.join(hot, "class", "left")
    cold = marked.where("is_hot IS NULL").drop("first_id", "is_hot").join(keys, "class", "left")
    return cold.unionByName(marked.where("is_hot").select(*cold.columns))


def _labelled(rows: DataFrame, known: DataFrame, keys: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ids, through links of classes and ids that have several texts."""
    several = known.groupBy("doc_id").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    several = several.where("low <> high").select("doc_id")
    shared = known.join(several, "doc_id", "left_semi").join(keys, "class")
    first = keys.select(F.col("class").alias("b"), F.col("first_id").alias("to"))
    edges = (
        links.join(keys, F.col("a") == F.col("class"))
        .join(first, "b")
        .select(F.col("first_id").alias("a"), F.col("to").alias("b"))
        .unionByName(shared.select(F.col("doc_id").alias("a"), F.col("first_id").alias("b")))
    )
    names = components(edges)
    ids = _named(rows, keys)
    return ids.join(names, ids["first_id"] == names["node"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), F.lit(None))
        .when(F.col("n") == 0, F.col("doc_id"))
        .otherwise(F.coalesce("component", "first_id"))
        .alias("component_id"),
    )
