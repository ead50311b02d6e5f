"""Best-fit packing: bin completion over the histogram of piece lengths.

Each document becomes pieces of at most ``capacity`` tokens; only longer ones
are cut, the shorter piece coming first. How many pieces have each length is
all that the search needs: a table of ``capacity`` numbers, whatever the corpus.
It fills sequences around the longest piece left, tries the fillings that no
other dominates, the least waste first, drops what cannot beat the best packing
known, and begins with the best-fit packing. A filling found is used as often
as the counts allow. Memory is bounded by the limits below: one table of counts,
the path of choices, and a number for each state met.

The pieces are then dealt to the places planned for their length by their
number among the pieces of that length, counted within each task and added up
over the tasks, so no length, however common, meets in one task.

Defined results: a null or empty text is its end id alone and is packed;
repeated rows are packed each for itself; null ids keep their place; a table
without rows gives none. Other columns are not carried.
"""

from __future__ import annotations

import bisect
import itertools
import random
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsync.llm.text import text_blocks
from logsync.llm.token_files import _texts
from logsync.llm.tokens import ID, encoder
from logsync.session import run_folder

CAPACITY = 2048
# Limits of the search, which bound its time; none of them drops a piece.
# Fillings tried around one piece; steps between two of them; states looked at
# after the first packing; pieces of a filling whose sums are compared.
BRANCHES = 6
LOOKS = 2_000
STEPS = 2_000
SUBSETS = 8
# So many plan rows, or counts of tasks, are broadcast: a few dozen bytes each.
BROADCAST_ROWS = 500_000

# How often a filling (its lengths in descending order) is used.
Plan = list[tuple[tuple[int, ...], int]]


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing on counts: the longest piece, then the longest that fits."""
    left = dict(counts)
    lengths = sorted(left)
    plan: Plan = []
    while lengths:
        filling, room, at = [], capacity, len(lengths)
        used: Counter[int] = Counter()
        while at:
            at = bisect.bisect_right(lengths, room, 0, at)
            if not at:
                break
            length = lengths[at - 1]
            n = min(left[length] - used[length], room // length)
            if n > 0:
                filling += [length] * n
                used[length] += n
                room -= n * length
            at -= 1
        _use(plan, left, lengths, tuple(filling), used)
    return plan


def _use(plan: Plan, left: dict, lengths: list, filling: tuple, used: Counter, times: int = 0) -> int:
    times = times or min(left[x] // n for x, n in used.items())
    plan.append((filling, times))
    for x, n in used.items():
        left[x] -= n * times
        if not left[x]:
            del left[x]
            lengths.pop(bisect.bisect_left(lengths, x))
    return times


def waste_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs.

    By tokens; by pieces of which no more than k go together; and by what is
    left beside the pieces over half when those below some length are set aside.
    """
    n = np.zeros(capacity + 2, np.int64)
    for x, k in counts.items():
        n[x] = k
    return _bound(n, capacity)


def _bound(n: np.ndarray, capacity: int) -> int:
    length = np.arange(len(n), dtype=np.int64)
    # Pieces, and their tokens, of this length or more.
    pieces, tokens = np.cumsum(n[::-1])[::-1], np.cumsum((n * length)[::-1])[::-1]
    most = np.arange(1, capacity + 1)
    together = -(-pieces[capacity // (most + 1) + 1] // most)
    half = capacity // 2 + 1
    least = np.arange(1, half)
    # No piece of ``least`` or more fits beside those longer than this.
    alone = capacity - least + 1
    room = (pieces[half] - pieces[alone]) * capacity - (tokens[half] - tokens[alone])
    beside = tokens[least] - tokens[half] - room
    over = pieces[half] + np.maximum(0, -(-beside // capacity))
    return int(max(-(-tokens[0] // capacity), together.max(), over.max(initial=0)))


class Completion:
    """The pieces left, changed and restored in place while the search goes on.

    Besides the counts it keeps, for each length, the sums that pieces up to it
    can make (any number of each) as bits of one integer, brought up to date
    where they are asked for.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = np.zeros(capacity + 2, np.int64)
        self.lengths = sorted(x for x, n in counts.items() if n)
        for x, n in counts.items():
            self.left[x] = n
        self.sums = [1] * (capacity + 1)
        self.clean = 0
        signs = random.Random(11)
        self.signs = [signs.getrandbits(128) for _ in range(capacity + 1)]
        # Of the pieces left; 128 bits, so no two states meet by chance.
        self.state = sum(self.signs[x] * n for x, n in counts.items()) % (1 << 128)

    def use(self, filling: tuple[int, ...], times: int) -> None:
        """Takes ``times`` fillings away; puts them back where that is negative."""
        for x, n in Counter(filling).items():
            before = int(self.left[x])
            after = before - n * times
            self.left[x] = after
            self.state = (self.state - self.signs[x] * n * times) % (1 << 128)
            if not before:
                bisect.insort(self.lengths, x)
            elif not after:
                self.lengths.pop(bisect.bisect_left(self.lengths, x))
            if not before or not after:
                self.clean = min(self.clean, x - 1)

    def most(self, filling: tuple[int, ...]) -> int:
        return min(int(self.left[x]) // n for x, n in Counter(filling).items())

    def bound(self) -> int:
        return _bound(self.left, self.capacity)

    def reach(self, top: int) -> None:
        """Brings the sums of pieces up to ``top`` up to date."""
        if self.clean >= top:
            return
        mask = (1 << (self.capacity + 1)) - 1
        sums = self.sums[self.clean]
        for x in range(self.clean + 1, top + 1):
            if self.left[x]:
                step = x
                while step <= self.capacity:
                    sums |= (sums << step) & mask
                    step *= 2
            self.sums[x] = sums
        self.clean = top

    def fillings(self) -> Iterator[tuple[int, ...]]:
        """Undominated fillings around the longest piece, the least waste first.

        The pieces beside it make each sum that fits in turn, from the room
        downwards, the longer ones first. A branch is followed only where the
        pieces of its lengths can make what is missing. Every filling is met
        unless ``LOOKS`` steps go by without one, which only counts of few
        pieces can bring about; then the best fit is the last one.
        """
        for k in range(BRANCHES):
            # What is left is as it was when the next one is asked for, so the
            # ones before are met again and passed over.
            longest = self.lengths[-1]
            self.left[longest] -= 1
            try:
                found = next(itertools.islice(self._around(longest), k, None), None)
            finally:
                self.left[longest] += 1
            if found is None:
                return
            yield found

    def _around(self, longest: int) -> Iterator[tuple[int, ...]]:
        room = self.capacity - longest
        top = min(room, longest)
        self.reach(top)
        self.looked = 0
        used: Counter[int] = Counter()
        for waste in range(room + 1):
            total = room - waste
            if not self.sums[top] >> total & 1:
                continue
            for rest in self._making(total, top, used):
                if not self._dominated(rest, used, waste):
                    yield (longest, *rest)
                    self.looked = 0
                if self.looked > LOOKS:
                    break
            if self.looked > LOOKS:
                yield (longest, *self._best_fit(room))
                return
            if waste and not total:
                return

    def _making(self, total: int, top: int, used: Counter) -> Iterator[list[int]]:
        """Pieces of ``top`` or less in descending order that make ``total``.

        ``used`` holds the pieces of the filling while the caller has it.
        """
        chosen: list[int] = []
        # For each piece chosen, and for the next one: where to look on.
        at = [bisect.bisect_right(self.lengths, min(top, total)) - 1]
        while at:
            self.looked += 1
            if not total:
                yield chosen
                if self.looked > LOOKS:
                    return
                at[-1] = -1
            i = at[-1]
            while i >= 0:
                x = self.lengths[i]
                if self.sums[x] >> total & 1 == 0:
                    # Pieces up to this one do not make it, so no shorter ones do.
                    i = -1
                elif self.left[x] > used[x] and self.sums[x] >> (total - x) & 1:
                    break
                else:
                    i -= 1
            if i >= 0 and self.looked <= LOOKS:
                x = self.lengths[i]
                at[-1] = i - 1
                used[x] += 1
                chosen.append(x)
                total -= x
                at.append(min(i, bisect.bisect_right(self.lengths, total) - 1))
            else:
                at.pop()
                if chosen:
                    x = chosen.pop()
                    used[x] -= 1
                    total += x

    def _dominated(self, rest: list[int], used: Counter, waste: int) -> bool:
        """Whether a piece left out fits, by itself or in place of shorter ones together."""
        sums = {0}
        for x in rest[: SUBSETS]:
            sums |= {s + x for s in sums}
        alone = set(rest)
        for s in sums:
            low = bisect.bisect_right(self.lengths, s) if s in alone or not s else bisect.bisect_left(self.lengths, s)
            for i in range(low, bisect.bisect_right(self.lengths, s + waste)):
                x = self.lengths[i]
                if self.left[x] > used[x]:
                    return True
        return False

    def _best_fit(self, room: int) -> list[int]:
        out: list[int] = []
        i = bisect.bisect_right(self.lengths, room)
        while i:
            i = min(i, bisect.bisect_right(self.lengths, room))
            if i:
                x = self.lengths[i - 1]
                n = min(int(self.left[x]), room // x)
                out += [x] * n
                room -= n * x
                i -= 1
        return out


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """As few sequences as the search finds.

    It goes depth first over one set of counts, changed and restored in place,
    and keeps the path, the best plan and 16 bytes for each state met. It has
    found the fewest where they equal ``waste_bound`` or where it ends by itself
    before ``STEPS`` states after its first packing, with no node cut off at
    ``BRANCHES`` or ``LOOKS``. ``sequences_needed`` tells which.
    """
    best = best_fit(counts, capacity)
    fewest = sum(times for _, times in best)
    root = waste_bound(counts, capacity)
    pieces = Completion(counts, capacity)
    reached: dict[int, int] = {}
    # The path: the choices that a node still has, and the one that is in use.
    path: list[tuple[Iterator[tuple[tuple[int, ...], int]], list]] = []
    sequences, steps, ended = 0, 0, False

    def choices() -> Iterator[tuple[tuple[int, ...], int]]:
        for filling in pieces.fillings():
            most = pieces.most(filling)
            # As often as may be, or once; more often by choosing it again.
            for times in (most, 1)[: 1 + (most > 1)]:
                yield filling, times

    def worth() -> bool:
        if sequences + pieces.bound() >= fewest:
            return False
        if reached.get(pieces.state, sequences + 1) <= sequences:
            return False
        reached[pieces.state] = sequences
        return True

    # The first packing is followed to its end whatever the best fit needs.
    path.append((choices(), []))
    while path and fewest > root and steps < STEPS:
        open_choices, in_use = path[-1]
        if in_use:
            filling, times = in_use.pop()
            pieces.use(filling, -times)
            sequences -= times
        chosen = next(open_choices, None) if pieces.lengths else None
        if chosen is None:
            path.pop()
            continue
        filling, times = chosen
        pieces.use(filling, times)
        sequences += times
        in_use.append(chosen)
        steps += ended
        if not pieces.lengths:
            ended = True
            if sequences < fewest:
                best, fewest = [own[0] for _, own in path], sequences
        elif not ended or worth():
            path.append((choices(), []))
    return best


def sequences_needed(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences of the plan, and how many any plan needs at least."""
    return sum(times for _, times in pack(counts, capacity)), waste_bound(counts, capacity)


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; the first takes what the others leave."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def write_pieces(docs: DataFrame, tokenizer: str, capacity: int, path: str, with_ids: bool = False) -> None:
    """A row for each piece, numbered among those of its length within the task."""
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    schema = fields + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch, texts in text_blocks(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode_all(_texts(texts))):
                for piece, (start, length) in enumerate(cut_pieces(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(own), part, int(seen[length]), own))
                    seen[length] += 1
            columns = list(zip(*rows)) or [()] * 8
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = [f.split()[0] for f in fields.split(", ")] + ["ids"]
            upto = len(names) if with_ids else len(names) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns[:upto], types)], names=names[:upto]
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows.mapInArrow(cut, schema).write.mode("error").parquet(path)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs(doc_id, text)`` with ``sequence_id`` and ``offset``.

    ``with_ids`` adds the ids of each piece, as little-endian unsigned 32-bit
    integers; ``sequences`` puts them together.
    """
    spark = docs.sparkSession
    path = run_folder(spark, "pieces")
    write_pieces(docs, tokenizer, capacity, path, with_ids)
    pieces = spark.read.parquet(path)
    by_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(pack(counts, capacity))
    schema = "length long, first_nth long, sequence long, every long, place long"
    plan = spark.createDataFrame(slots, schema)
    # Tasks times lengths; where that is too much to send, they are joined.
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    earlier = by_task.select("length", "part", F.coalesce(before, F.lit(0)).alias("earlier"))
    if by_task.count() <= BROADCAST_ROWS:
        earlier = F.broadcast(earlier)
    numbered = pieces.join(earlier, ["length", "part"]).withColumn("nth", F.col("nth") + F.col("earlier"))
    # The plan of a length: its slots in ascending order, of which the last that
    # begins at or before the piece's number holds it. Rows: lengths of all
    # fillings, bounded by the search.
    by_length = plan.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("first_nth", "sequence", "every", "place"))).alias("slots")
    )
    placed = numbered.join(F.broadcast(by_length), "length").withColumn(
        "slot", F.element_at(F.filter("slots", lambda s: s["first_nth"] <= F.col("nth")), -1)
    )
    at = F.col("nth") - F.col("slot.first_nth")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.sequence") + F.floor(at / F.col("slot.every"))).alias("sequence_id"),
        (F.col("slot.place") + F.pmod(at, F.col("slot.every")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )


def _slots(plan: Plan) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go, as runs of numbers.

    A filling used so many times from some sequence on takes, for a length that
    it holds ``every`` times, that many pieces in a row for each sequence.
    """
    taken: Counter[int] = Counter()
    out, sequence = [], 0
    for filling, times in plan:
        place = 0
        for length, every in sorted(Counter(filling).items(), reverse=True):
            out.append((length, taken[length], sequence, every, place))
            taken[length] += every * times
            place += every * length
        sequence += times
    return out


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences; each group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")
    )
