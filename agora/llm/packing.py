"""Best-fit packing: a bounded number of open bins, found through a bitset keyed by free space.

Documents longer than the capacity are cut into pieces of the capacity, the
first piece taking the rest. Pieces stream through each task; a piece goes to
the open bin with the least free space that holds it, else to a new bin. When
all bins are open, the fullest closes first. One bit per amount of free space
says whether an open bin has it, so a placement costs a few integer
operations, and a task holds ``open_bins`` bins whatever the data.

Pieces are dealt out by hash, ``PIECES_PER_TASK`` to a task, so that a task's
last open bins waste a vanishing share.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.shared import stored

CAPACITY = 1024
OPEN_BINS = 512
PIECES_PER_TASK = 250_000


class Bins:
    """Open bins of one stream of pieces."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free = [[] for _ in range(capacity + 1)]  # free space -> bins that have it
        self.bits, self.open, self.made = 0, 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 0 to ``capacity`` tokens."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        same = self.free[space]
        number = same.pop()
        if not same:
            self.bits ^= 1 << space
        self.open -= 1
        return number


def cut(ids: Column, capacity: int = CAPACITY) -> Column:
    """Array of (piece, start, length, ids_crc32) of packed 32-bit ids; an empty or null text has none."""
    n = F.coalesce(F.octet_length(ids) / 4, F.lit(0)).cast("long")
    first = F.when(n % capacity == 0, F.lit(capacity)).otherwise(n % capacity)

    def piece(p: Column) -> Column:
        start = F.when(p == 0, F.lit(0)).otherwise(first + (p - 1) * capacity).cast("long")
        length = F.when(p == 0, first).otherwise(F.lit(capacity)).cast("long")
        part = F.substring(ids, (start * 4 + 1).cast("int"), (length * 4).cast("int"))
        return F.struct(p.cast("int").alias("piece"), start.alias("start"), length.alias("length"), F.crc32(part).alias("ids_crc32"))

    pieces = F.transform(F.sequence(F.lit(0), F.ceil(n / capacity).cast("int") - 1), piece)
    return F.when(n > 0, pieces).otherwise(F.slice(pieces, 1, 0))


def pack(pieces: DataFrame, key: list[str], length: str = "length", capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``key`` orders them repeatably.

    Lengths outside 0 to ``capacity`` and null lengths are refused with an
    error. Repeated rows are pieces of their own.
    """
    number = max(1, -(-pieces.count() // per_task))
    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    order = F.xxhash64(*[F.col(c) for c in key])
    dealt = pieces.select(*rest).withColumn("_order", order)
    dealt = dealt.repartition(number, "_order", *key).sortWithinPartitions("_order", *key)
    schema = dealt.drop("_order").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        bins, task = Bins(capacity, open_bins), TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column(length).to_pylist()
            if any(n is None or not 0 <= n <= capacity for n in lengths):
                raise ValueError(f"a piece's length is not between 0 and {capacity}")
            placed = [bins.place(n) for n in lengths]
            columns = [batch.column(c) for c in rest]
            columns.append(pa.array([(task << 40) + b for b, _ in placed], pa.int64()))
            columns.append(pa.array([o for _, o in placed], pa.int64()))
            yield pa.record_batch(columns, names=[*rest, "sequence_id", "offset"])

    return dealt.drop("_order").mapInArrow(run, schema)


def pack_ids(docs: DataFrame, ids: Column, key: str = "doc_id", capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    rows = docs.select(F.col(key).alias(key), ids.alias("_ids"))
    pieces = rows.select(key, F.inline(cut(F.col("_ids"), capacity)))
    return pack(stored(pieces, "pieces"), [key, "piece", "ids_crc32"], "length", capacity, open_bins)
