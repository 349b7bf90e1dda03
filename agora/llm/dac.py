"""Token ids as directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level 0 holds the
first chunk of every id, level k the chunk k of those ids that have one. A
bitmap per level tells which ids go on, and a directory holds the number of
set bits before every 512th bit. So id i is found by one lookup per level: its
place on the next level is the rank of its bit. Ids keep their order on every
level, so a range of ids is a range on every level too; no block is decoded.

Tables: ids of documents in ascending (key, hash of the text) order are
written as Parquet, one row per shard of about ``SHARD_IDS`` ids with the
encoded shard in a binary column; a document is never split over shards.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.llm.shared import few
from agora.llm.token_ids import ids_of
from agora.session import work_dir

MAGIC = b"DAC1"
RANK_STEP = 512
SHARD_IDS = 1 << 20
# Bytes of texts that a writing task gets, on average.
TASK_BYTES = 32 << 20
# Width of a run of places that are looked up together.
AT_ONCE = 1 << 16
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class Dac:
    """A sequence of ids (0 to 2**32 - 1) with random access."""

    def __init__(self, size: int, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.size, self.levels = size, levels  # chunks, bitmap bytes, directory

    @classmethod
    def encode(cls, ids: np.ndarray) -> Dac:
        rest, levels = np.asarray(ids, np.uint32), []
        size = len(rest)
        while len(rest) or not levels:
            more = rest > 0xFF
            bitmap = np.packbits(more, bitorder="little")
            ones = np.zeros(-(-len(rest) // RANK_STEP) + 1, np.uint32)
            for_step = np.zeros((len(ones) - 1) * RANK_STEP // 8, np.uint8)
            for_step[: len(bitmap)] = bitmap
            np.cumsum(_ONES[for_step].reshape(-1, RANK_STEP // 8).sum(1, dtype=np.uint32), out=ones[1:])
            levels.append(((rest & 0xFF).astype(np.uint8), bitmap, ones))
            rest = rest[more] >> 8
        return cls(size, levels)

    def to_bytes(self) -> bytes:
        out = [MAGIC, struct.pack("<QI", self.size, len(self.levels))]
        for chunks, bitmap, ones in self.levels:
            out += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bitmap.tobytes(), ones.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> Dac:
        if data[:4] != MAGIC:
            raise ValueError("not a sequence of directly addressable codes")
        (size, count), at, levels = struct.unpack_from("<QI", data, 4), 16, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            parts = []
            for kind, length in (("u1", n), ("u1", -(-n // 8)), ("<u4", -(-n // RANK_STEP) + 1)):
                parts.append(np.frombuffer(data, kind, length, at))
                at += parts[-1].nbytes
            levels.append(tuple(parts))
        return cls(size, levels)

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place ``i``."""
        _, bitmap, ones = self.levels[level]
        step = i // RANK_STEP
        whole = bitmap[step * RANK_STEP // 8 : i // 8]
        last = int(bitmap[i // 8]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(ones[step]) + int(_ONES[whole].sum()) + int(_ONES[last])

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``, the latter excluded."""
        if not 0 <= start <= stop <= self.size:
            raise IndexError((start, stop))
        out = np.zeros(stop - start, np.uint32)
        places = np.arange(stop - start)
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            out[places] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            bits = np.unpackbits(bitmap[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start]
            places = places[bits.astype(bool)]
            if not len(places):
                break
            start = self._rank(level, start)
            stop = start + len(places)
        return out


SHARD = "part int, shard int, n_docs long, n_ids long, doc_ids array<long>, lengths array<long>, codes binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text",
              shard_ids: int = SHARD_IDS) -> None:
    """Encode all texts, ``end`` after each, and write them in ascending key order; a null text is empty, null keys come first.

    Rows of one key are ordered by the hash of their text; they too are spread
    over tasks. A task holds one shard, and the longest document, at a time.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // TASK_BYTES))
    rows = rows.repartitionByRange(tasks, "id", "tie").sortWithinPartitions("id", "tie")

    def shards(batches):
        part, shard, ids, keys, lengths, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def full():
            codes = Dac.encode(np.frombuffer(b"".join(ids), "<u4")).to_bytes()
            values = [[part], [shard], [len(keys)], [held], [keys], [lengths], [codes]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "shard", "n_docs", "n_ids", "doc_ids", "lengths", "codes"]
            return pa.record_batch([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

        work, tail = ids_of(tokenizer).encode, np.asarray([end], "<u4").tobytes()
        for batch in batches:
            for k, t in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                packed = work(t.as_py() or "") + tail
                ids.append(packed)
                keys.append(k)
                lengths.append(len(packed) // 4)
                held += lengths[-1]
                if held >= shard_ids:
                    yield full()
                    shard, ids, keys, lengths, held = shard + 1, [], [], [], 0
        if keys:
            yield full()

    rows.select("id", "text").mapInArrow(shards, SHARD).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``first``, the number of ids before them.

    Sums of shards are taken by part first, so the one window over everything
    sees a row per part only. A shard's place is one narrow row; places are sent
    to the shards (after a count, see ``few``), which stay where they are.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    places = shards.select("part", "shard", "n_ids").withColumn("_inside", inside).join(before, "part")
    places = places.select("part", "shard", (F.col("_before") + F.col("_inside")).alias("first"))
    return shards.join(few(places, "places"), ["part", "shard"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written table: doc_id, start (ids before it), n_tokens, ids (packed 32-bit)."""

    def documents(batches):
        for batch in batches:
            for keys, lengths, codes, first in zip(*(batch.column(c) for c in ("doc_ids", "lengths", "codes", "first")), strict=True):
                sequence, lengths = Dac.from_bytes(codes.as_py()), np.asarray(lengths.as_py(), np.int64)
                at = np.concatenate([[0], np.cumsum(lengths)])
                keys = keys.as_py()
                for a in range(0, len(keys), 256):
                    b = min(a + 256, len(keys))
                    read = sequence.range(at[a], at[b]).astype("<u4").tobytes()
                    cut = 4 * (at[a : b + 1] - at[a])
                    ids = [read[x:y] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    yield pa.record_batch(
                        [pa.array(keys[a:b], pa.int64()), pa.array(at[a:b] + first.as_py()), pa.array(lengths[a:b]), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    columns = read_shards(spark, path).select("doc_ids", "lengths", "codes", "first")
    return columns.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def ids_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """``places`` (column ``at``) with the id at each place of the whole sequence; null and places outside get null.

    Each of repeated places gets its id. Places meet their shard by range join on block numbers of ``SHARD_IDS`` ids. The
    places of a shard are gathered (each once) in runs of ``AT_ONCE``, so a shard is read and parsed once for each run,
    not for each place.
    """
    shards = read_shards(spark, path).select("part", "shard", "first", "n_ids", "codes")
    blocks = F.sequence((F.col("first") / SHARD_IDS).cast("long"), ((F.col("first") + F.col("n_ids") - 1) / SHARD_IDS).cast("long"))
    covered = shards.drop("codes").withColumn("_block", F.explode(blocks))
    asked = places.select(F.col("at").cast("long").alias("at")).distinct().withColumn("_block", (F.col("at") / SHARD_IDS).cast("long"))
    inside = (F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + F.col("n_ids"))
    met = asked.join(covered, "_block").where(inside)
    # A run is a slice of a shard's places by their value, so runs are bounded however many places a shard has.
    run = F.floor((F.col("at") - F.col("first")) / AT_ONCE)
    runs = met.groupBy("part", "shard", run.alias("run")).agg(F.sort_array(F.collect_list(F.col("at") - F.col("first"))).alias("inner"))

    @F.arrow_udf("array<long>")
    def lookup(codes: pa.Array, inner: pa.Array) -> pa.Array:
        found = []
        for c, places_ in zip(codes, inner, strict=True):
            sequence = Dac.from_bytes(c.as_py())
            found.append([sequence[i] for i in places_.as_py()])
        return pa.array(found, pa.list_(pa.int64()))

    read = runs.join(shards.select("part", "shard", "first", "codes"), ["part", "shard"])
    ids = read.select("first", "inner", lookup("codes", "inner").alias("ids"))
    pairs = ids.select("first", F.explode(F.arrays_zip("inner", "ids")).alias("p"))
    known = pairs.select((F.col("first") + F.col("p.inner")).alias("at"), F.col("p.ids").alias("id"))
    return places.join(known, "at", "left")


def new_path(spark: SparkSession) -> str:
    return work_dir(spark, "token-ids")


