"""Stored Bloom filters: which rows of a batch a table may hold already.

Each append leaves one filter per place (time partition and bucket) it wrote
to, sized by its own keys, beside the table. A batch meets the filters of its
places; rows that none of them may hold are new without a look at the table.
Filters have no false negatives, so only the other rows need the stored keys.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora import schemas
from agora.sources import tables

# Bits per key and hash functions: about one row in 2,000 is taken for stored by mistake.
BITS, HASHES = 16, 11
# Keys in one filter at most; more keys of a place make more filters, so that no task holds a large one.
SLICE_KEYS = 1 << 20


def _bits(h: np.ndarray, size: int) -> np.ndarray:
    """(keys, HASHES) places of the bits of hashes ``h`` in a filter of ``size`` bits (a power of two)."""
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) & np.uint64(size - 1)


def filter_bytes(h: np.ndarray) -> bytes:
    size = max(64, 1 << int(np.ceil(np.log2(max(1, len(h)) * BITS))))
    bits = np.zeros(size, bool)
    bits[_bits(h, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(filters: Sequence[bytes], h: np.ndarray) -> np.ndarray:
    """Which of the hashes any of the filters may hold."""
    out = np.zeros(len(h), bool)
    for data in filters:
        words = np.frombuffer(data, np.uint8)
        at = _bits(h, len(words) * 8)
        out |= (words[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(1)
    return out


def _build(rows: pa.Table) -> pa.Table:
    h = rows["h"].to_numpy().view(np.uint64)
    place = [rows["bucket"].slice(0, 1), rows["part"].slice(0, 1)]
    return pa.table([pa.array([len(h)]), pa.array([filter_bytes(h)], pa.binary()), *place], names=["n_keys", "bits", "bucket", "part"])


def add_filters(placed: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Store a filter for each place of ``placed`` (part, bucket, keys), whose rows are about to be appended."""
    h = placed.select("part", "bucket", F.xxhash64(*keys, F.lit(7)).alias("h"))
    counted = h.groupBy("part", "bucket").agg(F.ceil(F.count(F.lit(1)) / SLICE_KEYS).alias("slices"))
    sliced = h.join(counted, ["part", "bucket"]).withColumn("slice", F.pmod(F.xxhash64("h"), F.col("slices"))).drop("slices")
    made = sliced.groupBy("part", "bucket", "slice").applyInArrow(_build, "n_keys long, bits binary, bucket int, part string")
    made.write.mode("append").partitionBy("part").parquet(f"{path.rstrip('/')}-filters")


def _probe(filters: pa.Table, rows: pa.Table) -> pa.Table:
    h = np.unique(rows["h"].to_numpy())
    held = h[may_hold([b.as_py() for b in filters["bits"]], h.view(np.uint64))] if filters.num_rows else h[:0]
    place = [rows[name].slice(0, 1).to_pylist() * len(held) for name in ("part", "bucket")]
    return pa.table([pa.array(place[0], pa.string()), pa.array(place[1], pa.int32()), pa.array(held, pa.int64())], names=["part", "bucket", "h"])


def stored_filters(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    return tables.read_table(spark, f"{path.rstrip('/')}-filters", schemas.KEY_FILTER).where(F.col("part").isin(list(parts)))


def perhaps_stored(placed: DataFrame, path: str, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """``placed`` with ``held``: whether the table at ``path`` may hold the row's key. ``parts``: the partitions of ``placed``."""
    filters = stored_filters(placed.sparkSession, path, parts)
    if filters.isEmpty():
        return placed.withColumn("held", F.lit(False))
    hashed = placed.withColumn("h", F.xxhash64(*keys, F.lit(7)))
    asked = hashed.select("part", "bucket", "h")
    # Only what may be stored comes back, so a batch of new posts is not dealt a second time.
    met = filters.groupBy("part", "bucket").cogroup(asked.groupBy("part", "bucket")).applyInArrow(_probe, "part string, bucket int, h long")
    found = met.withColumn("held", F.lit(True))
    return hashed.join(found, ["part", "bucket", "h"], "left").withColumn("held", F.coalesce("held", F.lit(False))).select(*placed.columns, "held")
