"""What the operators share: session limits, shared tables, Arrow texts, the hold-out rule."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.session import pin, work_dir

# Python workers get texts in batches of this many rows and bytes at most (one longer text goes alone).
BATCH_ROWS = 1024
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: UTC, AQE, bounded Arrow batches."""
    pin(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: lost executors cost no recomputation."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Ids that may be sent to every executor: 8 MB of numbers.
FEW_IDS = 1_000_000


def few(ids: DataFrame, name: str) -> DataFrame:
    """A narrow table of ids, stored and counted: marked for broadcasting up to ``FEW_IDS`` rows.

    A longer one is joined by Spark's own choice, with a shuffle where needed.
    """
    ids = stored(ids, name)
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id") -> Column:
    """Rows a model must not learn from: crc32 of the id as text leaves 1 when divided by 3. Null ids: false."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Spark's own ``lower`` serves texts of ASCII bytes only, which is most of them."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def grouped(batches, keys: list[str]):
    """The rows of each key as a table; rows with equal (whole, not null) ``keys`` follow one another in ``batches``."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        if not rows.num_rows:
            continue
        at = np.stack([rows[k].to_numpy() for k in keys], 1)
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1])
    if held is not None:
        yield held


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each text begins and ends (length + 1 numbers). Null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return raw, ends - ends[0]


def portions(ends: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of texts with at most ``most`` bytes together; a longer text is a range of its own."""
    out, first = [], 0
    while first < len(ends) - 1:
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = max(last, first + 1)
        out.append((first, last))
        first = last
    return out
