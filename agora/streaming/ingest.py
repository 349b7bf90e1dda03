"""File streams: load new posts exactly once, keep the last capture of each, drop repeated captures."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from agora.operators.bloom import add_filters, perhaps_stored
from agora.operators.load import FACT_KEY
from agora.operators.raw import dedup_keep_last
from agora.session import work_dir
from agora.sources import tables
from agora.sources.layout import BUCKET, PLACE, Layout, layout_of
from agora.streaming.capture_log import CaptureLog

# State is kept on executors' disks; a task holds a bounded part of it, and a micro-batch writes its changes only.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Counting keys would look each one up a second time.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
STATE_TASKS_PER_CORE = 4


def append_new(
    batch: DataFrame, path: str, schema: StructType, keys: Sequence[str] = FACT_KEY, grain: str = "year",
    first_year: int = tables.FIRST_YEAR, last_year: int = tables.LAST_YEAR, buckets: int = 64,
) -> None:
    """Append the rows of one batch the table lacks; safe to repeat.

    Rows that no stored filter of their place may hold are new. The others meet
    the stored keys of their own partitions and buckets, so a batch of new posts reads no file of the
    table. Grain, years and buckets are those of the table once it exists.
    """
    spark = batch.sparkSession
    layout = layout_of(spark, path, Layout(keys, grain, buckets, first_year, last_year))
    order = [c for c in batch.columns if c not in keys]
    # Stored in the shared folder: the steps below read the batch again, whatever becomes of executors.
    rows = _kept(layout.place(dedup_keep_last(batch, keys, order)), "batch")
    parts = tables.touched_partitions(rows)
    if not parts:
        return
    judged = _kept(perhaps_stored(rows, path, keys, parts), "judged")
    fresh = judged.where(~F.col("held")).drop("held")
    perhaps = judged.where("held").drop("held")
    # At most as many places as the table has.
    places = perhaps.select(*PLACE).distinct().collect()
    if places:
        where = F.struct(*PLACE).isin([F.struct(F.lit(p).alias(tables.PART), F.lit(b).alias(BUCKET)) for p, b in places])
        pruned = F.col(tables.PART).isin(sorted({p for p, _ in places})) & F.col(BUCKET).isin(sorted({b for _, b in places}))
        full = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
        stored = tables.read_table(spark, path, full).where(pruned & where)
        # Stored, so that filters and table get the same rows.
        fresh = _kept(fresh.unionByName(perhaps.join(stored.select(*keys), list(keys), "left_anti")), "fresh")
    # Filters come first: a run that dies in between leaves a filter too many, never one too few.
    add_filters(fresh, path, keys)
    tables.append_table(fresh, path, PLACE)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_latest(
    batch: DataFrame, path: str, schema: StructType, keys: Sequence[str], arrival: Sequence[str], grain: str = "quarter",
    first_year: int = tables.FIRST_YEAR, last_year: int = tables.LAST_YEAR, buckets: int = 64, compact_at: int = 8,
) -> None:
    """Add one batch of captures to the log at ``path``, the last capture of each key by ``arrival`` winning.

    Nothing stored is read; buckets with ``compact_at`` segments or more are compacted.
    """
    log = CaptureLog(batch.sparkSession, path, schema, arrival, Layout(keys, grain, buckets, first_year, last_year))
    log.append(batch)
    log.compact(compact_at)


def latest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], arrival: Sequence[str],
           parts: Sequence[str] | None = None) -> DataFrame:
    """The table ``merge_latest`` and ``stream_upsert`` write: the last capture of each key."""
    return CaptureLog(spark, path, schema, arrival, Layout(keys)).read(parts)


def _run(rows: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _files(spark: SparkSession, source: str, schema: StructType, per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(source)


def stream_ingest(
    spark: SparkSession,
    source: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    *,
    to_rows: Callable[[DataFrame], DataFrame] = lambda df: df,
    keys: Sequence[str] = FACT_KEY,
    files_per_batch: int = 1000,
    **layout,
) -> StreamingQuery:
    """Append the posts of the files that arrived since the last run, then stop.

    The checkpoint remembers finished files; a batch repeated after a failure
    finds its rows already stored and adds only what is missing. ``layout``:
    grain, years and buckets of a new table.
    """
    rows = to_rows(_files(spark, source, schema, files_per_batch))
    return _run(rows, checkpoint, lambda batch, _: append_new(batch, out, rows.schema, keys, **layout))


def stream_upsert(
    spark: SparkSession,
    source: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    arrival: Sequence[str],
    to_rows: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int = 1000,
    **layout,
) -> StreamingQuery:
    """Keep the last capture of each post from the files that arrived since the last run, then stop; ``latest`` reads the result."""
    rows = to_rows(_files(spark, source, schema, files_per_batch))
    return _run(rows, checkpoint, lambda batch, _: merge_latest(batch, out, rows.schema, keys, arrival, **layout))


def _outermost(captured: pa.Array, *keys: pa.Array) -> pa.Array:
    """Of each key's rows in one Arrow batch: the earliest and the latest capture, and those without a time."""
    n = len(captured)
    codes = np.zeros(n, np.int64)
    for key in keys:
        if pa.types.is_nested(key.type):
            key = pa.array(map(repr, key.to_pylist()), pa.string())
        more = key.dictionary_encode("encode").indices.to_numpy()
        codes = np.unique(codes * n + more, return_inverse=True)[1]
    keep = captured.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((captured.fill_null(0).to_numpy(), keep, codes))
    edge = np.diff(codes[order] * 2 + keep[order], prepend=-1, append=-1) != 0
    keep = keep.copy()
    keep[order[edge[:-1] | edge[1:]]] = True
    return pa.array(keep)


def stream_dedup(df: DataFrame, keys: Sequence[str], captured: str, delay: str) -> DataFrame:
    """First capture of each key within ``delay``, by the time of capture.

    ``captured`` is when a row arrived (of a file stream: the file's time), not
    when the post was written: posts of any age may arrive, and none is late
    unless its file is older than the newest by more than ``delay``. Copies are
    dropped where they are read, per Arrow batch, so a post captured over and
    over is not sent to one task copy by copy; the latest of a batch is
    sent as well as the earliest, which may be late. Each key is stored once. State is
    bounded by the watermark; choose ``delay`` no shorter than the time after
    which posts are still captured again. ``stream_upsert`` keeps the last
    capture instead and needs no watermark.
    """
    # Not deterministic, so that no filter above or below is evaluated together with it.
    outermost = F.arrow_udf(_outermost, "boolean").asNondeterministic()
    thinned = df.where(outermost(F.unix_micros(captured), *keys))
    return thinned.withWatermark(captured, delay).dropDuplicatesWithinWatermark(list(keys))


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """Settings a stream takes over when it starts; the session's own are put back.

    AQE cannot merge state partitions, and each writes files in every
    micro-batch, so a number made for shuffles of the whole input is cut to the cores.
    """
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(shuffles, STATE_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    wanted = {**STATE, "spark.sql.shuffle.partitions": str(tasks)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_first(
    df: DataFrame, out: str, checkpoint: str, *, keys: Sequence[str], captured: str, delay: str
) -> StreamingQuery:
    """Append the first capture of each key (``stream_dedup``) to the Parquet files at ``out``, then stop.

    The checkpoint holds the state and its number of partitions for good.
    """
    with _state_settings(df.sparkSession):
        return (
            stream_dedup(df, keys, captured, delay).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(out)
        )
