"""Registered queries: file streams run to the end over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from agora.catalog.registry import query
from agora.session import work_dir
from agora.sources import sample_posts as sample
from agora.sources import tables
from agora.streaming.ingest import latest, stream_ingest, stream_upsert, write_first

_POSTS_SQL = """SELECT CAST(event_id AS VARCHAR) AS source_id, epoch_us(ts) AS posted_at, 'u_' || CAST(user_id AS VARCHAR) AS username,
  CAST(floor(value) AS BIGINT) AS upvote_count FROM events"""


def _as_posts(df, *more):
    return df.select(
        *more,
        F.lit(2).alias("platform_id"),
        F.col("event_id").cast("string").alias("source_id"),
        F.col("ts").cast("timestamp").alias("posted_at"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("username"),
        F.floor("value").alias("upvote_count"),
    )


def _feed(spark, sf):
    """The events as a feed of files in which part of the posts arrives twice."""
    path = work_dir(spark, "feed")
    events = sample.read(spark, sf, "events")
    events.write.parquet(path)
    events.where("value > 10").write.mode("append").parquet(path)
    return path, events.schema


def _shown(df):
    return df.select("source_id", F.unix_micros("posted_at").alias("posted_at"), "username", "upvote_count")


@query("stream_ingest", _POSTS_SQL)
def stream_ingest_(spark, sf):
    """A feed with repeats ingested twice from scratch: every post is stored once."""
    feed, schema = _feed(spark, sf)
    out = work_dir(spark, "facts")
    for _ in range(2):
        run = stream_ingest(
            spark, feed, schema, out, work_dir(spark, "progress"), to_rows=_as_posts, files_per_batch=4
        )
        run.awaitTermination()
    rows = _as_posts(spark.createDataFrame([], schema)).schema
    return _shown(tables.read_table(spark, out, rows))


@query(
    "stream_dedup",
    f"""{_POSTS_SQL} UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), epoch_us(CAST(o_orderdate AS TIMESTAMP)),
  'u_' || CAST(o_custkey AS VARCHAR), CAST(floor(o_totalprice) AS BIGINT) FROM orders""",
)
def stream_dedup_(spark, sf):
    """Repeated captures of events and of orders, which are years older: the first of each post is kept."""
    events = sample.read(spark, sf, "events").selectExpr("CAST(event_id AS string) AS event_id", "ts", "user_id", "value")
    orders = sample.read(spark, sf, "orders").selectExpr(
        "concat('o', o_orderkey) AS event_id", "o_orderdate AS ts", "o_custkey AS user_id", "o_totalprice AS value"
    )
    out, mixed = work_dir(spark, "unique"), work_dir(spark, "mixed")
    events.write.parquet(mixed)
    for more in (events.where("value > 10"), orders):
        more.write.mode("append").parquet(mixed)
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 4).parquet(mixed)
    captured = F.col("_metadata.file_modification_time").alias("captured_at")
    posts = _as_posts(stream.select("*", captured), "captured_at")
    run = write_first(posts, out, work_dir(spark, "progress"), keys=["source_id"], captured="captured_at", delay="60 days")
    run.awaitTermination()
    return _shown(spark.read.schema(posts.schema).parquet(out))


@query(
    "stream_upsert",
    """SELECT CAST(user_id AS VARCHAR) AS id, CAST(max(event_id) AS BIGINT) AS event_id, arg_max(event_type, event_id) AS event_type,
  arg_max(value, event_id) AS value FROM events GROUP BY user_id""",
)
def stream_upsert_(spark, sf):
    """A feed of captures added to a log, in which buckets are compacted: the last capture of each id is read."""
    feed, schema = _feed(spark, sf)
    out = work_dir(spark, "raw")

    def captures(df):
        return df.select(
            F.col("user_id").cast("string").alias("id"),
            F.lit("2024-01-01").cast("timestamp").alias("posted_at"),
            "event_id", "event_type", "value",
        )

    run = stream_upsert(
        spark, feed, schema, out, work_dir(spark, "progress"),
        to_rows=captures, keys=["id", "posted_at"], arrival=["event_id"], files_per_batch=4,
    )
    run.awaitTermination()
    rows = captures(spark.createDataFrame([], schema)).schema
    return latest(spark, out, rows, ["id", "posted_at"], ["event_id"]).select("id", "event_id", "event_type", "value")
