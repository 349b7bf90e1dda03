"""Registered queries: the raw layer, loading and partitioned storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from agora import schemas
from agora.catalog import sql as S
from agora.catalog.registry import SQL, query
from agora.catalog.star import facts, resolved, shown_view
from agora.functions import posts as P
from agora.operators import load, raw
from agora.operators.keys import surrogate_keys
from agora.plans import views
from agora.plans.warehouse import Warehouse
from agora.session import work_dir
from agora.sources import sample_posts as sample
from agora.sources import tables


def _micros(name="posted_at"):
    return F.unix_micros(name).alias(name)


@query(
    "union_platforms",
    f"""WITH {S.POSTS} SELECT source_type, id, username, epoch_us(posted_at) AS posted_at, coalesce(subreddit, 'none') AS subreddit,
  coalesce(CAST(score AS VARCHAR), 'none') AS score, coalesce(permalink, 'none') AS permalink,
  CAST(like_count + retweet_count + comment_count + quote_count AS BIGINT) AS x_counts FROM posts""",
)
def union_platforms(spark, sf):
    """Both platforms in one frame; what a platform lacks is null."""
    both = raw.union_platforms(sample.x_posts(spark, sf), sample.reddit_posts(spark, sf))
    gap = [F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in ("subreddit", "score", "permalink")]
    counts = sum((F.col(c).cast("long") for c in ("retweet_count", "comment_count", "quote_count")), F.col("like_count"))
    return both.select("source_type", "id", "username", _micros(), *gap, counts.cast("long").alias("x_counts"))


@query(
    "prepare_raw",
    """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'u_' || CAST(user_id AS VARCHAR) END AS username,
  CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE floor(value) END AS BIGINT) AS upvote_count, CAST(0 AS BIGINT) AS downvote_count,
  CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE floor(value) END AS BIGINT) AS score, epoch_us(ts) AS scraped_at FROM events""",
)
def prepare_raw(spark, sf):
    """Scraped rows with gaps, NaN and columns the table lacks, cut to the table."""
    e = sample.read(spark, sf, "events")
    scraped = e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("u_"), F.col("user_id").cast("string"))).alias("username"),
        F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.floor("value")).alias("upvote_count"),
        F.lit(None).cast("int").alias("downvote_count"),
        F.when(F.col("event_id") % 3 != 0, F.floor("value")).alias("score"),
        F.col("ts").cast("timestamp").alias("captured"),
    )
    out = raw.prepare_raw(
        scraped.withColumnRenamed("captured", "scraped_at").withColumn("junk", F.lit("x")),
        schemas.RAW_REDDIT,
        schemas.REDDIT_COUNTS,
    )
    counts = [F.col(c).cast("long").alias(c) for c in schemas.REDDIT_COUNTS]
    return out.select("id", "username", *counts, _micros("scraped_at"))


def _captures(spark, sf):
    """Events as repeated captures of users' posts: ids repeat, event_id is the order of arrival."""
    return sample.read(spark, sf, "events").select(
        F.col("event_type").alias("source_type"), F.col("user_id").alias("id"), "event_id", "value", "props"
    )


@query(
    "dedup_keep_last",
    """SELECT source_type, id, event_id, value, props FROM (
  SELECT event_type AS source_type, user_id AS id, event_id, value, props,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""",
)
def dedup_keep_last(spark, sf):
    return raw.dedup_keep_last(_captures(spark, sf), ["source_type", "id"], ["event_id"])


_UPSERT_SQL = """
target AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS posted_at, 'old ' || o_orderpriority AS text_content,
    CAST(floor(o_totalprice) AS BIGINT) AS like_count, o_orderkey % 2 = 0 AS is_processed
  FROM orders WHERE o_orderstatus <> 'F'),
source AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS posted_at,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'new ' || o_orderpriority END AS text_content, o_custkey AS like_count
  FROM orders WHERE o_orderstatus <> 'O')"""


def _target(spark, sf):
    o = sample.read(spark, sf, "orders").where("o_orderstatus <> 'F'")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("posted_at"),
        F.concat(F.lit("old "), "o_orderpriority").alias("text_content"),
        F.floor("o_totalprice").alias("like_count"),
        (F.col("o_orderkey") % 2 == 0).alias("is_processed"),
    )


def _source(spark, sf):
    o = sample.read(spark, sf, "orders").where("o_orderstatus <> 'O'")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("posted_at"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("new "), "o_orderpriority")).alias("text_content"),
        F.col("o_custkey").alias("like_count"),
    )


@query(
    "upsert_raw",
    f"""WITH {_UPSERT_SQL}
SELECT coalesce(s.id, t.id) AS id, CAST(coalesce(s.posted_at, t.posted_at) AS VARCHAR) AS posted_at,
  CASE WHEN s.id IS NULL THEN t.text_content ELSE s.text_content END AS text_content,
  CASE WHEN s.id IS NULL THEN t.like_count ELSE s.like_count END AS like_count,
  coalesce(t.is_processed, false) AS is_processed
FROM target t FULL OUTER JOIN source s ON t.id = s.id AND t.posted_at = s.posted_at""",
)
def upsert_raw(spark, sf):
    """Closed and pending orders merged over open and pending ones."""
    merged = raw.upsert_raw(_target(spark, sf), _source(spark, sf))
    return merged.withColumn("posted_at", F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "delete_by_ids",
    """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def delete_by_ids(spark, sf):
    ids = sample.read(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return raw.delete_by_ids(sample.read(spark, sf, "orders"), ids, ["o_orderkey"]).select("o_orderkey")


@query(
    "mark_processed",
    """SELECT o_orderkey AS id, o_orderstatus = 'F' OR o_orderkey IN (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS is_processed FROM orders""",
)
def mark_processed(spark, sf):
    posts = sample.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").alias("is_processed")
    )
    ids = sample.read(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return raw.mark_processed(posts, ids, ["id"])


@query(
    "config_lookup",
    """WITH config AS (SELECT 'c' || CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS value FROM customer
  UNION ALL SELECT 'd' || CAST(doc_id AS VARCHAR), CAST(quality AS VARCHAR) FROM labels),
asked AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) AS key FROM orders UNION ALL SELECT 'd' || CAST(doc_id AS VARCHAR) FROM documents)
SELECT a.key, CASE WHEN c.key IS NULL THEN 'default' ELSE c.value END AS value, count(*) AS lookups
FROM asked a LEFT JOIN config c ON a.key = c.key GROUP BY ALL""",
)
def config_lookup(spark, sf):
    """Key/value lookups by every order and document; a key the table lacks (a document without labels) gets the default."""

    def entry(name, letter, key, value=None):
        shown = [F.concat(F.lit(letter), F.col(key).cast("string")).alias("key")]
        return sample.read(spark, sf, name).select(*shown, *([] if value is None else [F.col(value).cast("string").alias("value")]))

    config = entry("customer", "c", "c_custkey", "c_mktsegment").unionByName(entry("labels", "d", "doc_id", "quality"))
    asked = entry("orders", "c", "o_custkey").unionByName(entry("documents", "d", "doc_id"))
    keys = asked.groupBy("key").agg(F.count(F.lit(1)).alias("lookups"))
    found = raw.config_lookup(config, keys, "default")
    # A key the table holds twice counts twice, as in a plain join.
    return found.groupBy("key", "value").agg(F.sum("lookups").alias("lookups"))


@query(
    "config_upsert",
    """SELECT coalesce(n.key, o.key) AS key, CASE WHEN n.key IS NULL THEN o.value ELSE n.value END AS value
FROM (SELECT CAST(doc_id AS VARCHAR) AS key, CAST(quality AS VARCHAR) AS value FROM labels) o
FULL OUTER JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS key, CAST(s_nationkey AS VARCHAR) AS value FROM supplier) n ON o.key = n.key""",
)
def config_upsert(spark, sf):
    """Key/value entries written over a configuration table: known keys change, new ones are added, the others stay."""
    config = sample.read(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("key"), F.col("quality").cast("string").alias("value"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    entries = sample.read(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_nationkey").cast("string").alias("value")
    )
    return raw.set_config(config, entries).select("key", "value")


_PART = """CASE WHEN year(posted_at) BETWEEN 2023 AND 2026 THEN CAST(year(posted_at) AS VARCHAR){q} ELSE 'default' END"""


@query(
    "partition_layout",
    f"""WITH {S.POSTS} SELECT source_type, {_PART.format(q=" || '_q' || CAST(quarter(posted_at) AS VARCHAR)")} AS part,
  count(*) AS row_count FROM posts GROUP BY ALL""",
)
def partition_layout(spark, sf):
    """Rows per quarterly partition, the catch-all included."""
    posts = tables.with_partition(sample.posts(spark, sf), "quarter")
    return posts.groupBy("source_type", "part").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "append_fact",
    f"""WITH {S.RESOLVED} SELECT id AS source_id, CAST(platform_id AS BIGINT) AS platform_id, CAST(time_id AS BIGINT) AS time_id,
  engagement_tier, score_parts, {_PART.format(q="")} AS part FROM facts""",
)
def append_fact(spark, sf):
    """Facts written to yearly partitions and read back."""
    path = work_dir(spark, "fact")
    tables.append_table(tables.with_partition(facts(spark, sf)[0], "year"), path)
    stored = tables.read_table(spark, path, schemas.FACT)
    return stored.select(
        "source_id", F.col("platform_id").cast("long").alias("platform_id"), F.col("time_id").cast("long").alias("time_id"),
        "engagement_tier", (F.col("sentiment_score") * 10000).cast("long").alias("score_parts"), "part",
    )


@query(
    "time_window_filter",
    f"""WITH {S.POSTS} SELECT source_type, id, epoch_us(posted_at) AS posted_at FROM posts
WHERE posted_at >= TIMESTAMP '2024-01-01' AND posted_at < TIMESTAMP '2025-01-01'""",
)
def time_window_filter(spark, sf):
    """Posts of the half-open window of one year."""
    since, until = P.year_window(2024)
    return raw.time_window_filter(sample.posts(spark, sf), since, until).select("source_type", "id", _micros())


@query(
    "read_window",
    f"""WITH {S.POSTS} SELECT source_type, id, epoch_us(posted_at) AS posted_at FROM posts
WHERE posted_at >= TIMESTAMP '2023-11-15' AND posted_at < TIMESTAMP '2024-02-20'""",
)
def read_window(spark, sf):
    """Posts of a window from a table stored by quarter: only the quarters of the window are read."""
    path, posts = work_dir(spark, "posts"), sample.posts(spark, sf).select("source_type", "id", "posted_at")
    tables.append_table(tables.with_partition(posts, "quarter"), path)
    stored = tables.read_window(spark, path, posts.schema, "2023-11-15", "2024-02-20", "quarter")
    return stored.select("source_type", "id", _micros())


def _raw_x(spark, sf):
    return sample.x_posts(spark, sf).withColumns(
        {
            "text_content": F.concat(F.lit("post "), "id"),
            "is_processed": F.col("quote_count") == 0,
            "scraped_at": F.col("posted_at") + F.expr("interval 1 day"),
        }
    )


@query(
    "get_unprocessed",
    f"""WITH {S.POSTS} SELECT id, 'post ' || id AS text_content, epoch_us(posted_at) AS posted_at, username,
  CAST(like_count AS BIGINT) AS like_count, CAST(retweet_count AS BIGINT) AS retweet_count,
  CAST(comment_count AS BIGINT) AS comment_count, CAST(quote_count AS BIGINT) AS quote_count
FROM x_posts WHERE quote_count <> 0""",
)
def get_unprocessed(spark, sf):
    """Pending X posts, platform fields unpacked."""
    pending = raw.get_unprocessed(_raw_x(spark, sf), "twitter").select("id", "text_content", _micros(), "extra.*")
    counts = ["like_count", "retweet_count", "comment_count", "quote_count"]
    return pending.withColumns({c: F.col(c).cast("long") for c in counts})


@query(
    "json_pack_unpack",
    f"""WITH {S.POSTS} SELECT r.id, r.username, r.subreddit, r.score, r.permalink, r.upvote_count, r.downvote_count,
  CAST(json_extract(e.props, '$.k') AS BIGINT) AS k FROM reddit_posts r JOIN events e ON r.id = CAST(e.event_id AS VARCHAR)""",
)
def json_pack_unpack(spark, sf):
    """Platform fields packed into JSON and unpacked again, beside a field of stored JSON."""
    fields = schemas.REDDIT_EXTRA.fieldNames()
    packed = raw.pack_extra(sample.reddit_posts(spark, sf).select("id", *fields), fields)
    unpacked = raw.unpack_extra(packed, schemas.REDDIT_EXTRA)
    props = sample.read(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), "props")
    k = raw.unpack_extra(props, schemas.columns(k=schemas.T.LongType()), "props")
    counts = ["score", "upvote_count", "downvote_count"]
    return unpacked.join(k, "id").withColumns({c: F.col(c).cast("long") for c in counts})


@query(
    "surrogate_keys",
    f"""WITH {S.POSTS} SELECT source_type, id, epoch_us(posted_at) AS posted_at,
  CAST(row_number() OVER (ORDER BY source_type, id, posted_at) AS BIGINT) AS post_id FROM posts""",
)
def surrogate_keys_(spark, sf):
    """Gapless numbers over all posts, in the order of their keys, by ranges of it."""
    posts = sample.posts(spark, sf).select("source_type", "id", "posted_at")
    return surrogate_keys(posts, ["source_type", "id", "posted_at"], "post_id").select("source_type", "id", _micros(), "post_id")


@query(
    "idempotent_load",
    f"""WITH {S.RESOLVED}, twice AS (SELECT * FROM facts UNION ALL SELECT * FROM facts WHERE platform_name = 'X')
SELECT DISTINCT id AS source_id, CAST(platform_id AS BIGINT) AS platform_id, epoch_us(posted_at) AS posted_at, score_parts
FROM twice WHERE year <> 2024""",
)
def idempotent_load(spark, sf):
    """A batch with repeated rows, part of it loaded before: only what the table lacks comes out."""
    accepted = facts(spark, sf)[0]
    loaded = accepted.where((F.year("posted_at") == 2024))
    batch = accepted.unionByName(accepted.where(F.col("platform_id") == 1))
    fresh = load.new_facts(loaded, batch)
    return fresh.select(
        "source_id", F.col("platform_id").cast("long").alias("platform_id"), _micros(),
        (F.col("sentiment_score") * 10000).cast("long").alias("score_parts"),
    )


@query(
    "refresh_views",
    " UNION ALL BY NAME ".join(f"SELECT '{name}' AS view_name, * FROM ({SQL[name]})" for name in views.VIEWS),
)
def refresh_views(spark, sf):
    """The four stored views after two loads: the second refresh adds the second load to the stored monthly summary."""
    fact, dims = facts(spark, sf)
    house = Warehouse(spark, work_dir(spark, "house"), dims=dims)
    first = F.col("platform_id") == 1
    for rows, at in ((fact.where(first), "2024-01-01"), (fact.where(~first), "2024-01-02")):
        loaded = tables.with_partition(rows, "year").withColumn("loaded_at", F.lit(at).cast("timestamp"))
        tables.append_table(loaded, house._path("fact_post"))
        house.refresh_views()
    out = None
    for name in views.VIEWS:
        rows = shown_view(name, house.view(name)).withColumn("view_name", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


@query(
    "load_balance",
    f"""WITH {S.RESOLVED} SELECT source_type, count(*) AS staged, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted,
  count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected FROM resolved GROUP BY ALL""",
)
def load_balance(spark, sf):
    """Staged = accepted + rejected, per platform."""
    kept = F.col("reject_reason").isNull()
    return resolved(spark, sf).groupBy("source_type").agg(
        F.count(F.lit(1)).alias("staged"), F.count_if(kept).alias("accepted"), F.count_if(~kept).alias("rejected")
    )
