"""Registered queries: dimensions, lookups, facts, views and OLAP reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.catalog import sql as S
from agora.catalog.registry import query
from agora.functions import posts as P
from agora.operators import dims as D
from agora.operators import load
from agora.plans import olap, star, views
from agora.sources import sample_posts


def facts(spark: SparkSession, sf: str) -> tuple[DataFrame, D.Dimensions]:
    dims = D.default_dimensions(spark)
    return load.accepted(load.resolve_keys(sample_posts.staged_posts(spark, sf), dims)), dims


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return load.resolve_keys(sample_posts.staged_posts(spark, sf), D.default_dimensions(spark))


def _long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


def _round(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    if not names:
        return df
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- dimensions and lookups ---------------------------------------------------


@query(
    "dim_time",
    f"""WITH {S.STAGED},{S.DIM_TIME}
SELECT CAST(t.full_date AS VARCHAR) AS full_date, t.year, t.quarter, t.month, t.month_name, t.week_of_year, t.day_of_month, t.day_of_week,
  t.day_name, t.is_weekend, t.time_id, count(p.id) AS post_count
FROM dim_time t LEFT JOIN posts p ON CAST(p.posted_at AS DATE) = t.full_date
GROUP BY ALL""",
)
def dim_time(spark, sf):
    """Every calendar day with its attributes and its posts."""
    days = sample_posts.posts(spark, sf).groupBy(P.date_key(F.col("posted_at")).alias("full_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    out = D.dim_time(spark).join(days, "full_date", "left")
    return out.select(
        F.col("full_date").cast("string").alias("full_date"),
        *_long("year", "quarter", "month"),
        "month_name",
        *_long("week_of_year", "day_of_month", "day_of_week"),
        "day_name",
        "is_weekend",
        *_long("time_id"),
        F.coalesce("n", F.lit(0)).alias("post_count"),
    )


@query(
    "confidence_bucket",
    f"""WITH {S.RESOLVED} SELECT score_parts, confidence_bucket, count(*) AS post_count FROM resolved GROUP BY ALL""",
)
def confidence_bucket(spark, sf):
    df = sample_posts.staged_posts(spark, sf)
    parts = (F.col("sentiment_score") * 10000).cast("long").alias("score_parts")
    bucket = P.confidence_bucket(F.col("sentiment_score")).alias("confidence_bucket")
    return df.groupBy(parts, bucket).agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "sentiment_id",
    f"""WITH {S.RESOLVED} SELECT sentiment_label, confidence_bucket,
  coalesce(CAST(sentiment_id AS VARCHAR), 'none') AS sentiment_id, count(*) AS post_count FROM resolved GROUP BY ALL""",
)
def sentiment_id(spark, sf):
    df = D.with_sentiment_id(sample_posts.staged_posts(spark, sf), D.dim_sentiment(spark))
    key = F.coalesce(F.col("sentiment_id").cast("string"), F.lit("none")).alias("sentiment_id")
    return df.groupBy("sentiment_label", "confidence_bucket", key).agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "engagement_tier",
    f"""WITH {S.RESOLVED} SELECT source_type, id, CAST(engagement AS BIGINT) AS engagement, engagement_tier FROM resolved""",
)
def engagement_tier(spark, sf):
    total = P.engagement(F.col("like_count"), F.col("retweet_count"), F.col("upvote_count"), F.col("comment_count"))
    df = sample_posts.posts(spark, sf).withColumn("engagement", total)
    return df.select("source_type", "id", "engagement", P.engagement_tier(F.col("engagement")).alias("engagement_tier"))


@query(
    "date_key",
    f"WITH {S.POSTS} SELECT source_type, id, CAST(CAST(posted_at AS DATE) AS VARCHAR) AS date_key FROM posts",
)
def date_key(spark, sf):
    key = P.date_key(F.col("posted_at")).cast("string").alias("date_key")
    return sample_posts.posts(spark, sf).select("source_type", "id", key)


@query("channel", f"WITH {S.POSTS} SELECT source_type, channel, count(*) AS post_count FROM posts GROUP BY ALL")
def channel(spark, sf):
    df = sample_posts.posts(spark, sf).drop("channel")
    name = P.channel(F.col("source_type"), F.col("subreddit")).alias("channel")
    return df.groupBy("source_type", name).agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "source_url",
    f"""WITH {S.POSTS} SELECT source_type, id, CASE source_type
  WHEN 'twitter' THEN 'https://x.com/' || username || '/status/' || id
  ELSE 'https://www.reddit.com' || permalink END AS source_url FROM posts""",
)
def source_url(spark, sf):
    url = P.source_url(F.col("source_type"), F.col("id"), F.col("username"), F.col("permalink"))
    return sample_posts.posts(spark, sf).select("source_type", "id", url.alias("source_url"))


@query(
    "lookup_left",
    f"""WITH {S.RESOLVED} SELECT topic_label, coalesce(sentiment_label, 'none') AS sentiment_label,
  coalesce(CAST(topic_id AS VARCHAR), 'none') AS topic_id, coalesce(CAST(sentiment_id AS VARCHAR), 'none') AS sentiment_id,
  count(*) AS post_count FROM resolved GROUP BY ALL""",
)
def lookup_left(spark, sf):
    """Optional keys: an unknown topic or sentiment leaves the key empty and keeps the post."""
    df = D.lookup(sample_posts.staged_posts(spark, sf), D.dim_topic_seed(spark), ["topic_label"], "topic_id")
    df = D.with_sentiment_id(df, D.dim_sentiment(spark))
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in ("topic_id", "sentiment_id")]
    label = F.coalesce("sentiment_label", F.lit("none")).alias("sentiment_label")
    return df.groupBy("topic_label", label, *keys).agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "lookup_required",
    f"""WITH {S.RESOLVED} SELECT id AS source_id, source_type, CAST(time_id AS BIGINT) AS time_id,
  CAST(platform_id AS BIGINT) AS platform_id FROM facts""",
)
def lookup_required(spark, sf):
    """Posts whose date and platform are both known, with those keys."""
    return (
        resolved(spark, sf)
        .where(F.col("reject_reason").isNull())
        .select("source_id", "source_type", *_long("time_id", "platform_id"))
    )


@query(
    "load_rejects",
    f"""WITH {S.RESOLVED} SELECT source_type, id AS source_id, channel, reject_reason FROM resolved
WHERE reject_reason IS NOT NULL""",
)
def load_rejects(spark, sf):
    return load.rejects(resolved(spark, sf)).drop("posted_at")


@query(
    "lookup_composite",
    f"""WITH {S.RESOLVED} SELECT platform_name, channel, coalesce(CAST(platform_id AS VARCHAR), 'none') AS platform_id,
  count(*) AS post_count FROM resolved GROUP BY ALL""",
)
def lookup_composite(spark, sf):
    """Two-column key: platform and channel."""
    df = sample_posts.posts(spark, sf).withColumn("platform_name", P.platform_name(F.col("source_type")))
    df = D.lookup(df, D.dim_platform(spark), ["platform_name", "channel"], "platform_id")
    key = F.coalesce(F.col("platform_id").cast("string"), F.lit("none")).alias("platform_id")
    return df.groupBy("platform_name", "channel", key).agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "resolve_dimensions",
    f"""WITH {S.RESOLVED} SELECT id AS source_id, source_type, coalesce(reject_reason, 'accepted') AS outcome,
  confidence_bucket, engagement_tier, score_parts FROM resolved""",
)
def resolve_dimensions(spark, sf):
    """Every staged post either becomes a fact or carries its reject reason."""
    return resolved(spark, sf).select(
        "source_id",
        "source_type",
        F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"),
        "confidence_bucket",
        "engagement_tier",
        (F.col("sentiment_score") * 10000).cast("long").alias("score_parts"),
    )


@query(
    "build_dim_topic",
    f"""WITH {S.STAGED}, t AS (SELECT topic_label, min(topic_category) AS topic_category FROM staged GROUP BY topic_label)
SELECT CAST(row_number() OVER (ORDER BY topic_label) AS BIGINT) AS topic_id,
  topic_label, topic_category FROM t""",
)
def build_dim_topic(spark, sf):
    """The topic dimension as the topics of all posts fill it."""
    results = sample_posts.staged_posts(spark, sf).withColumn("top_keywords", F.array().cast("array<string>"))
    return D.build_dim_topic(results).drop("top_keywords")


@query(
    "insert_if_absent",
    f"""WITH {S.POSTS}, seen AS (
  SELECT CASE source_type WHEN 'twitter' THEN 'X' ELSE 'Reddit' END AS platform_name, channel FROM posts),
{S.DIMS}
SELECT platform_name, channel FROM dim_platform UNION SELECT platform_name, channel FROM seen""",
)
def insert_if_absent(spark, sf):
    """Channels seen in posts are added to the platform dimension, known ones are left alone."""
    seen = sample_posts.posts(spark, sf).select(P.platform_name(F.col("source_type")).alias("platform_name"), "channel")
    known = D.dim_platform(spark).select("platform_name", "channel")
    return D.insert_if_absent(known, seen, ["platform_name", "channel"])


# --- star and views -----------------------------------------------------------


def shown_view(name: str, rows: DataFrame) -> DataFrame:
    """A view with the types and the rounding its SQL states."""
    whole = [c for c in ("year", "quarter", "month", "topic_rank") if c in rows.columns]
    averages = [c for c in rows.columns if c.startswith("avg_")]
    return _round(_round(rows.withColumns({c: F.col(c).cast("long") for c in whole}), *averages),
                  *[c for c in rows.columns if c.startswith("stddev_")], digits=6)


@query(
    "star_join",
    f"""WITH {S.RESOLVED} SELECT id AS source_id, platform_name, channel, CAST(full_date AS VARCHAR) AS full_date,
  topic_label, sentiment_label, confidence_bucket, engagement_tier FROM star""",
)
def star_join(spark, sf):
    fact, dims = facts(spark, sf)
    return star.star_join(fact, dims).select(
        "source_id", "platform_name", "channel", F.col("full_date").cast("string").alias("full_date"),
        "topic_label", "sentiment_label", "confidence_bucket", "engagement_tier",
    )


@query(
    "mv_temporal_sentiment",
    f"""WITH {S.RESOLVED} SELECT CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
  CAST(month AS BIGINT) AS month, month_name, topic_label, sentiment_label, platform_name, count(*) AS post_count,
  round({S.AVG_SCORE}, 9) AS avg_sentiment_score,
  round(stddev_samp(score_parts / 10000.0), 6) AS stddev_sentiment_score FROM star GROUP BY ALL""",
)
def mv_temporal_sentiment(spark, sf):
    return shown_view("mv_temporal_sentiment", views.view("mv_temporal_sentiment", *facts(spark, sf)))


@query(
    "mv_platform_comparison",
    f"""WITH {S.RESOLVED} SELECT platform_name, channel, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
  topic_label, sentiment_label, confidence_bucket, count(*) AS post_count,
  round({S.AVG_SCORE}, 9) AS avg_sentiment_score,
  round(CAST(sum(engagement) AS DOUBLE) / count(*), 9) AS avg_engagement FROM star GROUP BY ALL""",
)
def mv_platform_comparison(spark, sf):
    return shown_view("mv_platform_comparison", views.view("mv_platform_comparison", *facts(spark, sf)))


@query(
    "mv_topic_volume",
    f"""WITH {S.RESOLVED}, v AS (
  SELECT CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, topic_label, topic_category, platform_name,
    count(*) AS post_count FROM facts WHERE topic_id IS NOT NULL GROUP BY ALL)
SELECT *, rank() OVER (PARTITION BY year, quarter, platform_name ORDER BY post_count DESC) AS topic_rank FROM v""",
)
def mv_topic_volume(spark, sf):
    return shown_view("mv_topic_volume", views.view("mv_topic_volume", *facts(spark, sf)))


_ENGAGEMENT_SQL = ", ".join(
    f"round(CAST(sum({e}) AS DOUBLE) / count(*), 9) AS {n}"
    for e, n in [
        ("like_count", "avg_likes"),
        ("retweet_count", "avg_retweets"),
        ("comment_count", "avg_comments"),
        ("upvote_count", "avg_upvotes"),
        ("upvote_count - downvote_count", "avg_net_votes"),
        ("engagement", "avg_total_engagement"),
    ]
)


@query(
    "mv_engagement_by_sentiment",
    f"""WITH {S.RESOLVED} SELECT sentiment_label, confidence_bucket, platform_name, engagement_tier,
  CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, count(*) AS post_count, {_ENGAGEMENT_SQL}
FROM facts WHERE sentiment_id IS NOT NULL GROUP BY ALL""",
)
def mv_engagement_by_sentiment(spark, sf):
    return shown_view("mv_engagement_by_sentiment", views.view("mv_engagement_by_sentiment", *facts(spark, sf)))


# --- OLAP ---------------------------------------------------------------------

_TOTALS = f"""count(*) AS post_count, round({S.AVG_SCORE}, 9) AS avg_sentiment_score,
  round(CAST(sum(engagement) AS DOUBLE) / count(*), 9) AS avg_engagement"""


def _totals(df: DataFrame) -> DataFrame:
    return _round(df, "avg_sentiment_score", "avg_engagement")


@query(
    "rollup_time",
    f"""WITH {S.RESOLVED} SELECT coalesce(CAST(year AS VARCHAR), 'all') AS year, coalesce(CAST(quarter AS VARCHAR), 'all') AS quarter,
  coalesce(CAST(month AS VARCHAR), 'all') AS month, CAST(grouping(year, quarter, month) AS BIGINT) AS level, {_TOTALS}
FROM facts GROUP BY ROLLUP (year, quarter, month)""",
)
def rollup_time(spark, sf):
    fact, dims = facts(spark, sf)
    out = olap.rollup_time(star.summarise(fact, dims, ["year", "quarter", "month"]))
    names = {c: F.coalesce(F.col(c).cast("string"), F.lit("all")) for c in ("year", "quarter", "month")}
    return _totals(out.withColumns(names))


@query(
    "cube_platform_sentiment",
    f"""WITH {S.RESOLVED} SELECT coalesce(platform_name, 'all') AS platform_name, coalesce(sentiment_label, 'all') AS sentiment_label,
  CAST(grouping(platform_name, sentiment_label) AS BIGINT) AS level, {_TOTALS}
FROM facts WHERE sentiment_id IS NOT NULL GROUP BY CUBE (platform_name, sentiment_label)""",
)
def cube_platform_sentiment(spark, sf):
    fact, dims = facts(spark, sf)
    out = olap.cube_platform_sentiment(star.summarise(fact, dims, ["platform_id", "sentiment_id"]), dims)
    names = {c: F.coalesce(F.col(c), F.lit("all")) for c in ("platform_name", "sentiment_label")}
    return _totals(out.withColumns(names))


@query(
    "grouping_sets_topic",
    f"""WITH {S.RESOLVED} SELECT coalesce(topic_category, 'all') AS topic_category, coalesce(topic_label, 'all') AS topic_label,
  coalesce(platform_name, 'all') AS platform_name, coalesce(channel, 'all') AS channel,
  CAST(grouping(topic_category, topic_label, platform_name, channel) AS BIGINT) AS level, {_TOTALS}
FROM facts WHERE topic_id IS NOT NULL GROUP BY GROUPING SETS (
  (topic_category), (topic_category, topic_label), (platform_name), (platform_name, channel))""",
)
def grouping_sets_topic(spark, sf):
    fact, dims = facts(spark, sf)
    out = olap.grouping_sets_topic(star.summarise(fact, dims, ["topic_id", "platform_id"]), dims)
    names = {
        c: F.coalesce(F.col(c), F.lit("all")) for c in ("topic_category", "topic_label", "platform_name", "channel")
    }
    return _totals(out.withColumns(names))


@query(
    "slice_and_dice",
    f"""WITH {S.RESOLVED} SELECT CAST(year AS BIGINT) AS year, channel, confidence_bucket, {_TOTALS} FROM star
WHERE topic_label IN ('Energi', 'Moneter & Kurs') AND sentiment_label IN ('negative', 'neutral') GROUP BY ALL""",
)
def slice_and_dice(spark, sf):
    fact, dims = facts(spark, sf)
    summary = star.summarise(fact, dims, ["year", "platform_id", "topic_id", "sentiment_id"])
    where = {"topic_label": ["Energi", "Moneter & Kurs"], "sentiment_label": ["negative", "neutral"]}
    out = olap.slice_and_dice(summary, dims, where, ["year", "channel", "confidence_bucket"])
    return _totals(out.withColumn("year", F.col("year").cast("long")))


@query(
    "sentiment_shift",
    f"""WITH {S.RESOLVED}, m AS (
  SELECT topic_label, platform_name, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, count(*) AS post_count,
    {S.AVG_SCORE} AS avg_score FROM facts WHERE topic_id IS NOT NULL GROUP BY ALL)
SELECT topic_label, platform_name, year, month, post_count, round(avg_score, 9) AS avg_score,
  round(lag(avg_score) OVER w, 9) AS previous_score, round(avg_score - lag(avg_score) OVER w, 9) AS shift,
  round(avg(avg_score) OVER (PARTITION BY topic_label, platform_name ORDER BY year, month
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS moving_avg
FROM m WINDOW w AS (PARTITION BY topic_label, platform_name ORDER BY year, month)""",
)
def sentiment_shift(spark, sf):
    fact, dims = facts(spark, sf)
    out = olap.sentiment_shift(star.summarise(fact, dims, ["year", "month", "topic_id", "platform_id"]), dims)
    out = out.withColumns({c: F.col(c).cast("long") for c in ("year", "month")})
    return _round(out, "avg_score", "previous_score", "shift", "moving_avg")


@query(
    "platform_pivot",
    f"""WITH {S.RESOLVED}, w AS (
  SELECT CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, topic_label,
    count(*) FILTER (WHERE platform_name = 'X') AS x_posts, count(*) FILTER (WHERE platform_name = 'Reddit') AS reddit_posts,
    CAST(sum(score_parts) FILTER (WHERE platform_name = 'X') AS DOUBLE) AS xs,
    CAST(sum(score_parts) FILTER (WHERE platform_name = 'Reddit') AS DOUBLE) AS rs
  FROM facts WHERE topic_id IS NOT NULL GROUP BY ALL)
SELECT year, quarter, topic_label, x_posts, reddit_posts,
  round(xs / nullif(x_posts, 0) / 10000, 9) AS x_score, round(rs / nullif(reddit_posts, 0) / 10000, 9) AS reddit_score,
  round(CAST(x_posts AS DOUBLE) / (x_posts + reddit_posts), 9) AS x_share,
  round(CAST(x_posts + reddit_posts AS DOUBLE) / CAST(sum(x_posts + reddit_posts) OVER (PARTITION BY year, quarter) AS DOUBLE), 9) AS topic_share
FROM w""",
)
def platform_pivot(spark, sf):
    fact, dims = facts(spark, sf)
    out = olap.platform_pivot(star.summarise(fact, dims, ["year", "quarter", "topic_id", "platform_id"]), dims)
    out = out.withColumns({c: F.col(c).cast("long") for c in ("year", "quarter")})
    return _round(out, "x_score", "reddit_score", "x_share", "topic_share")


@query(
    "topic_persistence",
    f"""WITH {S.RESOLVED}, q AS (
  SELECT topic_label, year, quarter, count(*) AS n FROM facts WHERE topic_id IS NOT NULL GROUP BY ALL),
s AS (SELECT topic_label, count(*) AS active_quarters, CAST(sum(n) AS BIGINT) AS post_count, max(n) AS peak_posts,
  stddev_pop(n) / avg(n) AS v FROM q GROUP BY topic_label)
SELECT topic_label, active_quarters, post_count, peak_posts, round(v, 9) AS variation,
  CASE WHEN active_quarters > 1 AND v < 0.5 THEN 'sustained' ELSE 'event-driven' END AS pattern FROM s""",
)
def topic_persistence(spark, sf):
    fact, dims = facts(spark, sf)
    return _round(olap.topic_persistence(star.summarise(fact, dims, ["year", "quarter", "topic_id"]), dims), "variation")


@query(
    "engagement_effect",
    f"""WITH {S.RESOLVED}, e AS (
  SELECT platform_name, CAST(engagement AS DOUBLE) AS e, CASE WHEN sentiment_label = 'negative' THEN 1 ELSE 0 END AS neg
  FROM facts WHERE sentiment_id IS NOT NULL)
SELECT platform_name, count(*) AS post_count, round(avg(e) FILTER (WHERE neg = 1), 9) AS avg_negative,
  round(avg(e) FILTER (WHERE neg = 0), 9) AS avg_other,
  round(avg(e) FILTER (WHERE neg = 1) / avg(e) FILTER (WHERE neg = 0), 9) AS ratio, round(corr(neg, e), 6) AS correlation
FROM e GROUP BY platform_name""",
)
def engagement_effect(spark, sf):
    out = olap.engagement_effect(*facts(spark, sf))
    out = out.withColumn("post_count", F.col("post_count").cast("long"))
    return _round(_round(out, "avg_negative", "avg_other", "ratio"), "correlation", digits=6)
