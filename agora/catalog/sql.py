"""Shared table expressions of the SQL twins: posts, dimensions and facts over the test tables."""

from __future__ import annotations

from agora import fixed
from agora.sources.sample_posts import SUBREDDITS, TOPIC_OF_LANGUAGE


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def words(items) -> str:
    return "[" + ", ".join(text(w) for w in items) + "]"


def _case(subject: str, table: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items())
    return f"CASE {subject} {whens} ELSE {text(default)} END"


_CATEGORIES = {label: category for _, label, category in fixed.TOPIC_RULES}
_TOPICS = [(label, category) for _, label, category in fixed.TOPIC_RULES] + [fixed.OTHER_TOPIC, fixed.NO_TOPIC]

POSTS = f"""
x_posts AS (
  SELECT 'twitter' AS source_type, CAST(o_orderkey AS VARCHAR) AS id,
    'user_' || CAST(o_custkey AS VARCHAR) AS username,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL '336' MONTH AS posted_at,
    CAST(NULL AS VARCHAR) AS subreddit,
    CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) % 2000 END AS like_count,
    CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_custkey % 50 END AS retweet_count,
    CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_orderkey % 7 END AS comment_count,
    o_orderkey % 3 AS quote_count, 0 AS upvote_count, 0 AS downvote_count,
    CAST(NULL AS BIGINT) AS score, CAST(NULL AS VARCHAR) AS permalink, 'X_global' AS channel,
    o_orderkey % (SELECT count(*) FROM documents) AS doc_id
  FROM orders),
reddit_raw AS (
  SELECT *, {_case("event_type", SUBREDDITS)} AS sub FROM events),
reddit_posts AS (
  SELECT 'reddit' AS source_type, CAST(event_id AS VARCHAR) AS id, 'u_' || CAST(user_id AS VARCHAR) AS username,
    CAST(ts AS TIMESTAMP) AS posted_at, sub AS subreddit,
    0 AS like_count, 0 AS retweet_count, 0 AS comment_count, 0 AS quote_count,
    CAST(floor(value) AS BIGINT) AS upvote_count, CAST(floor(value / 4) AS BIGINT) AS downvote_count,
    CAST(floor(value) AS BIGINT) - CAST(floor(value / 4) AS BIGINT) AS score,
    '/r/' || sub || '/comments/' || CAST(event_id AS VARCHAR) AS permalink, 'r/' || sub AS channel,
    event_id % (SELECT count(*) FROM documents) AS doc_id
  FROM reddit_raw),
posts AS (SELECT * FROM x_posts UNION ALL SELECT * FROM reddit_posts)"""

SCORES = f"""
document_scores AS (
  SELECT d.doc_id, d.text AS text_content,
    CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive'
      WHEN l.toxic IS NOT NULL THEN 'neutral' END AS sentiment_label,
    3333 + (d.doc_id * 37) % 6667 AS score_parts,
    {_case("d.lang", TOPIC_OF_LANGUAGE, fixed.OTHER_TOPIC[0])} AS topic_label,
    {_case("d.lang", {k: _CATEGORIES[v] for k, v in TOPIC_OF_LANGUAGE.items()}, fixed.OTHER_TOPIC[1])} AS topic_category
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

STAGED = f"""{POSTS},{SCORES},
staged AS (
  SELECT p.*, s.text_content, s.sentiment_label, s.topic_label, s.topic_category,
    s.score_parts, s.score_parts / 10000.0 AS sentiment_score
  FROM posts p JOIN document_scores s ON p.doc_id = s.doc_id)"""

DIM_TIME = """
dim_time AS (
  SELECT CAST(date_diff('day', DATE '2023-01-01', d) + 1 AS BIGINT) AS time_id, CAST(d AS DATE) AS full_date,
    year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
    week(d) AS week_of_year, day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name,
    isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(DATE '2023-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS d))"""

DIMS = f"""{DIM_TIME},
dim_platform(platform_id, platform_name, channel) AS (
  VALUES {values((i, *r) for i, r in enumerate(fixed.PLATFORM_ROWS, 1))}),
dim_topic(topic_id, topic_label, topic_category) AS (
  VALUES {values((i, *r) for i, r in enumerate(_TOPICS, 1))}),
dim_sentiment(sentiment_id, sentiment_label, confidence_bucket) AS (
  VALUES {values((i, s, b) for i, (s, b) in enumerate(((s, b) for s in fixed.SENTIMENT_LABELS for b in fixed.CONFIDENCE_BUCKETS), 1))})"""

TIER = """CASE WHEN {e} = 0 THEN 'Zero' WHEN {e} < 10 THEN 'Low' WHEN {e} < 100 THEN 'Medium'
      WHEN {e} < 1000 THEN 'High' ELSE 'Viral' END"""

RESOLVED = f"""{STAGED},{DIMS},
bucketed AS (
  SELECT *, CASE source_type WHEN 'twitter' THEN 'X' ELSE 'Reddit' END AS platform_name,
    CASE WHEN score_parts >= 8000 THEN 'High' WHEN score_parts >= 5000 THEN 'Medium' ELSE 'Low' END AS confidence_bucket,
    like_count + retweet_count + upvote_count + comment_count AS engagement
  FROM staged),
resolved AS (
  SELECT b.*, t.time_id, t.full_date, t.year, t.quarter, t.month, t.month_name, p.platform_id, k.topic_id, s.sentiment_id,
    {TIER.format(e="b.engagement")} AS engagement_tier,
    CASE WHEN t.time_id IS NULL THEN 'date not in dim_time' WHEN b.channel IS NULL THEN 'no channel'
      WHEN p.platform_id IS NULL THEN 'channel not in dim_platform' END AS reject_reason
  FROM bucketed b
  LEFT JOIN dim_time t ON CAST(b.posted_at AS DATE) = t.full_date
  LEFT JOIN dim_platform p ON b.platform_name = p.platform_name AND b.channel = p.channel
  LEFT JOIN dim_topic k ON b.topic_label = k.topic_label
  LEFT JOIN dim_sentiment s ON b.sentiment_label = s.sentiment_label AND b.confidence_bucket = s.confidence_bucket),
facts AS (SELECT * FROM resolved WHERE reject_reason IS NULL),
star AS (SELECT * FROM facts WHERE topic_id IS NOT NULL AND sentiment_id IS NOT NULL)"""


def with_(tables: str, select: str) -> str:
    return f"WITH {tables}\n{select}"


AVG_SCORE = "CAST(sum(score_parts) AS DOUBLE) / count(*) / 10000"
