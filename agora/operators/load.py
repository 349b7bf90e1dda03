"""From staged posts to fact rows: key resolution, rejects, idempotent append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions import posts as P
from agora.operators.dims import Dimensions, lookup, with_sentiment_id
from agora.operators.raw import dedup_keep_last

FACT_KEY = ["platform_id", "source_id", "posted_at"]
COUNTS = ["like_count", "comment_count", "quote_count", "retweet_count", "upvote_count", "downvote_count"]
FACT_COLUMNS = [
    "post_id", "source_id", "source_url", "time_id", "platform_id", "topic_id", "sentiment_id",
    *COUNTS, "sentiment_score", "engagement_tier", "posted_at",
]


def resolve_keys(staged: DataFrame, dims: Dimensions) -> DataFrame:
    """Staged posts with their surrogate keys and, where a required one is missing, the reason.

    Date and platform are required; topic and sentiment may stay null.
    """
    source = F.col("source_type")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in COUNTS}
    df = (
        staged.withColumn("full_date", P.date_key(F.col("posted_at")))
        .withColumn("platform_name", P.platform_name(source))
        .withColumn("channel", P.channel(source, F.col("subreddit")))
    )
    df = lookup(df, dims.time, ["full_date"], "time_id")
    df = lookup(df, dims.platform, ["platform_name", "channel"], "platform_id")
    df = lookup(df, dims.topic, ["topic_label"], "topic_id")
    df = with_sentiment_id(df, dims.sentiment)
    reason = (
        F.when(F.col("time_id").isNull(), "date not in dim_time")
        .when(F.col("channel").isNull(), "no channel")
        .when(F.col("platform_id").isNull(), "channel not in dim_platform")
    )
    total = P.engagement(*[counts[c] for c in ("like_count", "retweet_count", "upvote_count", "comment_count")])
    # The digest of the fact's key: the same on every run, and as unique as the
    # key, which loading keeps unique. The numbers around the id keep it apart.
    key = F.concat_ws("|", "platform_id", "id", F.unix_micros("posted_at"))
    return df.select(
        "source_type",
        F.md5(key).alias("post_id"),
        F.col("id").alias("source_id"),
        P.source_url(source, F.col("id"), F.col("username"), F.col("permalink")).alias("source_url"),
        "full_date", "platform_name", "channel", "topic_label", "sentiment_label", "confidence_bucket",
        "time_id", "platform_id", "topic_id", "sentiment_id",
        *[count.alias(name) for name, count in counts.items()],
        "sentiment_score",
        P.engagement_tier(total).alias("engagement_tier"),
        "posted_at",
        reason.alias("reject_reason"),
    )


def accepted(resolved: DataFrame) -> DataFrame:
    """Fact rows: every required key was found."""
    return resolved.where(F.col("reject_reason").isNull()).select(*FACT_COLUMNS)


def rejects(resolved: DataFrame) -> DataFrame:
    """Posts held back, each with its reason."""
    return resolved.where(F.col("reject_reason").isNotNull()).select(
        "source_type", "source_id", "posted_at", "channel", "reject_reason"
    )


def new_facts(fact: DataFrame, incoming: DataFrame, keys: Sequence[str] = FACT_KEY) -> DataFrame:
    """The rows of ``incoming`` that ``fact`` lacks, so that loading twice equals loading once.

    Copies inside ``incoming`` are reduced first; the rest is one anti join.
    """
    order = [c for c in incoming.columns if c not in keys]
    return dedup_keep_last(incoming, keys, order).join(fact.select(*keys), list(keys), "left_anti")
