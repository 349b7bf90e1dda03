"""The four summary views.

Each takes the fact table, or a monthly summary of it, so that refreshing all
four costs one pass over the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.dims import Dimensions
from agora.plans.star import add_up, label, mean, mean_score, stddev_score, summarise


def mv_temporal_sentiment(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Posts, mean and deviation of the score per month, topic, sentiment and platform."""
    keys = ["year", "quarter", "month", "month_name", "topic_label", "sentiment_label", "platform_name"]
    sums = label(summary, dims).groupBy(*keys).agg(
        *add_up(["posts", "scored", "score_units", "score_sq_high", "score_sq_low"])
    )
    return sums.select(
        *keys,
        F.col("posts").alias("post_count"),
        mean_score().alias("avg_sentiment_score"),
        stddev_score().alias("stddev_sentiment_score"),
    )


def mv_platform_comparison(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Posts, mean score and mean engagement per channel, quarter, topic, sentiment and bucket."""
    keys = ["platform_name", "channel", "year", "quarter", "topic_label", "sentiment_label", "confidence_bucket"]
    sums = label(summary, dims).groupBy(*keys).agg(*add_up(["posts", "scored", "score_units", "engagement"]))
    return sums.select(
        *keys,
        F.col("posts").alias("post_count"),
        mean_score().alias("avg_sentiment_score"),
        mean("engagement").alias("avg_engagement"),
    )


def mv_topic_volume(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Posts per quarter, topic and platform, ranked; equal counts share a rank."""
    keys = ["year", "quarter", "topic_label", "topic_category", "platform_name"]
    sums = label(summary, dims, sentiment=False).groupBy(*keys).agg(F.sum("posts").alias("post_count"))
    by_count = Window.partitionBy("year", "quarter", "platform_name").orderBy(F.desc("post_count"))
    return sums.select(*keys, "post_count", F.rank().over(by_count).alias("topic_rank"))


def mv_engagement_by_sentiment(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Mean interactions per sentiment, bucket, platform, tier and quarter."""
    keys = ["sentiment_label", "confidence_bucket", "platform_name", "engagement_tier", "year", "quarter"]
    names = ["likes", "retweets", "comments", "upvotes", "net_votes", "engagement"]
    sums = label(summary, dims, topic=False).groupBy(*keys).agg(*add_up(["posts", *names]))
    averages = [mean(m).alias("avg_total_engagement" if m == "engagement" else f"avg_{m}") for m in names]
    return sums.select(*keys, F.col("posts").alias("post_count"), *averages)


VIEWS = {
    "mv_temporal_sentiment": mv_temporal_sentiment,
    "mv_platform_comparison": mv_platform_comparison,
    "mv_topic_volume": mv_topic_volume,
    "mv_engagement_by_sentiment": mv_engagement_by_sentiment,
}

# The grouping each view needs when it is computed alone.
VIEW_KEYS: dict[str, Sequence[str]] = {
    "mv_temporal_sentiment": ["year", "quarter", "month", "month_name", "topic_id", "sentiment_id", "platform_id"],
    "mv_platform_comparison": ["year", "quarter", "platform_id", "topic_id", "sentiment_id"],
    "mv_topic_volume": ["year", "quarter", "topic_id", "platform_id"],
    "mv_engagement_by_sentiment": ["year", "quarter", "sentiment_id", "platform_id", "engagement_tier"],
}


def view(name: str, fact: DataFrame, dims: Dimensions) -> DataFrame:
    """One view straight from the fact table."""
    return VIEWS[name](summarise(fact, dims, VIEW_KEYS[name]), dims)
