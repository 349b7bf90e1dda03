"""The star join and the mergeable summary all reports are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.functions.posts import engagement
from agora.operators.dims import Dimensions

UNITS = 100_000  # a NUMERIC(6,5) score as a whole number
CALENDAR = ["year", "quarter", "month", "month_name"]
IDS = ["platform_id", "topic_id", "sentiment_id"]
MONTHLY = [*CALENDAR, *IDS, "engagement_tier"]
MEASURES = [
    "posts", "scored", "score_units", "score_sq_high", "score_sq_low",
    "likes", "retweets", "comments", "upvotes", "net_votes", "engagement",
]


def star_join(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Fact rows with the columns of all four dimensions; rows lacking one are dropped."""
    return (
        fact.join(dims.time, "time_id")
        .join(dims.platform, "platform_id")
        .join(dims.topic, "topic_id")
        .join(dims.sentiment, "sentiment_id")
    )


def summarise(fact: DataFrame, dims: Dimensions, keys: Sequence[str] = MONTHLY) -> DataFrame:
    """Sums per calendar period and surrogate keys, before any label is joined.

    The one pass over the fact table hashes small integers; labels meet a few
    thousand rows afterwards. Every measure is a whole-number sum, so
    summaries of parts add up exactly to the summary of the whole. Squares are
    kept as two sums, which hold for some 10**12 posts per group.
    """
    calendar = [k for k in keys if k in CALENDAR]
    if calendar:
        fact = fact.join(dims.time.select("time_id", *calendar), "time_id")
    units = (F.col("sentiment_score").cast("decimal(6,5)") * UNITS).cast("long")
    square = units * units
    long = lambda name: F.col(name).cast("long")
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("posts"),
        F.count("sentiment_score").alias("scored"),
        F.sum(units).alias("score_units"),
        F.sum(F.shiftright(square, 20)).alias("score_sq_high"),
        F.sum(square.bitwiseAND(F.lit((1 << 20) - 1))).alias("score_sq_low"),
        F.sum(long("like_count")).alias("likes"),
        F.sum(long("retweet_count")).alias("retweets"),
        F.sum(long("comment_count")).alias("comments"),
        F.sum(long("upvote_count")).alias("upvotes"),
        F.sum(long("upvote_count") - long("downvote_count")).alias("net_votes"),
        F.sum(
            engagement(
                F.col("like_count"), F.col("retweet_count"), F.col("upvote_count"), F.col("comment_count")
            )
        ).alias("engagement"),
    )


def add_up(measures: Sequence[str] = MEASURES) -> list[Column]:
    """Aggregates that merge summary rows."""
    return [F.sum(m).alias(m) for m in measures]


def label(summary: DataFrame, dims: Dimensions, *, platform=True, topic=True, sentiment=True) -> DataFrame:
    """Join labels to a summary; a null key drops out, as in the star join."""
    if platform:
        summary = summary.join(dims.platform, "platform_id")
    if topic:
        summary = summary.join(dims.topic.select("topic_id", "topic_label", "topic_category"), "topic_id")
    if sentiment:
        summary = summary.join(dims.sentiment, "sentiment_id")
    return summary


def mean(total: str, n: str = "posts") -> Column:
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def mean_score() -> Column:
    """Average score: one exact sum, one division."""
    return mean("score_units", "scored") / UNITS


def stddev_score() -> Column:
    """Sample standard deviation from exact sums; null for a single post."""
    n, total = F.col("scored"), F.col("score_units")
    squares = F.col("score_sq_high").cast("decimal(20,0)") * F.lit(1 << 20).cast("decimal(8,0)") + F.col("score_sq_low")
    whole = lambda c: c.cast("decimal(19,0)")
    spread = whole(n) * squares - whole(total) * whole(total)
    variance = spread.cast("double") / (n.cast("double") * (n - 1))
    return F.when(n > 1, F.sqrt(variance) / UNITS)
