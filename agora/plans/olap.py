"""Roll-ups, cubes and comparisons over a summary of the fact table.

Grouping sets run on summary rows, never on facts: expanding every post once
per grouping set would multiply the largest table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.dims import Dimensions
from agora.plans.star import add_up, label, mean, mean_score

_BASIC = ["posts", "scored", "score_units", "engagement"]


def _report(sums: DataFrame, keys: list[str]) -> DataFrame:
    return sums.select(
        *keys,
        F.col("posts").alias("post_count"),
        mean_score().alias("avg_sentiment_score"),
        mean("engagement").alias("avg_engagement"),
    )


def rollup_time(summary: DataFrame) -> DataFrame:
    """Year > quarter > month with subtotals; ``level`` is the grouping id (0 month, 7 grand total)."""
    sums = summary.rollup("year", "quarter", "month").agg(*add_up(_BASIC), F.grouping_id().alias("level"))
    return _report(sums, ["year", "quarter", "month", "level"])


def cube_platform_sentiment(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Every combination of platform and sentiment with both marginals."""
    named = label(summary, dims, topic=False)
    sums = named.cube("platform_name", "sentiment_label").agg(*add_up(_BASIC), F.grouping_id().alias("level"))
    return _report(sums, ["platform_name", "sentiment_label", "level"])


def grouping_sets_topic(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Topic category > topic along one axis, platform > channel along the other."""
    named = label(summary, dims, sentiment=False)
    sets = [
        [F.col("topic_category")],
        [F.col("topic_category"), F.col("topic_label")],
        [F.col("platform_name")],
        [F.col("platform_name"), F.col("channel")],
    ]
    columns = ["topic_category", "topic_label", "platform_name", "channel"]
    sums = named.groupingSets(sets, *columns).agg(*add_up(_BASIC), F.grouping_id().alias("level"))
    return _report(sums, [*columns, "level"])


def slice_and_dice(summary: DataFrame, dims: Dimensions, where: dict[str, list], by: list[str]) -> DataFrame:
    """Keep the named members of some dimensions, total the rest by ``by``."""
    named = label(summary, dims)
    for column, members in where.items():
        named = named.where(F.col(column).isin(members))
    return _report(named.groupBy(*by).agg(*add_up(_BASIC)), by)


def sentiment_shift(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Mean score per topic, platform and month beside the month before and a three-month mean.

    "Before" is the latest earlier month that has posts.
    """
    keys = ["topic_label", "platform_name", "year", "month"]
    monthly = label(summary, dims, sentiment=False).groupBy(*keys).agg(*add_up(["posts", "scored", "score_units"]))
    scored = monthly.select(*keys, F.col("posts").alias("post_count"), mean_score().alias("avg_score"))
    by_month = Window.partitionBy("topic_label", "platform_name").orderBy("year", "month")
    return scored.select(
        *keys,
        "post_count",
        "avg_score",
        F.lag("avg_score").over(by_month).alias("previous_score"),
        (F.col("avg_score") - F.lag("avg_score").over(by_month)).alias("shift"),
        F.avg("avg_score").over(by_month.rowsBetween(-2, 0)).alias("moving_avg"),
    )


def platform_pivot(summary: DataFrame, dims: Dimensions) -> DataFrame:
    """Posts and mean score of X and Reddit side by side, and X's share, per topic and quarter."""
    keys = ["year", "quarter", "topic_label"]
    named = label(summary, dims, sentiment=False)
    wide = (
        named.groupBy(*keys)
        .pivot("platform_name", ["X", "Reddit"])
        .agg(F.sum("posts").alias("posts"), (F.sum("score_units") / F.sum("scored") / 100_000).alias("score"))
    )
    x, reddit = F.coalesce(F.col("X_posts"), F.lit(0)), F.coalesce(F.col("Reddit_posts"), F.lit(0))
    quarter = Window.partitionBy("year", "quarter")
    return wide.select(
        *keys,
        x.alias("x_posts"),
        reddit.alias("reddit_posts"),
        F.col("X_score").alias("x_score"),
        F.col("Reddit_score").alias("reddit_score"),
        (x / (x + reddit)).alias("x_share"),
        ((x + reddit) / F.sum(x + reddit).over(quarter)).alias("topic_share"),
    )


def topic_persistence(summary: DataFrame, dims: Dimensions, *, steady_below: float = 0.5) -> DataFrame:
    """Sustained or event-driven: how evenly a topic's posts spread over its quarters.

    A topic is sustained when it is active in more than one quarter and the
    deviation of its quarterly counts stays below ``steady_below`` of their mean.
    """
    quarterly = (
        label(summary, dims, sentiment=False, platform=False)
        .groupBy("topic_label", "year", "quarter")
        .agg(F.sum("posts").alias("n"))
    )
    stats = quarterly.groupBy("topic_label").agg(
        F.count(F.lit(1)).alias("active_quarters"),
        F.sum("n").alias("post_count"),
        F.max("n").alias("peak_posts"),
        (F.stddev_pop("n") / F.avg("n")).alias("variation"),
    )
    steady = (F.col("active_quarters") > 1) & (F.col("variation") < steady_below)
    return stats.withColumn("pattern", F.when(steady, "sustained").otherwise("event-driven"))


def engagement_effect(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Do negative posts draw more interaction? Means, their ratio and the correlation, per platform.

    One pass: posts are summed per platform and sentiment key, squares
    included, and the correlation follows from the sums. They are whole numbers,
    so neither order nor cancellation changes the result. Squares are taken
    around the whole part of the mean, which keeps every product within 38
    digits for 10**12 posts of any 32-bit counts.
    """
    total = (
        F.col("like_count").cast("decimal(12,0)") + F.col("retweet_count") + F.col("upvote_count") + F.col("comment_count")
    ).cast("decimal(12,0)")
    sums = fact.groupBy("platform_id", "sentiment_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(total).alias("e"), F.sum(total * total).alias("ee")
    )
    named = label(sums, dims, topic=False)
    negative = F.col("sentiment_label") == "negative"
    per_platform = named.groupBy("platform_name").agg(
        F.sum("n").cast("decimal(13,0)").alias("n"),
        F.sum("e").cast("decimal(24,0)").alias("e"),
        F.sum("ee").alias("ee"),
        F.sum(F.when(negative, F.col("n")).otherwise(0)).cast("decimal(13,0)").alias("n_neg"),
        F.sum(F.when(negative, F.col("e")).otherwise(0)).cast("decimal(24,0)").alias("e_neg"),
    )
    n, e, nn, en = (F.col(c).cast("double") for c in ("n", "e", "n_neg", "e_neg"))
    both = (F.col("n") * F.col("e_neg") - F.col("n_neg") * F.col("e")).cast("double")
    flags = (F.col("n") * F.col("n_neg") - F.col("n_neg") * F.col("n_neg")).cast("double")
    whole = F.expr("e div n").cast("decimal(12,0)")
    rest = (F.col("e") - whole * F.col("n")).cast("decimal(13,0)")
    around = (F.col("ee") - F.lit(2).cast("decimal(1,0)") * (whole * F.col("e")) + whole * whole * F.col("n")).cast("decimal(38,0)")
    # n times the squared deviations: exact where the fraction of the mean can matter, a double beyond.
    exact = (around.cast("decimal(24,0)") * F.col("n") - rest * rest).cast("double")
    small = around < F.lit("999999999999999999999999").cast("decimal(38,0)")
    squares = F.when(small, exact).otherwise(around.cast("double") * n)
    avg_negative, avg_other = en / F.nullif(nn, F.lit(0.0)), (e - en) / F.nullif(n - nn, F.lit(0.0))
    spread = F.sqrt(flags) * F.sqrt(squares)
    return per_platform.select(
        "platform_name",
        F.col("n").cast("long").alias("post_count"),
        avg_negative.alias("avg_negative"),
        avg_other.alias("avg_other"),
        (avg_negative / F.nullif(avg_other, F.lit(0.0))).alias("ratio"),
        (both / F.nullif(spread, F.lit(0.0))).alias("correlation"),
    )
