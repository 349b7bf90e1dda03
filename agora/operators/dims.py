"""Dimension tables: calendar, platforms, sentiments, topics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agora import fixed, schemas
from agora.functions.posts import confidence_bucket
from agora.operators.keys import surrogate_keys
from agora.operators.raw import insert_if_absent
from agora.sources.local import small_table


@dataclass(frozen=True)
class Dimensions:
    time: DataFrame
    platform: DataFrame
    topic: DataFrame
    sentiment: DataFrame


def _seed(spark: SparkSession, schema: StructType, rows: Iterable[tuple]) -> DataFrame:
    numbered = [(i, *row) for i, row in enumerate(rows, start=1)]
    return small_table(spark, schema, numbered)


def dim_time(spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END) -> DataFrame:
    """One row per day. ``week_of_year`` is the ISO week, ``year`` the calendar
    year: early January can carry week 52 or 53. Names are not blank-padded."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col("full_date")
    iso_day = F.extract(F.lit("dayofweek_iso"), day).cast("int")
    return (
        spark.range(0, 1, 1, 1)
        .select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date"))
        .select(
            (F.datediff(day, first) + 1).cast("int").alias("time_id"),
            "full_date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.dayofmonth(day).alias("day_of_month"),
            iso_day.alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            iso_day.isin(6, 7).alias("is_weekend"),
        )
    )


def dim_platform(spark: SparkSession, rows: Sequence[tuple[str, str]] = fixed.PLATFORM_ROWS) -> DataFrame:
    return _seed(spark, schemas.PLATFORM, rows)


def dim_sentiment(spark: SparkSession) -> DataFrame:
    rows = [(s, b) for s in fixed.SENTIMENT_LABELS for b in fixed.CONFIDENCE_BUCKETS]
    return _seed(spark, schemas.SENTIMENT, rows)


def dim_topic_seed(spark: SparkSession) -> DataFrame:
    """Every label the topic rules can give, without keywords."""
    rows = [(label, category) for _, label, category in fixed.TOPIC_RULES] + [fixed.OTHER_TOPIC, fixed.NO_TOPIC]
    seed = _seed(spark, schemas.TOPIC, rows)
    return seed.withColumn("top_keywords", F.array().cast("array<string>"))


def default_dimensions(spark: SparkSession) -> Dimensions:
    return Dimensions(dim_time(spark), dim_platform(spark), dim_topic_seed(spark), dim_sentiment(spark))


def topic_rows(results: DataFrame) -> DataFrame:
    """One (label, category, keywords) row per label of the topic results.

    Several topics can share a label; the least by value speaks for it.
    """
    row = F.min(F.struct("topic_category", "top_keywords")).alias("r")
    return results.where(F.col("topic_label").isNotNull()).groupBy("topic_label").agg(row).select("topic_label", "r.*")


def build_dim_topic(results: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The topic dimension after a run: rows already known keep their ids, new labels follow on."""
    new = topic_rows(results)
    if existing is None:
        return surrogate_keys(new, ["topic_label"], "topic_id").select("topic_id", *new.columns)
    fresh = new.join(existing.select("topic_label"), "topic_label", "left_anti")
    last = existing.agg(F.coalesce(F.max("topic_id"), F.lit(0)).alias("m")).scalar()
    numbered = surrogate_keys(fresh, ["topic_label"], "topic_id").withColumn("topic_id", F.col("topic_id") + last)
    return existing.unionByName(numbered.select(*existing.columns))


def extend_platforms(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Add (platform_name, channel) pairs the dimension lacks, with fresh ids."""
    pairs = rows.select("platform_name", "channel").distinct()
    fresh = pairs.join(existing, ["platform_name", "channel"], "left_anti")
    last = existing.agg(F.coalesce(F.max("platform_id"), F.lit(0)).alias("m")).scalar()
    numbered = surrogate_keys(fresh, ["platform_name", "channel"], "platform_id")
    numbered = numbered.withColumn("platform_id", F.col("platform_id") + last)
    return existing.unionByName(numbered.select(*existing.columns))


def with_sentiment_id(
    df: DataFrame, sentiments: DataFrame, label: str = "sentiment_label", score: str = "sentiment_score"
) -> DataFrame:
    """Add ``sentiment_id`` from label and score; null for an unknown label."""
    wanted = sentiments.select("sentiment_id", F.col("sentiment_label").alias(label), "confidence_bucket")
    bucketed = df.withColumn("confidence_bucket", confidence_bucket(F.col(score)))
    return bucketed.join(wanted, [label, "confidence_bucket"], "left")


def lookup(df: DataFrame, dim: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Left lookup of a surrogate key by one or more natural keys; unknown -> null.

    No broadcast hint: below the session's threshold Spark broadcasts the
    dimension by its measured size, above it AQE splits skewed partitions.
    """
    return df.join(dim.select(id_col, *keys), list(keys), "left")


__all__ = [
    "Dimensions",
    "build_dim_topic",
    "default_dimensions",
    "dim_platform",
    "dim_sentiment",
    "dim_time",
    "dim_topic_seed",
    "extend_platforms",
    "insert_if_absent",
    "lookup",
    "topic_rows",
    "with_sentiment_id",
]
