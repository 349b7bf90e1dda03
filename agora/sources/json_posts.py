"""Posts from JSON search responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora import fixed, schemas
from agora.functions.posts import time_from_epoch


def extract_json_records(df: DataFrame, json_col: str) -> DataFrame:
    """One row per post of each response; posts without id or creation time are dropped."""
    parsed = df.select(F.from_json(F.col(json_col), schemas.JSON_RESPONSE).alias("r"))
    posts = parsed.select(F.inline("r.data"))
    text = F.coalesce(F.nullif("selftext", F.lit("")), F.nullif("body", F.lit("")), F.lit(""))
    created = F.col("created_utc")
    return posts.where(
        (F.coalesce("id", F.lit("")) != "") & (F.coalesce(created, F.lit("")) != "") & (created != "0")
    ).select(
        "id",
        F.coalesce("author", F.lit("")).alias("username"),
        text.alias("text_content"),
        F.nullif("subreddit", F.lit("")).alias("subreddit"),
        time_from_epoch(created).alias("posted_at"),
        F.coalesce("score", F.lit(0)).alias("score"),
        F.coalesce("ups", F.lit(0)).alias("upvote_count"),
        F.coalesce("downs", F.lit(0)).alias("downvote_count"),
        F.concat(F.lit(fixed.REDDIT_SITE), F.nullif("permalink", F.lit(""))).alias("permalink"),
    )
