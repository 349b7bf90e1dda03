"""The supplied test tables in the role of posts (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora import fixed
from agora.functions.posts import channel
from agora.operators.raw import union_platforms
from agora.schemas import INT, STRING, columns

SUBREDDITS = {
    "click": "indonesia",
    "view": "economy",
    "purchase": "investasi",
    "signup": "personalfinance",
    "error": "unlisted",
}
TOPIC_OF_LANGUAGE = {"en": "Inflasi & Harga", "fr": "Energi", "de": "Moneter & Kurs"}

_LONG, _DOUBLE, _NTZ = T.LongType(), T.DoubleType(), T.TimestampNTZType()

# Declared, so that opening a table starts no job to look at its files.
TABLES = {
    "customer": columns(
        c_custkey=_LONG, c_name=STRING, c_nationkey=INT, c_acctbal=_DOUBLE, c_mktsegment=STRING
    ),
    "orders": columns(
        o_orderkey=_LONG, o_custkey=_LONG, o_orderstatus=STRING, o_totalprice=_DOUBLE, o_orderdate=_NTZ,
        o_orderpriority=STRING,
    ),
    "lineitem": columns(
        l_orderkey=_LONG, l_partkey=_LONG, l_suppkey=_LONG, l_linenumber=INT, l_quantity=_DOUBLE,
        l_extendedprice=_DOUBLE, l_discount=_DOUBLE, l_tax=_DOUBLE, l_returnflag=STRING, l_linestatus=STRING,
        l_shipdate=_NTZ,
    ),
    "events": columns(
        event_id=_LONG, ts=_NTZ, user_id=_LONG, event_type=STRING, value=_DOUBLE, props=STRING
    ),
    "documents": columns(doc_id=_LONG, text=STRING, lang=STRING, source=STRING, n_chars=_LONG),
    "labels": columns(doc_id=_LONG, quality=INT, toxic=INT),
    "pages": columns(page_id=_LONG, url=STRING, html=STRING),
    "benchmark": columns(item_id=_LONG, text=STRING),
    "supplier": columns(s_suppkey=_LONG, s_name=STRING, s_nationkey=INT, s_acctbal=_DOUBLE),
    "conversations": columns(conv_id=_LONG, turn=_LONG, role=STRING, text=STRING),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _case(subject: str, table: dict[str, str], default: str | None = None) -> str:
    whens = " ".join(f"WHEN '{key}' THEN '{name}'" for key, name in table.items())
    return f"CASE {subject} {whens}" + (f" ELSE '{default}' END" if default else " END")


def _with_doc_id(spark: SparkSession, sf_dir: str, df: DataFrame, key: str) -> DataFrame:
    """Assign a document to each post: documents are numbered from 0 without gaps."""
    documents = read(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.withColumn("doc_id", F.col(key).cast("long") % documents)


def x_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X posts, from ``orders``; every tenth draws no interaction."""
    posts = read(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS id",
        "concat('user_', o_custkey) AS username",
        "CAST(o_orderdate AS timestamp) + INTERVAL '336' MONTH AS posted_at",
        "CAST(if(o_orderkey % 10 = 0, 0, floor(o_totalprice) % 2000) AS int) AS like_count",
        "CAST(if(o_orderkey % 10 = 0, 0, o_custkey % 50) AS int) AS retweet_count",
        "CAST(if(o_orderkey % 10 = 0, 0, o_orderkey % 7) AS int) AS comment_count",
        "CAST(o_orderkey % 3 AS int) AS quote_count",
        "0 AS upvote_count",
        "0 AS downvote_count",
    )
    return _with_doc_id(spark, sf_dir, posts, "id")


def reddit_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reddit posts, from ``events``."""
    events = read(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS string) AS id",
        "user_id",
        "ts",
        f"{_case('event_type', SUBREDDITS)} AS subreddit",
        "CAST(floor(value) AS int) AS up",
        "CAST(floor(value / 4) AS int) AS down",
    )
    posts = events.selectExpr(
        "id",
        "concat('u_', user_id) AS username",
        "CAST(ts AS timestamp) AS posted_at",
        "subreddit",
        "up AS upvote_count",
        "down AS downvote_count",
        "up - down AS score",
        "0 AS like_count",
        "0 AS retweet_count",
        "0 AS comment_count",
        "0 AS quote_count",
        "concat('/r/', subreddit, '/comments/', id) AS permalink",
    )
    return _with_doc_id(spark, sf_dir, posts, "id")


def document_scores(spark: SparkSession, sf_dir: str, *, text: bool = False) -> DataFrame:
    """Per document: stand-in sentiment and topic, and the text where asked for."""
    categories = {name: category for _, name, category in fixed.TOPIC_RULES}
    topic_categories = {lang: categories[topic] for lang, topic in TOPIC_OF_LANGUAGE.items()}
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.selectExpr(
        "doc_id",
        "CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' WHEN toxic IS NOT NULL THEN 'neutral' END"
        " AS sentiment_label",
        "CAST((3333 + doc_id * 37 % 6667) / 10000 AS decimal(6,5)) AS sentiment_score",
        f"{_case('lang', TOPIC_OF_LANGUAGE, fixed.OTHER_TOPIC[0])} AS topic_label",
        f"{_case('lang', topic_categories, fixed.OTHER_TOPIC[1])} AS topic_category",
        *(["text AS text_content"] if text else []),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both platforms, tagged with source and channel."""
    both = union_platforms(x_posts(spark, sf_dir), reddit_posts(spark, sf_dir))
    return both.withColumn("channel", channel(F.col("source_type"), F.col("subreddit")))


def staged_posts(spark: SparkSession, sf_dir: str, *, text: bool = False) -> DataFrame:
    """Posts with sentiment and topic, as the transform step stages them."""
    return posts(spark, sf_dir).join(document_scores(spark, sf_dir, text=text), "doc_id").drop("doc_id", "channel")
