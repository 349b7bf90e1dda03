"""Explicit schemas of the stored tables and of the records that enter."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, TIME, FLAG = T.StringType(), T.IntegerType(), T.TimestampType(), T.BooleanType()
WORDS, SCORE = T.ArrayType(T.StringType()), T.DecimalType(6, 5)


def columns(**kinds: T.DataType) -> T.StructType:
    """A schema from name=type pairs, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


RAW_X = columns(
    id=STRING, fullname=STRING, username=STRING, text_content=STRING, posted_at=TIME,
    like_count=INT, comment_count=INT, retweet_count=INT, quote_count=INT,
    scraped_at=TIME, is_processed=FLAG,
)
RAW_REDDIT = columns(
    id=STRING, username=STRING, text_content=STRING, subreddit=STRING, posted_at=TIME,
    score=INT, upvote_count=INT, downvote_count=INT, permalink=STRING,
    scraped_at=TIME, is_processed=FLAG,
)
X_COUNTS = ["like_count", "comment_count", "retweet_count", "quote_count"]
REDDIT_COUNTS = ["score", "upvote_count", "downvote_count"]

STAGED = columns(
    id=STRING, source_type=STRING, text_content=STRING, processed_text=STRING, posted_at=TIME,
    sentiment_label=STRING, sentiment_score=SCORE, topic_label=STRING, topic_category=STRING, top_keywords=WORDS,
    comment_count=INT, like_count=INT, retweet_count=INT, quote_count=INT, subreddit=STRING, username=STRING,
    score=INT, upvote_count=INT, downvote_count=INT, permalink=STRING,
)
FACT = columns(
    post_id=STRING, source_id=STRING, source_url=STRING, time_id=INT, platform_id=INT, topic_id=INT, sentiment_id=INT,
    like_count=INT, comment_count=INT, quote_count=INT, retweet_count=INT, upvote_count=INT, downvote_count=INT,
    sentiment_score=SCORE, engagement_tier=STRING, posted_at=TIME, loaded_at=TIME,
)
REJECT = columns(source_type=STRING, source_id=STRING, posted_at=TIME, channel=STRING, reject_reason=STRING)
APP_CONFIG = columns(key=STRING, value=STRING, created_at=TIME)

# Dimensions whose rows are written out in code.
PLATFORM = columns(platform_id=INT, platform_name=STRING, channel=STRING)
TOPIC = columns(topic_id=INT, topic_label=STRING, topic_category=STRING)
SENTIMENT = columns(sentiment_id=INT, sentiment_label=STRING, confidence_bucket=STRING)

# Platform-specific fields carried beside a pending row.
X_EXTRA = columns(username=STRING, like_count=INT, retweet_count=INT, comment_count=INT, quote_count=INT)
REDDIT_EXTRA = columns(
    username=STRING, subreddit=STRING, upvote_count=INT, downvote_count=INT, score=INT, permalink=STRING
)

# One JSON search response. created_utc is read as text: providers send it
# both as a number and as a quoted number.
JSON_RESPONSE = columns(
    data=T.ArrayType(
        columns(
            id=STRING, author=STRING, selftext=STRING, body=STRING, subreddit=STRING,
            created_utc=STRING, score=INT, ups=INT, downs=INT, permalink=STRING,
        )
    )
)

# One search of the scrape configuration; subreddit may list several, by commas.
SEARCH = columns(query=STRING, subreddit=STRING)
SEARCH_CONFIG = columns(nitter=T.ArrayType(SEARCH), reddit=T.ArrayType(SEARCH))

# Posts that have been loaded; uploads and scans of raw partitions; settings over time.
PROCESSED = columns(source_type=STRING, id=STRING, posted_at=TIME)
UPLOAD = columns(source_type=STRING, touched=STRING, uploaded_at=TIME)
SCAN = columns(source_type=STRING, scanned_at=TIME)
SETTING = columns(key=STRING, value=STRING, written_at=TIME)
STORED_TOPIC = columns(topic_id=INT, topic_label=STRING, topic_category=STRING, top_keywords=WORDS, written_at=TIME)

# One row per built version of the views; loaded_until: the newest fact it holds; by_years: some years hold newer ones.
VIEW_VERSION = columns(version=STRING, built_at=TIME, loaded_until=TIME, by_years=T.BooleanType())

# A Bloom filter over the keys that one append wrote to one place of a table.
KEY_FILTER = columns(n_keys=T.LongType(), bits=T.BinaryType(), bucket=INT)

# Capture logs: the places each segment holds rows of; the version that holds a place's rows up to a segment.
SEGMENT = columns(_segment=T.LongType(), part=STRING, bucket=INT, written_at=TIME)
COMPACTED = columns(part=STRING, bucket=INT, version=STRING, upto=T.LongType(), written_at=TIME)
