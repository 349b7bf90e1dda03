from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from agora import fixed
from agora.catalog.star import facts
from agora.operators import sentiment, topics
from agora.operators.dims import default_dimensions, dim_time
from agora.plans.star import MONTHLY, summarise
from agora.plans.views import VIEW_KEYS, VIEWS, view
from agora.plans.warehouse import Warehouse
from agora.session import work_dir
from agora.sources import tables

X_SCRAPE = (
    "id string, fullname string, username string, text_content string, posted_at timestamp, like_count int, "
    "comment_count int, retweet_count int, quote_count int, seq int"
)
R_SCRAPE = (
    "id string, username string, text_content string, subreddit string, posted_at timestamp, score int, "
    "upvote_count int, downvote_count int, permalink string, seq int"
)


def x(id_, at, text, likes, seq=1):
    return (id_, "Ana", "ana", text, at, likes, None, 0, 0, seq)


def score(df):
    return sentiment.lexicon_sentiment(df, "processed_text", ["bagus"], ["buruk"])


def topic(df):
    found = topics.label_rules(F.split("processed_text", " "))
    return df.withColumn("_t", found).select("*", "_t.*").drop("_t").withColumn("top_keywords", F.array(F.lit("bbm")))


@pytest.fixture
def house(spark):
    return Warehouse(spark, work_dir(spark, "house"))


def fill(house, spark):
    posts = [
        x("1", datetime(2023, 1, 5), "harga bbm bagus", 5, seq=1),
        x("1", datetime(2023, 1, 5), "harga bbm bagus sekali", 50, seq=2),
        x("2", datetime(2024, 7, 1), "listrik buruk", 0),
        x("3", datetime(2027, 7, 1), "terlalu jauh", 1),
    ]
    house.upload(fixed.X_SOURCE, spark.createDataFrame(posts, X_SCRAPE), ["seq"])
    reddit = [
        ("1", "bo", "pajak bagus", "economy", datetime(2024, 7, 2), 3, 12, 2, "/r/economy/1", 1),
        ("9", "bo", "apa saja", "lain", datetime(2024, 7, 2), 3, 1, 2, "/r/lain/9", 1),
    ]
    house.upload(fixed.REDDIT_SOURCE, spark.createDataFrame(reddit, R_SCRAPE), ["seq"])


def run(house):
    for source in (fixed.X_SOURCE, fixed.REDDIT_SOURCE):
        house.transform(source, score, topic, tlds=fixed.COMMON_TLDS)
    house.load()


def test_from_scrape_to_views(house, spark):
    fill(house, spark)
    assert {(r.id, r.like_count, r.is_processed) for r in house.raw(fixed.X_SOURCE).collect()} == {
        ("1", 50, False), ("2", 0, False), ("3", 1, False)
    }
    run(house)
    facts = {(r.platform_id, r.source_id): r for r in house.facts().collect()}
    assert set(facts) == {(1, "1"), (1, "2"), (3, "1")}
    assert facts[1, "1"].topic_id == 1 and facts[1, "1"].sentiment_id == 1 and facts[1, "1"].engagement_tier == "Medium"
    assert facts[1, "1"]["part"] == "2023" and facts[1, "2"].sentiment_id == 4
    assert {(r.source_id, r.reject_reason) for r in house.rejected().collect()} == {
        ("3", "date not in dim_time"), ("9", "channel not in dim_platform")
    }
    assert house.staged().count() == 0
    assert house.raw(fixed.X_SOURCE).where("not is_processed").count() == 0

    # A second run, a repeated scrape and a repeated load change nothing.
    before = sorted(map(tuple, house.facts().drop("loaded_at").collect()), key=repr)
    run(house)
    fill(house, spark)
    run(house)
    assert sorted(map(tuple, house.facts().drop("loaded_at").collect()), key=repr) == before
    assert house.rejected().count() == 2

    house.refresh_views(version="v1")
    full = {name: sorted(map(tuple, house.view(name).collect()), key=repr) for name in VIEWS}
    assert [r.post_count for r in house.view("mv_topic_volume").collect()] == [1, 1, 1]
    house.refresh_views(years=[2024], version="v2")
    assert {name: sorted(map(tuple, house.view(name).collect()), key=repr) for name in VIEWS} == full


def test_load_finishes_what_a_dead_run_left(house, spark):
    fill(house, spark)
    for source in (fixed.X_SOURCE, fixed.REDDIT_SOURCE):
        house.transform(source, score, topic, tlds=fixed.COMMON_TLDS)
        house.transform(source, score, topic, tlds=fixed.COMMON_TLDS)  # staged once all the same
    assert house.staged().count() == 5
    staged = house.staged().persist()
    staged.count()
    assert house.load() == 3
    # The run died before staging was cleared: its rows are staged again.
    tables.append_table(staged, house._path("staging"))
    staged.unpersist()
    assert house.load_and_refresh() == 0
    assert (house.facts().count(), house.rejected().count(), house.staged().count()) == (3, 2, 0)


def test_other_sessions_see_the_views_and_replace_single_years(house, spark):
    fill(house, spark)
    run(house)
    with pytest.raises(LookupError):
        house.view("mv_topic_volume")
    with pytest.raises(LookupError):
        house.refresh_views(years=[2024])
    house.refresh_views()
    full = {name: sorted(map(tuple, house.view(name).collect()), key=repr) for name in VIEWS}
    other = Warehouse(spark.newSession(), house.root)
    other.refresh_views(years=[2024])
    assert {name: sorted(map(tuple, other.view(name).collect()), key=repr) for name in VIEWS} == full
    assert {r.year for r in other.view("mv_topic_volume").collect()} == {2023, 2024}


def stored_facts(house, rows, at):
    rows = tables.with_partition(rows, "year").withColumn("loaded_at", F.lit(at).cast("timestamp"))
    tables.append_table(rows, house._path("fact_post"))


def rows_of_views(house):
    return {name: sorted(map(tuple, house.view(name).collect()), key=repr) for name in VIEWS}


def test_a_refresh_adds_what_was_loaded_since(house, spark, sf_dir):
    """Three loads, each refreshed from its own facts, equal one full rebuild; a refresh by years asks for a full one."""
    fact, house.dims = facts(spark, sf_dir)
    part = F.pmod(F.xxhash64("source_id"), F.lit(3))
    for k in range(3):
        stored_facts(house, fact.where(part == k), f"2024-01-0{k + 1}")
        house.refresh_views()
    by_loads = rows_of_views(house)
    assert by_loads["mv_topic_volume"] and house._current().loaded_until == datetime(2024, 1, 3)
    house.refresh_views(full=True)
    assert rows_of_views(house) == by_loads
    house.refresh_views()  # nothing new
    assert rows_of_views(house) == by_loads
    stored_facts(house, fact.where(part == 0).withColumn("source_id", F.concat(F.lit("again"), "source_id")), "2024-01-04")
    house.refresh_views(years=[2024])
    house.refresh_views()
    after = rows_of_views(house)
    house.refresh_views(full=True)
    assert rows_of_views(house) == after != by_loads


def test_a_refresh_reads_only_facts_loaded_since(house, spark, sf_dir, monkeypatch):
    fact, house.dims = facts(spark, sf_dir)
    stored_facts(house, fact.where("platform_id = 1"), "2024-01-01")
    house.refresh_views()
    stored_facts(house, fact.where("platform_id <> 1").limit(7), "2024-01-02")
    plans = []

    def watched(rows, *more):
        plans.append(rows)
        return summarise(rows, *more)

    monkeypatch.setattr("agora.plans.warehouse.summarise", watched)
    house.refresh_views()
    (read,) = plans
    scan = read._jdf.queryExecution().executedPlan()
    assert read.count() == 7 and "GreaterThan(loaded_at,2024-01-01" in scan.toString()
    # Row groups of the first load are not decoded.
    noop = read.select("like_count", "loaded_at")
    executed = noop._jdf.queryExecution()
    noop_rows = executed.executedPlan().executeCollect()
    leaves = executed.executedPlan().collectLeaves()
    assert len(noop_rows) == 7 and leaves.apply(0).metrics().apply("numOutputRows").value() == 7


def test_views_left_stale_by_a_dead_run_are_built(house, spark):
    fill(house, spark)
    run(house)  # loads, and dies before the refresh
    assert house.load_and_refresh() == 0 and house.view("mv_topic_volume").count() == 3
    version = house._current().version
    assert house.load_and_refresh() == 0 and house._current().version == version


def test_years_of_a_longer_calendar(spark):
    dims = replace(default_dimensions(spark), time=dim_time(spark, "2023-01-01", "2028-12-31"))
    for last in (2026, 2028):
        house = Warehouse(spark, work_dir(spark, "house"), dims, last_year=last)
        fill(house, spark)
        run(house)
        house.refresh_views()
        house.refresh_views(years=[2027])
        assert {r.year for r in house.view("mv_topic_volume").collect()} == {2023, 2024, 2027}


def test_processing_leaves_raw_files_alone_and_reads_what_was_uploaded(house, spark):
    fill(house, spark)
    files = sorted(house._stored_raw(fixed.X_SOURCE).inputFiles())
    assert sorted(house._pending_parts(fixed.X_SOURCE)) == ["2023_q1", "2024_q3", "default"]
    run(house)
    assert sorted(house._stored_raw(fixed.X_SOURCE).inputFiles()) == files and house._pending_parts(fixed.X_SOURCE) == []
    house.upload(fixed.X_SOURCE, spark.createDataFrame([x("7", datetime(2023, 2, 1), "saham bagus", 1)], X_SCRAPE), ["seq"])
    assert house._pending_parts(fixed.X_SOURCE) == ["2023_q1"]
    house.transform(fixed.X_SOURCE, score, topic, tlds=fixed.COMMON_TLDS)
    assert [r.id for r in house.staged().collect()] == ["7"]
    assert {r.id: r.is_processed for r in house.raw(fixed.X_SOURCE).collect()} == {"1": True, "2": True, "3": True, "7": False}
    assert house.load() == 1
    ids = [r.post_id for r in house.facts().collect()]
    assert len(set(ids)) == len(ids) == 4 and None not in ids
    assert [r.key for r in house.config().collect()] == ["last-updated"]


def test_labels_of_other_rules_reach_the_views(house, spark):
    def own(df):
        named = {"topic_label": F.lit("Cuaca"), "topic_category": F.lit("Alam"), "top_keywords": F.array(F.lit("hujan"))}
        return df.withColumns(named)

    fill(house, spark)
    house.transform(fixed.X_SOURCE, score, own, tlds=fixed.COMMON_TLDS)
    house.transform(fixed.REDDIT_SOURCE, score, topic, tlds=fixed.COMMON_TLDS)
    house.load_and_refresh()
    rows = {r.topic_label: r for r in house.dimensions().topic.collect()}
    assert rows["Cuaca"].topic_id == 13 and rows["Cuaca"].top_keywords == ["hujan"]
    assert rows["Fiskal & Pajak"].topic_id == 4 and rows["Fiskal & Pajak"].top_keywords == ["bbm"]
    assert {r.topic_label for r in house.view("mv_topic_volume").collect()} == {"Cuaca", "Fiskal & Pajak"}
    again = Warehouse(spark, house.root)
    again.load()
    assert sorted(map(repr, again.dimensions().topic.collect())) == sorted(map(repr, rows.values()))


def test_cleaning_options(house, spark):
    config = spark.createDataFrame([("slang-mapping", '{"x": "y"}'), ("unnecessary-hashtags", None)], "key string, value string")
    assert house.cleaning_options(config) == {"slang": {"x": "y"}, "dropped_hashtags": fixed.DROPPED_HASHTAGS}


def test_overwrite_touches_only_its_partitions(spark):
    path = work_dir(spark, "parts")
    df = spark.createDataFrame([("a", "2023", 1), ("b", "2024", 2)], "k string, part string, v int")
    tables.append_table(df, path)
    stored = tables.read_table(spark, path, df.schema)
    tables.overwrite_partitions(stored.where("part = '2024'").withColumn("v", F.col("v") + 40), path)
    assert {tuple(r) for r in tables.read_table(spark, path, df.schema).select("k", "part", "v").collect()} == {
        ("a", "2023", 1), ("b", "2024", 42)
    }


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    from agora.catalog.star import facts

    return facts(spark, sf_dir)


UNIQUE = {
    "mv_temporal_sentiment": ["year", "month", "topic_label", "sentiment_label", "platform_name"],
    "mv_platform_comparison": [
        "platform_name", "channel", "year", "quarter", "topic_label", "sentiment_label", "confidence_bucket"
    ],
    "mv_topic_volume": ["year", "quarter", "topic_label", "platform_name"],
    "mv_engagement_by_sentiment": [
        "sentiment_label", "confidence_bucket", "platform_name", "engagement_tier", "year", "quarter"
    ],
}


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_views_are_unique_and_equal_from_either_summary(star, name):
    fact, dims = star
    alone = view(name, fact, dims)
    shared = VIEWS[name](summarise(fact, dims, MONTHLY), dims)
    rows = sorted(map(tuple, alone.collect()), key=repr)
    assert rows == sorted(map(tuple, shared.collect()), key=repr)
    assert alone.select(*UNIQUE[name]).distinct().count() == len(rows)
    assert set(VIEW_KEYS[name]) <= set(MONTHLY)


def test_deviation_is_exact_for_close_scores(spark, star):
    _, dims = star
    fact = spark.createDataFrame(
        [(1, 1, 1, 1, s) for s in ("0.99999", "0.99998", "0.99999")],
        "time_id int, platform_id int, topic_id int, sentiment_id int, s string",
    ).select(
        "*",
        F.col("s").cast("decimal(6,5)").alias("sentiment_score"),
        *[F.lit(0).alias(c) for c in ("like_count", "retweet_count", "comment_count", "upvote_count", "downvote_count")],
        F.lit("Zero").alias("engagement_tier"),
    )
    row = view("mv_temporal_sentiment", fact, dims).first()
    assert row.stddev_sentiment_score == pytest.approx(5.7735026919e-06, rel=1e-9)
    single = view("mv_temporal_sentiment", fact.limit(1), dims).first()
    assert single.stddev_sentiment_score is None and single.avg_sentiment_score == 0.99999
