import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from agora import schemas
from agora.operators import dims as D
from agora.operators import load, raw
from agora.operators.keys import in_ranges, surrogate_keys

RAW = "id string, posted_at timestamp, text_content string, like_count int, is_processed boolean"


def at(day):
    return datetime(2024, 1, day)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_keep_last_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    captures = [("twitter", "hot" if i % 3 == 0 else str(rng.randrange(40)), i, rng.choice([None, "a", "b"])) for i in range(3000)]
    rng.shuffle(captures)
    df = spark.createDataFrame(captures, "source_type string, id string, seq int, v string").repartition(8)
    last = {}
    for source, id_, seq, v in sorted(captures, key=lambda r: r[2]):
        last[source, id_] = (source, id_, seq, v)
    out = raw.dedup_keep_last(df, ["source_type", "id"], ["seq"])
    assert out.columns == df.columns and rows(out) == sorted(last.values(), key=repr)


def test_upsert_rules(spark):
    target = spark.createDataFrame(
        [("1", at(1), "old", 5, True), ("2", at(1), "old", 6, False), ("1", at(2), "old", 7, True)], RAW
    )
    source = spark.createDataFrame(
        [("1", at(1), None, 50), ("3", at(3), "new", 8)], "id string, posted_at timestamp, text_content string, like_count int"
    )
    merged = raw.upsert_raw(target, source)
    expected = sorted(
        [("1", at(1), None, 50, True), ("2", at(1), "old", 6, False), ("1", at(2), "old", 7, True), ("3", at(3), "new", 8, False)],
        key=repr,
    )
    assert rows(merged) == expected
    assert rows(raw.upsert_raw(merged, source)) == expected


def test_mark_processed_is_by_id_and_time(spark):
    df = spark.createDataFrame([("1", at(1), "a", 1, False), ("1", at(2), "a", 1, False), ("2", at(1), "a", 1, True)], RAW)
    ids = spark.createDataFrame([("1", at(1)), ("1", at(1))], "id string, posted_at timestamp")
    assert rows(raw.mark_processed(df, ids), "id", "posted_at", "is_processed") == [
        ("1", at(1), True), ("1", at(2), False), ("2", at(1), True),
    ]


def test_insert_if_absent_and_delete(spark):
    known = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    both = raw.insert_if_absent(known, new, ["k"])
    assert rows(both) == [("a", 1), ("b", 2)]
    assert rows(raw.insert_if_absent(both, new, ["k"])) == rows(both)
    assert rows(raw.delete_by_ids(both, new.where("v = 3"), ["k"])) == [("a", 1)]


def test_prepare_raw(spark):
    df = spark.createDataFrame(
        [("1", float("nan"), 3, "x"), ("2", None, None, "y")], "id string, score double, upvote_count bigint, junk string"
    )
    out = raw.prepare_raw(df, schemas.RAW_REDDIT, schemas.REDDIT_COUNTS)
    assert out.columns == ["id", "score", "upvote_count", "scraped_at"]
    assert rows(out, "id", "score", "upvote_count") == [("1", 0, 3), ("2", 0, 0)]
    assert out.where("scraped_at is null").count() == 0


def test_union_fills_missing_columns(spark):
    x = spark.createDataFrame([("1", 2)], "id string, like_count int")
    reddit = spark.createDataFrame([("1", "r")], "id string, subreddit string")
    assert rows(raw.union_platforms(x, reddit), "source_type", "id", "like_count", "subreddit") == [
        ("reddit", "1", None, "r"), ("twitter", "1", 2, None),
    ]


def test_config(spark):
    config = spark.createDataFrame([("a", "1", None), ("b", None, None)], schemas.APP_CONFIG)
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert rows(raw.config_lookup(config, keys, "dflt")) == [("a", "1"), ("b", None), ("c", "dflt")]
    entry = spark.createDataFrame([("a", "2"), ("last-updated", "now")], "key string, value string")
    assert rows(raw.set_config(config, entry), "key", "value") == [("a", "2"), ("b", None), ("last-updated", "now")]


def test_pack_and_unpack_extra(spark):
    df = spark.createDataFrame([("1", "ana", None, 3, 4, 5)], "id string, username string, like_count int, retweet_count int, comment_count int, quote_count int")
    packed = raw.pack_extra(df, schemas.X_EXTRA.fieldNames())
    assert '"like_count":null' in packed.first().extra
    assert rows(raw.unpack_extra(packed, schemas.X_EXTRA), *df.columns) == rows(df)


def test_time_window_is_half_open(spark):
    df = spark.createDataFrame([("a", "2023-12-31 23:59:59"), ("b", "2024-01-01 00:00:00"), ("c", "2024-12-31 23:59:59"), ("d", "2025-01-01 00:00:00")], "id string, p string")
    df = df.withColumn("posted_at", F.to_timestamp("p"))
    assert rows(raw.time_window_filter(df, "2024-01-01", "2025-01-01"), "id") == [("b",), ("c",)]


@pytest.mark.parametrize("rows_per_range", [100, 1_000_000])
def test_surrogate_keys_are_dense_and_repeatable(spark, rows_per_range):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("i"))
    one = rows(surrogate_keys(df.repartition(8), ["k", "i"], "n", start=11, rows_per_range=rows_per_range), "k", "i", "n")
    two = rows(surrogate_keys(df.repartition(3), ["k", "i"], "n", start=11, rows_per_range=rows_per_range), "k", "i", "n")
    assert one == two and sorted(n for *_, n in one) == list(range(11, 5011))
    assert [r[:2] for r in sorted(one, key=lambda r: r[2])] == sorted(r[:2] for r in one)


def test_ranges_of_skewed_keys_are_even(spark):
    """A third of the rows share the first key column; no range holds more than twice the mean."""
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("i"))
    sizes = [r["count"] for r in in_ranges(df.repartition(8), ["k", "i"], 4000).groupBy("_range").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 2 * 4000


def test_dim_topic_grows_without_renumbering(spark):
    results = spark.createDataFrame(
        [("Energi", "Riil", ["bbm"]), ("Energi", "Riil", ["gas"]), ("Lainnya", "Umum", []), (None, None, None)],
        "topic_label string, topic_category string, top_keywords array<string>",
    )
    first = D.build_dim_topic(results)
    more = spark.createDataFrame([("Energi", "Riil", ["x"]), ("Pajak", "Makro", ["apbn"])], results.schema)
    second = D.build_dim_topic(more, first)
    ids = {r.topic_label: r.topic_id for r in first.collect()}
    grown = {r.topic_label: r.topic_id for r in second.collect()}
    assert sorted(ids.values()) == [1, 2] and grown == {**ids, "Pajak": 3}
    assert {tuple(r.top_keywords) for r in second.where("topic_label = 'Energi'").collect()} == {("bbm",)}
    assert rows(D.build_dim_topic(more, second)) == rows(second)


def test_extend_platforms(spark):
    known = D.dim_platform(spark)
    seen = spark.createDataFrame([("Reddit", "r/baru"), ("X", "X_global"), ("Reddit", "r/baru")], "platform_name string, channel string")
    grown = {(r.platform_name, r.channel): r.platform_id for r in D.extend_platforms(known, seen).collect()}
    assert len(grown) == 6 and grown["Reddit", "r/baru"] == 6 and grown["X", "X_global"] == 1


def test_loading_twice_adds_nothing(spark):
    schema = "platform_id int, source_id string, posted_at timestamp, v int"
    batch = spark.createDataFrame([(1, "a", at(1), 1), (1, "a", at(1), 1), (1, "a", at(2), 2), (2, "a", at(1), 3)], schema)
    empty = batch.limit(0)
    once = load.new_facts(empty, batch)
    assert once.count() == 3
    assert load.new_facts(once, batch).count() == 0
