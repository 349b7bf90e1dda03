"""The plans Spark chooses: pruning, pushdown, joins without shuffles, no cross joins."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from agora import fixed
from agora.catalog import load_all
from agora.functions.text import clean_text
from agora.operators.dims import default_dimensions
from agora.operators.query import query
from agora.plans.olap import engagement_effect
from agora.session import work_dir
from agora.sources import sample_posts as sample
from agora.sources import tables

BATCH_ONLY = {"stream_ingest", "stream_dedup", "stream_upsert", "trained_sentiment", "fit_topics", "assign_topic"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(load_all()[0]) - BATCH_ONLY))
def test_no_query_pairs_everything_with_everything(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = query(sample.read(spark, sf_dir, "orders"), ["o_orderkey"], [("o_orderstatus", "eq", "F"), ("o_custkey", "gt", 5)])
    text = plan(df)
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThan(o_custkey,5)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text


def test_views_read_no_text_and_join_dimensions_without_shuffling_facts(spark, sf_dir):
    text = plan(entry.queries()["mv_platform_comparison"](spark, sf_dir))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scans and not any("text:" in line for line in scans)
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 2


def test_year_filter_prunes_partitions(spark):
    path = work_dir(spark, "years")
    df = spark.createDataFrame(
        [("a", "2023-05-01"), ("b", "2024-05-01"), ("c", "2030-01-01")], "id string, p string"
    ).selectExpr(
        "id", "to_timestamp(p) AS posted_at"
    )
    tables.append_table(tables.with_partition(df, "year"), path)
    out = tables.read_window(spark, path, df.schema, "2024-01-01", "2025-01-01", "year")
    assert "PartitionFilters: [part" in plan(out) and "2024" in plan(out) and [r.id for r in out.collect()] == ["b"]


def test_hot_keys_are_reduced_before_the_shuffle(spark, sf_dir):
    text = plan(entry.queries()["dedup_keep_last"](spark, sf_dir))
    assert "partial_max_by" in text and "Window" not in text
    assert "WindowGroupLimit" in plan(entry.queries()["topk_per_query"](spark, sf_dir))


def test_cleaning_hands_python_only_what_it_needs(spark, sf_dir):
    text = plan(clean_text(sample.read(spark, sf_dir, "documents").select("text"), "text", tlds=fixed.COMMON_TLDS))
    assert text.count("ArrowEvalPython") == 2 and "Exchange" not in text
    assert "_unescape(CASE WHEN Contains(" in text and "_nfkc(CASE WHEN RLIKE(" in text


@pytest.mark.parametrize("likes", [[20_000_000] * 20_000 + [1], [2_000_000_000, 1, 7, 0], [5, 5, 5], [10**9, 10**9 + 1]])
def test_engagement_effect_of_large_sums(spark, likes):
    """Sums of squares times counts beyond 19 digits, and deviations far below the mean."""
    dims = default_dimensions(spark)
    ids = {r.sentiment_label: r.sentiment_id for r in dims.sentiment.collect()}
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(likes)], "i int, like_count int").select(
        F.lit(1).alias("platform_id"), F.when(F.col("i") % 2 == 0, ids["negative"]).otherwise(ids["positive"]).alias("sentiment_id"), "like_count",
        *[F.lit(0).alias(c) for c in ("retweet_count", "upvote_count", "comment_count")],
    )
    (got,) = engagement_effect(rows, dims).collect()
    flags = [int(i % 2 == 0) for i in range(len(likes))]
    mean, share = Fraction(sum(likes), len(likes)), Fraction(sum(flags), len(flags))
    spread = float(sum((x - mean) ** 2 for x in likes))
    if not spread:
        assert got.correlation is None
    else:
        both = float(sum((x - mean) * (f - share) for x, f in zip(likes, flags)))
        assert got.correlation == pytest.approx(both / (spread * float(sum((f - share) ** 2 for f in flags))) ** 0.5, rel=1e-12)
    assert got.post_count == len(likes)
