import random

import pytest
from pyspark.sql import functions as F

from agora import schemas
from agora.operators import query as Q
from agora.operators import search
from agora.sources.local import empty_table, small_table


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "Ana", None, ["a", "b"]), (2, "bo", True, ["b"]), (3, None, False, None), (4, "ana_x", True, [])]
    return spark.createDataFrame(rows, "id int, name string, flag boolean, tags array<string>")


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize(
    "where, expected",
    [
        ([("id", "eq", 2)], [2]),
        ([("name", "neq", "bo")], [1, 4]),
        ([("id", "gt", 1), ("id", "lt", 4)], [2, 3]),
        ([("id", "gte", 2), ("id", "lte", 3)], [2, 3]),
        ([("name", "like", "an%")], [4]),
        ([("name", "ilike", "AN%")], [1, 4]),
        ([("flag", "is", "null")], [1]),
        ([("flag", "is", True)], [2, 4]),
        ([("flag", "is", "false")], [3]),
        ([("id", "in", [1, 4, 9])], [1, 4]),
        ([("tags", "contains", ["b"])], [1, 2]),
        ([("tags", "contains", ["a", "b"])], [1]),
        ([("tags", "contains", [])], [1, 2, 4]),
    ],
)
def test_filters(table, where, expected):
    assert ids(Q.query(table, where=where, order=[("id", False)])) == expected


def test_null_order_limit_offset_and_projection(table):
    assert ids(Q.query(table, order=[("name", False), ("id", False)])) == [1, 4, 2, 3]
    assert ids(Q.query(table, order=[("name", True), ("id", False)])) == [3, 2, 4, 1]
    page = Q.query(table, ["id"], order=[("id", True)], limit=2, offset=1)
    assert page.columns == ["id"] and ids(page) == [3, 2]


def test_unknown_filters_are_refused(table):
    with pytest.raises(ValueError):
        Q.query(table, where=[("id", "between", 1)])
    with pytest.raises(ValueError):
        Q.query(table, where=[("id", "is", "maybe")])


def test_single_row(table):
    assert Q.single_row(table.where("id = 2")).name == "bo"
    with pytest.raises(LookupError):
        Q.single_row(table.where("id > 9"))
    with pytest.raises(LookupError):
        Q.single_row(table)


def test_page_with_total_counts_the_whole_result(table):
    rows = Q.page_with_total(table.where("id > 1"), [("id", False)], 2).collect()
    assert [(r.id, r.total_count) for r in rows] == [(2, 3), (3, 3)]


@pytest.mark.parametrize("parts", [1, 5])
def test_embedding_has_one_shape_and_keeps_every_child(spark, parts):
    parents = spark.range(4).withColumnRenamed("id", "p")
    children = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 3).alias("p"), F.col("id").alias("c"))
    rows = Q.embed_related(parents, children, ["p"], ["c"], "kids", child_key=["c"], parts=parts).collect()
    assert sorted((r.p, r.kids_part) for r in rows) == [(p, k) for p in range(4) for k in range(parts)]
    for p in range(4):
        assert sorted(k.c for r in rows if r.p == p for k in r.kids) == [c for c in range(3000) if c % 3 == p]



def test_embed_one(spark, table):
    labels = spark.createDataFrame([(1, "x", 9)], "id int, label string, n int")
    rows = {r.id: r.topic for r in Q.embed_one(table, labels, ["id"], ["label"], "topic").collect()}
    assert rows[1].label == "x" and rows[2] is None


def test_search_channels(spark):
    searches = small_table(spark, schemas.SEARCH, [("bbm", "indonesia, economy"), ("umr", None), ("", "economy"), (None, None)])
    got = {tuple(r) for r in search.search_channels(searches).collect()}
    assert got == {("bbm", "r/indonesia"), ("bbm", "r/economy"), ("umr", "X_global")}


def test_searches_from_config(spark):
    value = '{"nitter": [{"query": "umr", "depth": 2}], "reddit": [{"query": "bbm", "subreddit": "economy"}]}'
    config = spark.createDataFrame([("scrape-config", value, None), ("other", "1", None)], schemas.APP_CONFIG)
    got = {tuple(r) for r in search.searches_from_config(config).collect()}
    assert got == {("umr", None), ("bbm", "economy")}
    only = config.select("key", F.lit('{"reddit": [{"query": "x"}]}').alias("value"))
    assert [tuple(r) for r in search.searches_from_config(only).collect()] == [("x", None)]


def test_text_search_is_literal(spark):
    df = spark.createDataFrame([(1, "Naik 100% hari ini"), (2, "naik 1000"), (3, None)], "id int, t string")
    assert ids(search.text_search(df, "t", "NAIK 100%")) == [1]
    assert ids(search.similar_texts(df, "t", "naik hari ini", 0.5)) == [1]


@pytest.mark.parametrize("k", [5, 1500])
def test_topk_against_brute_force_with_a_hot_query(spark, k):
    rng = random.Random(3)
    hits = [("hot" if i % 2 else f"q{rng.randrange(5)}", f"{i:05d}", rng.randrange(300)) for i in range(6000)]
    df = spark.createDataFrame(hits, "query string, id string, posted_at int").repartition(8)
    expected = []
    for name in {h[0] for h in hits}:
        best = sorted((h for h in hits if h[0] == name), key=lambda h: (-h[2], h[1]))[:k]
        expected += [(*h, n) for n, h in enumerate(best, 1)]
    got = [tuple(r) for r in search.topk_per_query(df, k).select("query", "id", "posted_at", "query_rank").collect()]
    assert sorted(got) == sorted(expected)


def test_small_and_empty_tables(spark):
    assert small_table(spark, schemas.SEARCH, []).count() == 0
    empty = empty_table(spark, schemas.STAGED)
    assert empty.count() == 0 and empty.columns == schemas.STAGED.fieldNames()


ORDERS = [[("a", False), ("b", True), ("c", False)], [("a", True), ("b", False), ("c", True)], [("c", True)]]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("size", [1, 4, 7, 100])
def test_pages_joined_are_the_whole_order(spark, order, size):
    """Nulls and ties in every column but the last, directions mixed."""
    values = [None, None, 1, 2, 2]
    rows = [(a, b, i * 25 + k * 5 + m) for i, a in enumerate(values) for k, b in enumerate(values) for m in range(2)]
    df = spark.createDataFrame(rows[::-1], "a int, b int, c int").persist()
    whole = Q.query(df, order=order).collect()
    if size == 1:
        df = df.where("c < 12")
        whole = Q.query(df, order=order).collect()
    found = list(Q.pages(df, order, size))
    assert [r for page in found for r in page] == whole
    assert all(len(page) == size for page in found[:-1])


def test_a_cursor_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    page = orders.where(Q.after([("o_totalprice", True), ("o_orderkey", False)], [1000.5, 7]))
    assert "LessThanOrEqual(o_totalprice,1000.5)" in page._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        Q.after([("o_totalprice", True)], [1, 2])


def posts_and_searches(spark):
    texts = ["he she hers", "shell", "", None, "ushers " * 30, "café", "nothing"]
    posts = spark.createDataFrame(
        [(i, c, t) for i, t in enumerate(texts) for c in ("X_global", "r/economy", "r/none")], "id int, channel string, text_content string"
    )
    words = ["he", "she", "his", "hers", "é", "not in any", *[f"w{i}" for i in range(10_000)]]
    return posts, small_table(spark, schemas.SEARCH, [*[(w, None) for w in words], ("he", "economy"), ("hers", "economy")])


@pytest.mark.parametrize("library", [True, False])
def test_many_searches_of_a_channel(spark, monkeypatch, library):
    """Ten thousand searches of one channel: no row per post and search before the match."""
    posts, searches = posts_and_searches(spark)
    if not library:
        monkeypatch.setattr(search, "find_spec", lambda name: None)
    found = search.keyword_search(posts, searches)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("ArrowEvalPython" in plan) == library and plan.count("ArrowEvalPython") <= 1
    wanted = [("X_global", w) for w in ["he", "she", "his", "hers", "é"]] + [("r/economy", "he"), ("r/economy", "hers")]
    expected = sorted((r.id, c, q) for r in posts.collect() for c, q in wanted if r.channel == c and q in (r.text_content or ""))
    assert sorted((r.id, r.channel, r["query"]) for r in found.collect()) == expected
    # Rows that meet the searches: one per post of a searched channel.
    assert posts.join(search.search_channels(searches).select("channel").distinct(), "channel").count() == 14
