"""Registered queries: projection, filters, order, paging, embedding and search."""

from __future__ import annotations

import json
from itertools import islice

from pyspark.sql import functions as F

from agora import schemas
from agora.catalog import sql as S
from agora.catalog.registry import query
from agora.functions.text import tokenize, trigram_similarity
from agora.operators import query as Q
from agora.operators import search
from agora.sources import sample_posts as sample
from agora.sources.local import small_table


@query("project", "SELECT o_orderkey, o_orderstatus FROM orders")
def project(spark, sf):
    return Q.query(sample.read(spark, sf, "orders"), select=["o_orderkey", "o_orderstatus"])


@query(
    "embed_related",
    """SELECT o.o_orderkey, l.l_linenumber, coalesce(l.l_quantity, -1) AS l_quantity FROM orders o
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
)
def embed_related(spark, sf):
    """Orders with their lines embedded as an array; shown flattened. Some orders have none."""
    orders = sample.read(spark, sf, "orders").select("o_orderkey")
    lines = sample.read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    nested = Q.embed_related(orders, lines, ["o_orderkey"], ["l_linenumber", "l_quantity"], "lines", child_key=["l_linenumber"], parts=4)
    flat = nested.select("o_orderkey", F.explode("lines").alias("line"))
    # An order without lines has only empty parts: one row stands for them.
    bare = orders.join(lines.select("o_orderkey").distinct(), "o_orderkey", "left_anti")
    flat = flat.unionByName(bare, allowMissingColumns=True)
    return flat.select("o_orderkey", "line.l_linenumber", F.coalesce("line.l_quantity", F.lit(-1.0)).alias("l_quantity"))


@query(
    "embed_one",
    """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'none') AS quality, coalesce(CAST(l.toxic AS VARCHAR), 'none') AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def embed_one(spark, sf):
    """Documents with their labels embedded as a struct; some have none."""
    documents = sample.read(spark, sf, "documents").select("doc_id")
    nested = Q.embed_one(documents, sample.read(spark, sf, "labels"), ["doc_id"], ["quality", "toxic"], "labels")
    return nested.select("doc_id", *[F.coalesce(F.col(f"labels.{c}").cast("string"), F.lit("none")).alias(c) for c in ("quality", "toxic")])


@query(
    "filter_compare",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus <> 'F'
AND l_quantity > 10 AND l_quantity <= 40 AND l_discount >= 0.02 AND l_tax < 0.07""",
)
def filter_compare(spark, sf):
    """All six comparisons, two of them on one column."""
    where = [
        ("l_returnflag", "eq", "N"),
        ("l_linestatus", "neq", "F"),
        ("l_quantity", "gt", 10),
        ("l_quantity", "lte", 40),
        ("l_discount", "gte", 0.02),
        ("l_tax", "lt", 0.07),
    ]
    return Q.query(sample.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], where)


@query(
    "filter_like",
    """SELECT doc_id FROM documents WHERE text LIKE '%the%' AND text ILIKE '%AND%' AND source LIKE 'src_'""",
)
def filter_like(spark, sf):
    where = [("text", "like", "%the%"), ("text", "ilike", "%AND%"), ("source", "like", "src_")]
    return Q.query(sample.read(spark, sf, "documents"), ["doc_id"], where)


@query(
    "filter_is",
    f"""WITH {S.SCORES} SELECT doc_id FROM document_scores WHERE sentiment_label IS NULL AND (score_parts >= 5000) IS TRUE""",
)
def filter_is(spark, sf):
    df = sample.document_scores(spark, sf).withColumn("strong", F.col("sentiment_score") >= 0.5)
    return Q.query(df, ["doc_id"], [("sentiment_label", "is", "null"), ("strong", "is", "true")])


@query(
    "filter_in",
    """SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def filter_in(spark, sf):
    """A written list and a list held in a table."""
    short = Q.query(sample.read(spark, sf, "orders"), where=[("o_orderpriority", "in", ["1-URGENT", "2-HIGH"])])
    wanted = sample.read(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return Q.filter_in_table(short, "o_custkey", wanted.withColumnRenamed("c_custkey", "o_custkey")).select("o_orderkey")


@query(
    "filter_array_contains",
    r"""SELECT doc_id FROM documents WHERE list_has_all(string_split_regex(text, '\s+'), ['the', 'of'])""",
)
def filter_array_contains(spark, sf):
    docs = sample.read(spark, sf, "documents").withColumn("words", tokenize(F.col("text")))
    return Q.query(docs, ["doc_id"], [("words", "contains", ["the", "of"])])


@query(
    "order_limit_offset",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey ASC NULLS LAST LIMIT 50 OFFSET 20""",
)
def order_limit_offset(spark, sf):
    order = [("o_totalprice", True), ("o_orderkey", False)]
    return Q.query(sample.read(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], order=order, limit=50, offset=20)


@query(
    "seek_pages",
    """SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(row_number() OVER w AS BIGINT) AS place FROM orders
WINDOW w AS (ORDER BY o_orderstatus ASC NULLS LAST, o_totalprice DESC NULLS FIRST, o_orderkey ASC NULLS LAST)
ORDER BY place LIMIT 150""",
)
def seek_pages(spark, sf):
    """Three pages of fifty, each found by what comes after the last row of the one before; columns in mixed directions."""
    orders = sample.read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    order = [("o_orderstatus", False), ("o_totalprice", True), ("o_orderkey", False)]
    found = [row for rows in islice(Q.pages(orders, order, 50), 3) for row in rows]
    shown = [(*row, place) for place, row in enumerate(found, 1)]
    return spark.createDataFrame(shown, orders.schema.add("place", "long"))


@query(
    "single_row",
    """SELECT c_custkey, c_name FROM customer WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer)
AND c_custkey = (SELECT min(c_custkey) FROM customer WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer))""",
)
def single_row(spark, sf):
    """The customer with the highest balance; two would be an error."""
    customers = sample.read(spark, sf, "customer")
    richest = customers.agg(F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("k")).scalar()
    found = customers.where(F.col("c_custkey") == richest).select("c_custkey", "c_name")
    Q.single_row(found)
    return found


@query(
    "page_with_total",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS total_count
FROM lineitem WHERE l_returnflag = 'R'
ORDER BY l_extendedprice DESC NULLS FIRST, l_orderkey NULLS LAST, l_linenumber NULLS LAST LIMIT 25 OFFSET 100""",
)
def page_with_total(spark, sf):
    returned = Q.query(
        sample.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_extendedprice"], [("l_returnflag", "eq", "R")]
    )
    order = [("l_extendedprice", True), ("l_orderkey", False), ("l_linenumber", False)]
    return Q.page_with_total(returned, order, 25, 100)


@query("text_search", "SELECT doc_id FROM documents WHERE contains(lower(text), 'ation the')")
def text_search(spark, sf):
    return search.text_search(sample.read(spark, sf, "documents"), "text", "ation THE").select("doc_id")


_TRIGRAMS = r"""list_distinct(flatten(list_transform(list_distinct(regexp_extract_all(lower({t}), '[\p{{L}}\p{{N}}]+')),
  lambda w: list_transform(range(1, CAST(length(w) + 2 AS BIGINT)), lambda i: substr('  ' || w || ' ', i, 3)))))"""
_NEEDLE = "the station and the nation of women"


@query(
    "trigram_similarity",
    f"""WITH g AS (SELECT doc_id, {_TRIGRAMS.format(t="text")} AS a, {_TRIGRAMS.format(t=S.text(_NEEDLE))} AS b FROM documents),
s AS (SELECT doc_id, len(list_intersect(a, b)) AS shared, len(a) AS na, len(b) AS nb FROM g)
SELECT doc_id, round(CAST(shared AS DOUBLE) / (na + nb - shared), 9) AS similarity FROM s""",
)
def trigram_similarity_(spark, sf):
    score = trigram_similarity(F.col("text"), F.lit(_NEEDLE))
    return sample.read(spark, sf, "documents").select("doc_id", F.round(score, 9).alias("similarity"))


@query(
    "similar_texts",
    f"""WITH g AS (SELECT doc_id, {_TRIGRAMS.format(t="text")} AS a, {_TRIGRAMS.format(t=S.text(_NEEDLE))} AS b FROM documents),
s AS (SELECT doc_id, CAST(len(list_intersect(a, b)) AS DOUBLE) / (len(a) + len(b) - len(list_intersect(a, b))) AS similarity FROM g)
SELECT doc_id, round(similarity, 9) AS similarity FROM s WHERE similarity >= 0.1""",
)
def similar_texts(spark, sf):
    """Documents at least a tenth similar to a phrase."""
    found = search.similar_texts(sample.read(spark, sf, "documents"), "text", _NEEDLE, 0.1)
    return found.select("doc_id", F.round("similarity", 9).alias("similarity"))


_SEARCHES = [("the", "indonesia, economy"), ("le", "investasi"), ("der", "personalfinance,unlisted"), ("of", None)]
_SEARCH_ROWS = S.values(
    [("the", "r/indonesia"), ("the", "r/economy"), ("le", "r/investasi"), ("der", "r/personalfinance"),
     ("der", "r/unlisted"), ("of", "X_global")]
)
_HITS = f"""{S.STAGED}, wanted(query, channel) AS (VALUES {_SEARCH_ROWS}),
hits AS (SELECT w.query, p.channel, p.id, p.posted_at FROM staged p JOIN wanted w ON p.channel = w.channel
  WHERE contains(p.text_content, w.query))"""


def _hits(spark, sf, searches=None):
    posts = sample.posts(spark, sf).select("id", "channel", "posted_at", "doc_id")
    texts = sample.document_scores(spark, sf, text=True).select("doc_id", "text_content")
    searches = small_table(spark, schemas.SEARCH, _SEARCHES) if searches is None else searches
    return search.keyword_search(posts.join(texts, "doc_id"), searches).select("query", "channel", "id", "posted_at")


@query("keyword_search", f"WITH {_HITS} SELECT query, channel, id FROM hits")
def keyword_search(spark, sf):
    """Posts of each search's channels whose text holds its query."""
    return _hits(spark, sf).drop("posted_at")


@query("searches_from_config", f"WITH {_HITS} SELECT query, channel, id FROM hits")
def searches_from_config(spark, sf):
    """The same searches, read from the configuration table's JSON."""
    listed = [{"query": q, "subreddit": s} for q, s in _SEARCHES]
    value = json.dumps({"nitter": [x for x in listed if not x["subreddit"]], "reddit": [x for x in listed if x["subreddit"]]})
    config = small_table(spark, schemas.APP_CONFIG, [("scrape-config", value, None), ("other", "{}", None)])
    return _hits(spark, sf, search.searches_from_config(config)).drop("posted_at")


@query(
    "topk_per_query",
    f"""WITH {_HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY posted_at DESC, id) AS query_rank FROM hits)
SELECT query, channel, id, query_rank FROM r WHERE query_rank <= 100""",
)
def topk_per_query(spark, sf):
    """The hundred newest posts per search: one result page."""
    out = search.topk_per_query(_hits(spark, sf), 100)
    return out.select("query", "channel", "id", F.col("query_rank").cast("long").alias("query_rank"))
