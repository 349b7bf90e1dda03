"""Text search, keyword search per channel and newest posts per query."""

from __future__ import annotations

from importlib.util import find_spec

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora import fixed, schemas
from agora.functions.text import trigram_similarity


def text_search(df: DataFrame, column: str, needle: str) -> DataFrame:
    """Rows whose text holds ``needle``, ignoring case."""
    return df.where(F.contains(F.lower(F.col(column)), F.lower(F.lit(needle))))


def similar_texts(df: DataFrame, column: str, needle: str, threshold: float = 0.3) -> DataFrame:
    """Rows at least ``threshold`` similar to ``needle`` by trigrams, with the score."""
    scored = df.withColumn("similarity", trigram_similarity(F.col(column), F.lit(needle)))
    return scored.where(F.col("similarity") >= threshold)


def searches_from_config(config: DataFrame, key: str = "scrape-config") -> DataFrame:
    """The searches stored as JSON under one key of the configuration table."""
    listed = config.where(F.col("key") == key).select(F.from_json("value", schemas.SEARCH_CONFIG).alias("c"))
    every = F.concat(F.coalesce("c.nitter", F.array()), F.coalesce("c.reddit", F.array()))
    return listed.select(F.inline(every))


def search_channels(searches: DataFrame) -> DataFrame:
    """One row per (query, channel): comma-separated subreddits are split, none means X."""
    names = F.coalesce(F.split("subreddit", ","), F.array(F.lit(None).cast("string")))
    return searches.where(F.coalesce(F.col("query"), F.lit("")) != "").select(
        "query", F.explode(names).alias("_sub")
    ).select(
        "query",
        F.when(F.col("_sub").isNull(), F.lit(fixed.X_CHANNEL))
        .otherwise(F.concat(F.lit("r/"), F.trim("_sub")))
        .alias("channel"),
    ).distinct()


# Searches of a channel that are tested one by one; more go to an automaton, whose cost does not grow with their number.
ONE_BY_ONE = 64
# Characters of all searches that may be sent to every task.
SENT_CHARACTERS = 4_000_000


def _automaton_hits(queries: dict[str, list[str]]):
    """Column function (channel, text) -> the channel's searches that the text holds; one pass over the text."""

    @F.arrow_udf("array<string>")
    def found(channels: pa.Array, texts: pa.Array) -> pa.Array:
        import ahocorasick

        out = []
        for channel, text in zip(channels.to_pylist(), texts.to_pylist(), strict=True):
            if channel not in _BUILT:
                automaton = ahocorasick.Automaton()
                for query in queries[channel]:
                    automaton.add_word(query, query)
                automaton.make_automaton()
                _BUILT[channel] = automaton
            out.append(sorted({query for _, query in _BUILT[channel].iter(text)}) if text is not None else [])
        return pa.array(out, pa.list_(pa.string()))

    _BUILT: dict = {}
    return found


def keyword_search(posts: DataFrame, searches: DataFrame) -> DataFrame:
    """Posts of a search's channels whose text holds its query, once per matching query.

    A channel's queries are one array beside its posts, so no row per post and
    search exists before the match. Channels with more than ``ONE_BY_ONE``
    queries are matched by one Aho-Corasick automaton each, as long as those
    queries have ``SENT_CHARACTERS`` together and the library is there.
    """
    wanted = search_channels(searches)
    listed = wanted.groupBy("channel").agg(F.sort_array(F.collect_list("query")).alias("_queries"))
    crowded = listed.where(F.size("_queries") > ONE_BY_ONE)
    length = crowded.agg(F.sum(F.aggregate("_queries", F.lit(0), lambda n, q: n + F.length(q)))).first()[0] or 0
    large = {}
    if 0 < length <= SENT_CHARACTERS and find_spec("ahocorasick"):
        large = {r.channel: r["_queries"] for r in crowded.collect()}
    rest = listed if not large else listed.where(~F.col("channel").isin(sorted(large)))
    tested = posts.join(rest, "channel")
    hits = F.filter("_queries", lambda q: F.contains(F.col("text_content"), q))
    out = tested.withColumn("query", F.explode(hits)).drop("_queries")
    if large:
        here = posts.where(F.col("channel").isin(sorted(large)))
        found = here.withColumn("_hits", _automaton_hits(large)("channel", "text_content"))
        # Not ``explode``: the filter Spark derives from it would match every text a second time.
        found = found.withColumn("query", F.explode_outer("_hits")).where(F.col("query").isNotNull()).drop("_hits")
        out = out.unionByName(found)
    return out


def topk_per_query(
    hits: DataFrame, k: int, *, by: str = "query", newest: str = "posted_at", tie: str = "id", slices: int = 16
) -> DataFrame:
    """The ``k`` newest posts of each query, ties by id.

    The newest k of every slice of a query hold its newest k overall. Ranking
    slices first spreads a query that matches a third of all posts over several
    tasks; Spark also trims each slice to k before the shuffle.
    """
    order = [F.col(newest).desc(), F.col(tie)]
    sliced = hits.withColumn("_slice", F.pmod(F.xxhash64(tie), F.lit(slices)))
    trimmed = sliced.withColumn("_n", F.row_number().over(Window.partitionBy(by, "_slice").orderBy(*order)))
    trimmed = trimmed.where(F.col("_n") <= k).drop("_n", "_slice")
    ranked = trimmed.withColumn("query_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.where(F.col("query_rank") <= k)
