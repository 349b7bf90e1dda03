"""Topics: train LDA, name topics by keyword rules, assign each post its best topic."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora import fixed, schemas
from agora.functions.text import tokenize
from agora.operators import lda
from agora.session import work_dir
from agora.sources.local import small_table

_TOPIC_WORDS = schemas.columns(topic_no=schemas.INT, _words=schemas.WORDS)

Rule = tuple[Sequence[str], str, str]


# Words are counted in this many slots by their hash: no word is dropped, and
# the model's size does not grow with the texts.
SLOTS = 1 << 18


@dataclass(frozen=True)
class TopicModel:
    topics: lda.Topics
    slots: int
    top: list[tuple[int, list[str]]]  # topic, its words, best first


def label_rules(
    keywords: Column, rules: Sequence[Rule] = fixed.TOPIC_RULES, other: tuple[str, str] = fixed.OTHER_TOPIC
) -> Column:
    """struct(topic_label, topic_category) of the first rule sharing a word with ``keywords``."""

    def named(label: str, category: str) -> Column:
        return F.struct(F.lit(label).alias("topic_label"), F.lit(category).alias("topic_category"))

    out = named(*other)
    for words, label, category in reversed(rules):
        hit = F.arrays_overlap(keywords, F.array(*[F.lit(w) for w in words]))
        out = F.when(hit, named(label, category)).otherwise(out)
    return out


def _slot(word: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(slots)).cast("int")


def _slots(text_col: str, slots: int) -> Column:
    return F.transform(tokenize(F.coalesce(F.col(text_col), F.lit(""))), lambda w: _slot(w, slots))


def fit_topics(
    df: DataFrame, text_col: str, k: int, *, slots: int = SLOTS, iterations: int = 20, seed: int = 17, naming: int = 10
) -> TopicModel:
    """Hashed bag of words and online variational LDA over every text in each iteration.

    The bags are written once to the shared folder. A slot is named after its
    most frequent word (the least of several). What the driver holds is
    k x slots numbers, whatever the data.
    """
    bags = lda.blocks(df.select(_slots(text_col, slots).alias("_slots")), slots)
    # Every pass reads them.
    topics = lda.fit(lda.stored(bags, work_dir(df.sparkSession, "bags")), slots, k, iterations, seed)
    # k rows of a few slots each, whatever the corpus; so is the dictionary of these slots.
    best = topics.top(naming)
    wanted = sorted({s for of in best for s in of})
    tokens = tokenize(F.coalesce(F.col(text_col), F.lit("")))
    each = df.select(F.explode(F.filter(tokens, lambda w: _slot(w, slots).isin(wanted))).alias("word"))
    counted = each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    name = F.min(F.struct(-F.col("n"), "word"))["word"].alias("word")
    names = dict(counted.groupBy(_slot(F.col("word"), slots).alias("slot")).agg(name).collect())
    return TopicModel(topics, slots, [(topic, [names[s] for s in of]) for topic, of in enumerate(best)])


def topic_table(
    spark: SparkSession, model: TopicModel, rules: Sequence[Rule] = fixed.TOPIC_RULES, *, kept: int = 5
) -> DataFrame:
    """One row per topic: its label and category by its top words, and the words kept."""
    table = small_table(spark, _TOPIC_WORDS, model.top)
    return table.select(
        "topic_no",
        label_rules(F.col("_words"), rules).alias("_l"),
        F.slice("_words", 1, kept).alias("top_keywords"),
    ).select("topic_no", "_l.*", "top_keywords")


def assign_topic(df: DataFrame, text_col: str, model: TopicModel, rules: Sequence[Rule] = fixed.TOPIC_RULES) -> DataFrame:
    """Add label, category and keywords of each post's most probable topic, the first on ties.

    Posts without tokens are unclassified. Topic names come from a join with
    the table of the k topics, so rules run once per topic.
    """
    tokens = df.withColumn("_slots", _slots(text_col, model.slots))
    best = lda.best_topic(model.topics, F.col("_slots"), df.sparkSession.sparkContext)
    scored = tokens.withColumn("topic_no", F.when(F.size("_slots") > 0, best))
    named = scored.join(topic_table(df.sparkSession, model, rules), "topic_no", "left")
    return with_topic_default(named).select(*df.columns, "topic_no", "topic_label", "topic_category", "top_keywords")


def with_topic_default(df: DataFrame) -> DataFrame:
    """Posts no topic was found for get the fixed label and no keywords."""
    label, category = fixed.NO_TOPIC
    return df.withColumns(
        {
            "topic_label": F.coalesce("topic_label", F.lit(label)),
            "topic_category": F.coalesce("topic_category", F.lit(category)),
            "top_keywords": F.coalesce("top_keywords", F.array().cast("array<string>")),
        }
    )
