"""Sentiment scoring: a pluggable model, a trainable default, a word-list scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora import fixed
from agora.functions.text import tokenize

# Loads a model once per worker and returns a function from texts to
# (class name, probability) pairs. Truncation is the model's own business.
Scorer = Callable[[], Callable[[Sequence[str]], Sequence[tuple[str, float]]]]

BATCH = 16


def _label_of(model_class: Column) -> Column:
    out = F.lit("neutral")
    for name, label in fixed.MODEL_LABELS.items():
        out = F.when(model_class == name, label).otherwise(out)
    return out


def by_length(texts: Sequence[str], predict: Callable, batch_size: int) -> list[tuple[str, float]]:
    """``predict`` over batches of texts of about the same length, which a model pads to their longest; results in the given order."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    found: list = [None] * len(texts)
    for start in range(0, len(order), batch_size):
        places = order[start : start + batch_size]
        for place, result in zip(places, predict([texts[i] for i in places]), strict=True):
            found[place] = result
    return found


def score_sentiment(df: DataFrame, text_col: str, scorer: Scorer, batch_size: int = BATCH, max_tokens: int | None = None) -> DataFrame:
    """Add ``sentiment_label`` and ``sentiment_score`` (confidence, four decimals) from a model.

    Null texts are scored as ''. Class names the label table lacks are neutral.
    The model runs inside an Arrow-batched UDF and is loaded once per worker;
    its batches are formed by length, so that little is padded. ``max_tokens``
    cuts texts to so many blank-separated tokens, for models that read no more; by default they get whole texts.
    """
    text = F.col(text_col)
    if max_tokens is not None:
        text = F.array_join(F.slice(tokenize(F.coalesce(text, F.lit(""))), F.lit(1), F.lit(max_tokens)), " ")

    @F.pandas_udf("struct<cls: string, prob: double>")
    def model(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = scorer()
        for texts in batches:
            yield pd.DataFrame(by_length(texts.fillna("").tolist(), predict, batch_size), columns=["cls", "prob"])

    scored = df.withColumn("_s", model(text))
    return scored.withColumns(
        {
            "sentiment_label": _label_of(F.col("_s.cls")),
            "sentiment_score": F.round(F.col("_s.prob"), 4).cast("decimal(6,5)"),
        }
    ).drop("_s")


def train_sentiment(
    labelled: DataFrame, text_col: str, label_col: str, *, features: int = 1 << 16, iterations: int = 20
) -> PipelineModel:
    """Fit the default scorer: hashed word counts and multinomial logistic regression, all on the JVM."""
    tokens = tokenize(F.coalesce(F.col(text_col), F.lit("")))
    data = labelled.select(tokens.alias("_tokens"), F.col(label_col).alias("_label"))
    index = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc").fit(data)
    stages = [
        index,
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        LogisticRegression(
            featuresCol="_tf", labelCol="_y", predictionCol="_yhat", probabilityCol="_prob",
            rawPredictionCol="_raw", maxIter=iterations, regParam=0.01, family="multinomial",
        ),
        IndexToString(inputCol="_yhat", outputCol="_class", labels=index.labels),
    ]
    return Pipeline(stages=stages).fit(data)


def score_with_model(df: DataFrame, text_col: str, model: PipelineModel) -> DataFrame:
    """Like ``score_sentiment`` with a fitted Spark ML model: no Python in the row path."""
    scorer = PipelineModel([s for s in model.stages if not s.uid.startswith("StringIndexer")])
    tokens = df.withColumn("_tokens", tokenize(F.coalesce(F.col(text_col), F.lit(""))))
    out = scorer.transform(tokens)
    confidence = F.array_max(vector_to_array(F.col("_prob")))
    return out.select(
        *df.columns,
        F.col("_class").alias("sentiment_label"),
        F.round(confidence, 4).cast("decimal(6,5)").alias("sentiment_score"),
    )


def lexicon_sentiment(df: DataFrame, text_col: str, positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    """Label by counting listed words; confidence is the majority's share of the hits.

    Each row is scored on its own: the lists are hash sets inside the plan, so
    nothing is exploded, joined or shuffled.
    """
    tokens = F.transform(tokenize(F.coalesce(F.col(text_col), F.lit(""))), F.lower)
    scored = df.withColumn("_tokens", tokens)
    count = lambda words: F.size(F.filter("_tokens", lambda w: w.isin(sorted(set(words)))))
    scored = scored.withColumn("positive_hits", count(positive)).withColumn("negative_hits", count(negative))
    pos, neg = F.col("positive_hits"), F.col("negative_hits")
    label = F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")
    share = F.when(pos + neg == 0, F.lit(0.0)).otherwise(F.greatest(pos, neg) / (pos + neg))
    return scored.withColumn("sentiment_label", label).withColumn("sentiment_score", F.round(share, 4)).drop("_tokens")


def weighted_lexicon_sentiment(df: DataFrame, key: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """Label by the sums of positive and of negative weights; confidence is the larger sum's share.

    ``lexicon`` (word in lower case, weight) is a table of any size; repeated words add up. Each
    distinct word of a text meets it once, with the number of times it occurs;
    ``key`` must be unique in ``df``. Sums are decimals, so their order does not matter.
    """
    known = lexicon.groupBy(F.col("word").alias("_word")).agg(F.sum(F.col("weight").cast("decimal(18,6)")).alias("_weight"))
    tokens = F.sort_array(F.transform(tokenize(F.coalesce(F.col(text_col), F.lit(""))), F.lower))
    # Sorted, copies of a word are neighbours: a word's count is the distance between its first place and the next word's.
    starts = F.filter(F.transform("_tokens", lambda w, i: F.when((i == 0) | (w != F.get("_tokens", i - 1)), i)), lambda i: i.isNotNull())
    each = df.select(key, tokens.alias("_tokens")).withColumn("_starts", starts)
    counted = F.transform("_starts", lambda s, k: F.struct(
        F.get("_tokens", s).alias("_word"), (F.coalesce(F.get("_starts", k + 1), F.size("_tokens")) - s).alias("_times")))
    words = each.select(key, F.inline(counted))
    met = words.join(known, "_word").withColumn("_part", F.col("_weight") * F.col("_times"))
    zero = F.lit(0).cast("decimal(28,6)")
    sums = met.groupBy(key).agg(
        F.sum(F.when(F.col("_part") > 0, F.col("_part")).otherwise(zero)).alias("positive_weight"),
        F.sum(F.when(F.col("_part") < 0, -F.col("_part")).otherwise(zero)).alias("negative_weight"),
    )
    out = df.join(sums, key, "left")
    pos, neg = (F.coalesce(F.col(c), zero).cast("double") for c in ("positive_weight", "negative_weight"))
    label = F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")
    share = F.when(pos + neg == 0, F.lit(0.0)).otherwise(F.greatest(pos, neg) / (pos + neg))
    return out.withColumns({
        "positive_weight": pos, "negative_weight": neg, "sentiment_label": label, "sentiment_score": F.round(share, 4),
    })
