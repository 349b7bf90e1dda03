import math
from decimal import Decimal

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from agora import fixed
from agora.operators import lda, sentiment, topics


def test_pluggable_scorer(spark):
    def keyword_model():
        table = {"a": ("LABEL_0", 0.79996), "b": ("LABEL_2", 0.12344), "": ("LABEL_1", 0.5)}

        def predict(texts):
            assert len(texts) <= 2
            return [table.get(t, ("LABEL_9", 1.0)) for t in texts]

        return predict

    df = spark.createDataFrame([("a",), ("b",), (None,), ("zz",)], "t string").coalesce(1)
    rows = sentiment.score_sentiment(df, "t", keyword_model, batch_size=2).collect()
    assert [(r.sentiment_label, r.sentiment_score) for r in rows] == [
        ("positive", Decimal("0.80000")), ("negative", Decimal("0.12340")),
        ("neutral", Decimal("0.50000")), ("neutral", Decimal("1.00000")),
    ]


def test_default_scorer_learns_its_training_texts(spark):
    data = [("bagus sekali", "positive"), ("buruk sekali", "negative"), ("biasa saja", "neutral")] * 10
    df = spark.createDataFrame(data, "t string, label string")
    model = sentiment.train_sentiment(df, "t", "label", features=1 << 10)
    rows = sentiment.score_with_model(df, "t", model).collect()
    assert all(r.sentiment_label == r.label for r in rows)
    assert all(Decimal("0.34") < r.sentiment_score <= 1 for r in rows)
    assert sentiment.score_with_model(spark.createDataFrame([(None,)], "t string"), "t", model).count() == 1


def test_lexicon(spark):
    df = spark.createDataFrame([("Bagus bagus buruk",), ("buruk",), ("x",), (None,)], "t string")
    rows = sentiment.lexicon_sentiment(df, "t", ["bagus"], ["buruk"]).collect()
    assert [(r.sentiment_label, r.sentiment_score) for r in rows] == [
        ("positive", 0.6667), ("negative", 1.0), ("neutral", 0.0), ("neutral", 0.0)
    ]


@pytest.mark.parametrize(
    "words, expected",
    [
        (["harga", "gaji"], ("Inflasi & Harga", "Ekonomi Makro")),
        (["gaji", "bank"], ("Ketenagakerjaan", "Ekonomi Mikro")),
        (["politik"], ("Kebijakan & Politik", "Politik")),
        (["kucing"], ("Lainnya", "Umum")),
        ([], ("Lainnya", "Umum")),
    ],
)
def test_first_matching_rule_names_the_topic(spark, words, expected):
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert tuple(df.select(topics.label_rules(F.col("w")).alias("l")).first().l) == expected


def test_every_rule_label_is_in_the_topic_dimension(spark):
    from agora.operators.dims import dim_topic_seed

    labels = {r.topic_label for r in dim_topic_seed(spark).collect()}
    assert labels == {l for _, l, _ in fixed.TOPIC_RULES} | {fixed.OTHER_TOPIC[0], fixed.NO_TOPIC[0]}


def test_topics_separate_two_vocabularies(spark):
    docs = [("bbm listrik gas minyak",), ("gaji upah buruh kerja",)] * 20 + [("  ",), (None,), ("unseen",)]
    df = spark.createDataFrame(docs, "t string")
    model = topics.fit_topics(df.where("t like '% %'"), "t", 2, slots=1000, iterations=30)
    table = topics.topic_table(spark, model).collect()
    assert sorted(r.topic_no for r in table) == [0, 1] and all(len(r.top_keywords) <= 5 for r in table)
    out = topics.assign_topic(df, "t", model).groupBy("t", "topic_label", "topic_category").agg(F.count("*").alias("n")).collect()
    named = {r.t: (r.topic_label, r.topic_category) for r in out}
    assert sum(r.n for r in out) == len(docs) and len(out) == 5
    assert named["  "] == named[None] == fixed.NO_TOPIC
    # A text of unknown words is equally likely everywhere: the first topic wins.
    first = next(r for r in table if r.topic_no == 0)
    assert named["unseen"] == (first.topic_label, first.topic_category)
    numbers = {r.t: r.topic_no for r in topics.assign_topic(df, "t", model).select("t", "topic_no").distinct().collect()}
    assert {numbers["bbm listrik gas minyak"], numbers["gaji upah buruh kerja"]} == {0, 1}


def test_weighted_lexicon_against_brute_force(spark):
    lexicon = [("bagus", 2.5), ("buruk", -1.25), ("sekali", 0.5), ("sekali", 0.25), ("netral", 0.0)]
    texts = ["Bagus BAGUS buruk", "buruk buruk buruk sekali", "", None, "apa saja netral", "bagus " * 5000 + "buruk"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    weights = {}
    for word, weight in lexicon:
        weights[word] = weights.get(word, 0) + weight
    got = {r.id: r for r in sentiment.weighted_lexicon_sentiment(df, "id", "t", spark.createDataFrame(lexicon, "word string, weight double")).collect()}
    for i, text in enumerate(texts):
        found = [weights.get(w, 0) for w in (text or "").lower().split()]
        pos, neg = sum(w for w in found if w > 0), -sum(w for w in found if w < 0)
        assert (got[i].positive_weight, got[i].negative_weight) == (pos, neg)
        assert got[i].sentiment_label == ("positive" if pos > neg else "negative" if neg > pos else "neutral")
        assert got[i].sentiment_score == (round(max(pos, neg) / (pos + neg), 4) if pos + neg else 0.0)
    assert got[0].t == "Bagus BAGUS buruk"


def test_batches_are_formed_by_length():
    """Padded tokens: each batch is as wide as its longest text."""
    texts = [" ".join(["w"] * n) for k in range(64) for n in (2, 400)]
    padded = []

    def predict(batch):
        widths = [len(t.split()) for t in batch]
        padded.append(max(widths) * len(batch) - sum(widths))
        return [(t, float(len(t))) for t in batch]

    assert sentiment.by_length(texts, predict, 16) == [(t, float(len(t))) for t in texts]
    assert sum(padded) == 0 and len(padded) == 8
    assert sentiment.by_length([], predict, 16) == []


def test_texts_can_be_cut_for_the_model(spark):
    def counting():
        return lambda texts: [("LABEL_0", len(t.split()) / 1000) for t in texts]

    df = spark.createDataFrame([("w " * 900,), ("a  b\nc",), (None,)], "t string")
    cut = [float(r.sentiment_score) for r in sentiment.score_sentiment(df, "t", counting, max_tokens=512).collect()]
    assert cut == [0.512, 0.003, 0.0]
    assert [float(r.sentiment_score) for r in sentiment.score_sentiment(df, "t", counting).collect()] == [0.9, 0.003, 0.0]


def _plain_updates(beta, counts, prior, least):
    """Parameters of one text by plain updates until they move it by ``least``, and how many those were."""
    params, moved, n = np.ones(len(prior)), 1.0, 0
    while moved > least:
        theta = lda.exp_expected_log(params)
        new = theta * (beta @ (counts / (theta @ beta))) + prior
        params, moved, n = new, np.abs(new - params).mean(), n + 1
    return params, n


def test_texts_settle_in_few_updates_where_plain_ones_go_on(monkeypatch):
    """Each text gets what updates without extrapolation reach, in far fewer of them, next to texts of any length."""
    draw = np.random.default_rng(5)
    k, n_slots, prior = 4, 500, np.full(4, 0.25)
    table = np.hstack([lda.exp_expected_log(draw.gamma(100, 0.01, (k, n_slots))), np.ones((k, 1))])
    words = np.concatenate([draw.integers(1, 60, 40), [3000]])
    slots = [draw.integers(0, n_slots, n) for n in words]
    which, *bag = lda.bag(words, np.concatenate(slots), n_slots)
    updates, real = [], lda._update
    monkeypatch.setattr(lda, "_update", lambda p, *more: updates.append(len(p)) or real(p, *more))
    got = np.empty((len(words), k))
    for some, ids, counts in lda._together(*bag, n_slots):
        got[which[some]] = lda.settle(lda._beta(table, ids, counts), counts, prior)
    assert np.allclose(got.sum(1), words + 1, rtol=1e-5)
    plain = 0
    for text, mine in zip(slots, got):
        at, counts = np.unique(text, return_counts=True)
        plain += _plain_updates(table[:, at], counts, prior, 1e-3)[1]
        # Plain updates lead nowhere else from here.
        theta = lda.exp_expected_log(mine)
        again = theta * (table[:, at] @ (counts / (theta @ table[:, at]))) + prior
        assert np.abs(again - mine).mean() <= lda.SETTLED
    assert sum(updates) < plain / 3


def test_texts_left_over_settle_with_those_of_other_groups(monkeypatch):
    """Every text comes once, with its own words, and settled; the last ones of all groups take fewer calls together."""
    draw = np.random.default_rng(6)
    k, n_slots, prior = 4, 500, np.full(4, 0.25)
    table = np.hstack([lda.exp_expected_log(draw.gamma(100, 0.01, (k, n_slots))), np.ones((k, 1))])
    words = np.concatenate([draw.integers(1, 200, 900), [3000]])
    _, *bag = lda.bag(words, np.concatenate([draw.integers(0, n_slots, n) for n in words]), n_slots)
    calls, real = [], lda._update
    monkeypatch.setattr(lda, "_update", lambda *a: calls.append(1) or real(*a))
    for _, ids, counts in lda._together(*bag, n_slots):
        lda.settle(lda._beta(table, ids, counts), counts, prior)
    alone, met = len(calls), []
    ends = np.cumsum(bag[0])
    for some, ids, counts, beta, params in lda._settled(bag, table, prior):
        met += some.tolist()
        assert beta.shape == (len(some), k, ids.shape[1])
        for text, at, n, mine in zip(some, ids, counts, params):
            own = slice(ends[text] - bag[0][text], ends[text])
            assert (at[at < n_slots] == bag[1][own]).all() and (n[at < n_slots] == bag[2][own]).all() and not n[at == n_slots].any()
            theta = lda.exp_expected_log(mine)
            again = theta * (table[:, at] @ (n / (theta @ table[:, at]))) + prior
            assert np.abs(again - mine).mean() <= 1.1 * lda.SETTLED
    assert sorted(met) == list(range(len(words)))
    assert len(calls) - alone < 0.8 * alone


def test_each_text_counts_once_in_every_pass(spark):
    """The shares a pass adds up are the words' counts, exactly: no text is drawn twice or left out."""
    docs = [(f"a{i % 7} b{i % 5} b{i % 5} c{i}",) for i in range(300)] + [("",), (None,)]
    df = spark.createDataFrame(docs, "t string").repartition(5)
    bags = lda.blocks(df.select(topics._slots("t", 1 << 10).alias("s")), 1 << 10).localCheckpoint()
    counted, (n,) = lda._summed(bags, 1 << 10, 1, lda._totals)
    expected = np.zeros(1 << 10)
    for r in df.select(F.explode(topics._slots("t", 1 << 10)).alias("s")).groupBy("s").count().collect():
        expected[r.s] = r["count"]
    assert n == 300 and (counted[0] == expected).all()
    model = lda.Topics(np.where(counted > 0, np.random.default_rng(1).gamma(100, 0.01, (3, 1 << 10)), 0), np.full(3, 1 / 3))
    sent = spark.sparkContext.broadcast(model.table())
    sums, more = lda._summed(bags, 1 << 10, 3, lda._pass(sent, model.prior))
    assert more[0] == 300 and np.allclose((sums * model.table()[:, :-1]).sum(0), expected, rtol=1e-4)


def test_stored_blocks_are_held_few_at_a_time(spark, tmp_path, monkeypatch):
    """However many blocks a core gets, Parquet writes and reads a few of these large rows at once."""
    path = str(tmp_path / "bags")
    monkeypatch.setattr(topics, "work_dir", lambda spark, name: path)
    monkeypatch.setattr(lda, "BLOCK_SLOTS", 1)
    # One core gets 96 blocks, each a text.
    docs = spark.range(96 * spark.sparkContext.defaultParallelism).select(F.concat(F.lit("w v"), "id").alias("t"))
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        topics.fit_topics(docs, "t", 2, slots=1000, iterations=1)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "bags").glob("*.parquet")]
    held = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(held) == docs.count() and max(held) <= 4


def test_series_of_the_gamma_function():
    x = np.array([1e-3, 0.2, 1.0, 2.5, 7.0, 400.0, 1e7])
    step = 1e-3 * np.minimum(x, 1)
    assert np.allclose(lda.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)
    assert np.allclose(lda.digamma(x), (lda.log_gamma(x + step) - lda.log_gamma(x - step)) / (2 * step), rtol=1e-3, atol=1e-3)
    assert np.allclose(lda.trigamma(x), (lda.digamma(x + step) - lda.digamma(x - step)) / (2 * step), rtol=1e-3, atol=1e-3)
