"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products.

Tokens are runs of letters, digits and non-ASCII bytes, or single other
characters. A text's features are hashed n-grams (one and two tokens), n-grams
of token shapes (case, symbol) up to three, and marks for a token that repeats
one of the three before it; each counts by its share of all features. The score is the logistic
function of one sparse dot product with the weights.

Training reads a bounded sample: ``TRAIN_ROWS`` labelled rows with the smallest
hash of their id, whatever the size of the data. Executors turn them into
sparse vectors; only those reach the driver. Scoring reads every whole text.

Null and empty texts have no features and get the bias alone. Without any
labelled row every score is 0.5 and every row is predicted 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import words
from agora.llm.shared import held_out, portions, utf8

BITS = 18
TRAIN_ROWS = 4000
SCALE = 30.0

_KIND = np.full(256, 2, np.uint8)  # 0 space, 1 word byte, 2 symbol
_KIND[words.SPACE] = 0
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
U = np.uint64


def features(raw: np.ndarray, ends: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts, and the text each belongs to (both sorted by nothing in particular)."""
    kind = _KIND[raw]
    w_start, w_stop = words.spans(kind == 1, ends)
    s_start = np.flatnonzero(kind == 2)
    starts = np.concatenate([w_start, s_start])
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    stops = np.concatenate([w_stop, s_start + 1])[order]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(ends, starts, side="right") - 1
    token = words.hashes(words.LOWER[raw], starts, stops)
    upper = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_UPPER[raw], out=upper[1:])
    caps, length = upper[stops] - upper[starts], stops - starts
    first = _UPPER[raw[starts]]
    case = np.where(caps == 0, 0, np.where((caps == length) & (length > 1), 2, np.where((caps == 1) & (first == 1), 1, 3)))
    shape = words.mix(np.where(kind[starts] == 2, raw[starts].astype(np.int64) + 16, case).astype(np.uint64))
    mask, all_features, owners = U((1 << bits) - 1), [], []

    def add(hashed: np.ndarray, owner: np.ndarray, salt: int) -> None:
        all_features.append((words.mix(hashed + U(salt)) & mask).astype(np.int64))
        owners.append(owner)

    for salt, (values, n) in enumerate(((token, 1), (token, 2), (shape, 1), (shape, 2), (shape, 3))):
        whole = text[n - 1 :] == text[: len(text) - n + 1]
        add(words.ngrams(values, n)[whole], text[n - 1 :][whole], salt * 7919)
    for back in (1, 2, 3):
        again = (token[back:] == token[:-back]) & (text[back:] == text[:-back])
        add(np.where(again, U(back), U(back + 16)), text[back:], 77003)
    return np.concatenate(all_features), np.concatenate(owners)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for each text."""
        raw, ends = utf8(texts)
        margin = np.full(len(texts), self.bias)
        for a, b in portions(ends, words.PORTION):
            hit, owner = features(raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a], self.bits)
            n = np.bincount(owner, minlength=b - a)
            dot = np.bincount(owner, self.weights[hit], minlength=b - a)
            margin[a:b] += SCALE * dot / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, passes: int = 4,
          alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> Model:
    """FTRL-proximal over (label, feature numbers, values) rows, in the given order."""
    size = (1 << bits) + 1  # the last is the bias, which is not shrunk by l1
    z, n, penalty = np.zeros(size), np.zeros(size), np.full(size, l1)
    penalty[-1] = 0

    def weight(i):
        zi = z[i]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - penalty[i], 0)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    for _ in range(passes):
        for label, index, value in rows:
            i, x = np.append(index, size - 1), np.append(value, 1.0)
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    w = weight(np.arange(size))
    return Model(w[:-1].astype(np.float32), float(w[-1]), bits)


def _sparse(batches):
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        index, value = [], []
        for a, b in portions(ends, words.PORTION):
            hit, owner = features(raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(b - a + 1))
            hit = hit[order]
            for k in range(b - a):
                i, c = np.unique(hit[cut[k] : cut[k + 1]], return_counts=True)
                index.append(i.astype(np.int32))
                value.append((SCALE * c / max(1, c.sum())).astype(np.float32))
        yield pa.record_batch([
            batch.column("place"), batch.column("label"),
            pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32())),
        ], names=["place", "label", "hits", "shares"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> Model:
    """A model from a bounded sample of labelled rows that are not held out.

    Rows with a null id or label are no examples; of several labels of an id
    the mean decides (half and more: 1), of several texts the least.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    one = known.groupBy(F.col(key).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    place = F.xxhash64(F.col("_id").cast("string"), F.lit("quality"))
    # At most `rows` narrow rows: small enough to be sent to every executor, and checked by the limit.
    chosen = one.withColumn("place", place).orderBy("place", "_id").limit(rows)
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "place", "label").agg(F.min("text").alias("text"))
    found = found.select("place", "label", "text")
    sparse = found.mapInArrow(_sparse, "place long, label int, hits array<int>, shares array<float>").toArrow().sort_by("place")
    examples = list(zip(sparse["label"].to_pylist(), map(np.asarray, sparse["hits"].to_numpy()),
                        map(np.asarray, sparse["shares"].to_numpy()), strict=True))
    return train(examples)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Column with the probability of label 1 of each whole text."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.scores(texts))

    return quality(text)


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from a score of one half on) instead of columns of these names."""
    out = docs.withColumn("score", score(docs.sparkSession, model, F.col(text)))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
