"""Language identification by a byte convolutional network, trained and applied in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes. Filters two,
three and four bytes wide run over each window; every filter's largest response
(max pooling) feeds a softmax over the languages. A text's score for a language
is the mean of its windows' probabilities, weighted by their bytes, so all of a
text counts and a foreign passage counts by its length. Responses of two neighbouring bytes come from one table.

Training reads a bounded sample: of each language the ``PER_LANGUAGE`` rows
with the smallest hash of their id, four windows spread over each whole text.

Null texts and texts without a letter are ``und`` with score 1. Without any labelled
row every text is ``und`` with score 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agora.llm import words
from agora.llm.shared import held_out, portions, stored, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LANGUAGE = 400
WINDOWS_PER_ROW = 4
UNKNOWN = "und"
# Windows handled in one go: their responses stay in the processor's cache.
PORTION = 128

_letter = regex.compile(r"\p{L}").search


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS)
    dense: np.ndarray  # (filters of all widths, languages)
    bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Largest response of every filter in each window (rows of WINDOW bytes)."""
        if not hasattr(self, "_pairs"):
            both = lambda a, b: np.ascontiguousarray((a[:, None] + b[None]).reshape(65536, -1), np.float32)
            two, three, four = self.tables
            self._pairs = both(two[0], two[1]), both(three[0], three[1]), both(four[0], four[1]), both(four[2], four[3])
            self._third = three[2].astype(np.float32)
        out = []
        for a in range(0, len(windows), PORTION):
            x = windows[a : a + PORTION].astype(np.int32)
            pair = (x[:, :-1] << 8) | x[:, 1:]
            two, three, front, back = self._pairs
            out.append(np.concatenate([
                two[pair].max(1),
                (three[pair[:, :-1]] + self._third[x[:, 2:]]).max(1),
                (front[pair[:, :-2]] + back[pair[:, 2:]]).max(1),
            ], axis=1))
        return np.concatenate(out)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        raw, ends = utf8(texts)
        names, scores = [UNKNOWN] * len(texts), np.ones(len(texts))
        if not self.languages:
            return names, np.zeros(len(texts))
        n, total = np.zeros(len(texts)), np.zeros((len(texts), len(self.languages)))
        # Windows take many times the room of their bytes, so a batch is cut in portions.
        for a, b in portions(ends, words.PORTION):
            windows, owner, weight = cut(raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
            if not len(windows):
                continue
            logits = self.pooled(windows) @ self.dense + self.bias
            share = np.exp(logits - logits.max(1, keepdims=True))
            share *= (weight / share.sum(1))[:, None]
            n[a:b] = np.bincount(owner, weight, b - a)
            total[a:b] = np.stack([np.bincount(owner, s, b - a) for s in share.T], 1)
        p = total / np.maximum(n, 1)[:, None]
        best = p.argmax(1)
        for k, text in enumerate(texts):
            if n[k] and _letter(text.as_py()):
                names[k], scores[k] = self.languages[best[k]], p[k, best[k]]
        return names, scores


def cut(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over all bytes of all texts (zeros after a text's end), the text and the bytes of each."""
    sizes = np.diff(ends)
    count = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = ends[:-1][owner] + number * WINDOW
    weight = np.minimum(WINDOW, ends[1:][owner] - start)
    place = np.arange(WINDOW)
    padded = np.concatenate([raw, np.zeros(WINDOW, np.uint8)])
    windows = padded[start[:, None] + place]
    windows[place >= weight[:, None]] = 0
    return windows, owner, weight


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], passes: int = 6, batch: int = 64,
          rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the cross entropy of the windows' languages (``labels`` are places in ``languages``)."""
    random = np.random.default_rng(seed)
    tables = [random.normal(0, 0.1, (w, 256, FILTERS)) for w in WIDTHS]
    dense = random.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
    values = [*tables, dense, np.zeros(len(languages))]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(passes):
        order = random.permutation(len(windows))
        for a in range(0, len(order), batch):
            x, y = windows[order[a : a + batch]], labels[order[a : a + batch]]
            n, tops, pooled = len(x), [], []
            for table, w in zip(values, WIDTHS):
                response = sum(table[k][x[:, k : WINDOW - w + 1 + k]] for k in range(w))
                tops.append(response.argmax(1))
                pooled.append(np.take_along_axis(response, tops[-1][:, None], 1)[:, 0])
            hidden = np.concatenate(pooled, 1)
            logits = hidden @ values[-2] + values[-1]
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y] -= 1
            p /= n
            slopes = [np.zeros_like(v) for v in values]
            slopes[-2], slopes[-1] = hidden.T @ p + 1e-4 * values[-2], p.sum(0)
            back = p @ values[-2].T
            for j, w in enumerate(WIDTHS):
                part = back[:, j * FILTERS : (j + 1) * FILTERS]
                for k in range(w):
                    byte = np.take_along_axis(x, tops[j] + k, 1)
                    np.add.at(slopes[j][k], (byte, np.arange(FILTERS)[None]), part)
            step += 1
            for v, g, m, s in zip(values, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(languages, [v.astype(np.float32) for v in values[:3]], values[-2], values[-1])


def _sample(batches):
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        windows, owner, weight = cut(raw, ends)
        chosen = []
        for k in range(len(ends) - 1):
            mine = np.flatnonzero((owner == k) & (weight >= min(64, ends[k + 1] - ends[k])))
            chosen.extend(mine[np.unique(np.linspace(0, len(mine) - 1, WINDOWS_PER_ROW).astype(int))] if len(mine) else [])
        yield pa.record_batch([
            batch.column("place").take(pa.array(owner[chosen])), batch.column("lang").take(pa.array(owner[chosen])),
            pa.array([windows[k].tobytes() for k in chosen], pa.binary()),
        ], names=["place", "lang", "bytes"])


# How many times the wanted number of ids is ranked.
SPARE = 4


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """A network from a bounded sample of rows with a language that are not held out.

    Ids are ranked by a hash, so texts of the chosen rows only are shuffled to
    the training. Of a language with many ids only those take part in the rank whose hash is below
    ``SPARE`` times the share wanted: a few thousand rows a language meet, not
    a number that grows with the table. (That fewer than ``per_language`` are below it is as good as impossible.)
    Of several texts of an id in a language the least is taken.
    """
    usable = F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull() & ~held_out(key)
    rows = docs.where(usable).select(F.col(key).alias("_id"), F.col(lang).alias("lang")).distinct()
    place = F.xxhash64(F.col("_id").cast("string"), F.lit("language"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    # The hash as a number from 0 to 1.
    share = (F.col("place").cast("double") + 2.0**63) / 2.0**64
    ranked = rows.withColumn("place", place).join(sizes, "lang").where(share * F.col("_n") <= SPARE * per_language).drop("_n")
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "_id")))
    chosen = ranked.where(F.col("_rank") <= per_language).select("_id", "lang", "place")
    # Stored first, so that Spark knows its size and need not shuffle the texts to a short list.
    chosen = stored(chosen, "chosen")
    texts = docs.where(usable).select(F.col(key).alias("_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = texts.join(chosen, ["_id", "lang"]).groupBy("_id", "lang", "place").agg(F.min("text").alias("text"))
    found = found.select("place", "lang", "text")
    sample = found.mapInArrow(_sample, "place long, lang string, bytes binary").toArrow()
    sample = sample.sort_by([("place", "ascending"), ("lang", "ascending"), ("bytes", "ascending")])
    names = sorted(set(sample["lang"].to_pylist()))
    if not names:
        return Network([], [], np.zeros((0, 0)), np.zeros(0))
    windows = np.frombuffer(b"".join(sample["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    at = {name: k for k, name in enumerate(names)}
    return train(windows, np.array([at[v] for v in sample["lang"].to_pylist()]), names)


def identify(spark: SparkSession, network: Network, text: Column) -> Column:
    """Struct column (lang_pred, score) of each whole text."""
    sent = spark.sparkContext.broadcast(network)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def language(texts: pa.Array) -> pa.Array:
        names, scores = sent.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return language(text)
