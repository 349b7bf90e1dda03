"""Online variational LDA over every text in each pass, in blocks of texts.

Method and constants are those of Spark's online optimizer with whole passes:
the same updates of topics and of the prior. Texts differ from it in three ways:
each is used exactly once a pass (Spark draws a pass with replacement), each
starts from equal topics, so what a text gives does not depend on how rows are
dealt, and each has settled when an update moves its parameters by 0.0001 on
average (Spark: 0.001).

A block is a row of the bags table: texts in ascending number of words, as arrays. A task updates the texts of the blocks of an Arrow batch together, those
of similar length at once, and drops the settled ones, and its sums are added up by ranges of slots. The driver holds topics x slots
numbers, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "lengths binary, slots binary, counts binary"
SUMS = "part int, sums binary"

# Words of a block's texts, about; a longer text is a block of its own.
BLOCK_SLOTS = 1 << 20
# Places (texts x the longest one's slots) that are updated together.
TOGETHER = 1 << 17
# One in so many, the last to settle, are updated with those of other groups.
LAST = 16
# Slots of one row of sums.
RANGE = 1 << 12
SETTLED = 1e-4
# A row is megabytes. Unless told, Parquet collects 100 before it looks at their size, in writing and in reading.
STORED = {"parquet.block.row.count.limit": 4, "parquet.page.row.count.limit": 1}
# Texts of at most this many words are updated in single precision, whose last digit is then far below SETTLED.
SINGLE = 1 << 9
TINY = np.float32(1e-30)
# Spark's: shape of the first topics, offset and decay of the steps.
SHAPE, OFFSET, DECAY = 100.0, 1024.0, 0.51


@dataclass(frozen=True)
class Topics:
    """``weights``: topics x slots, 0 where no text had the slot; ``prior``: one number a topic."""

    weights: np.ndarray
    prior: np.ndarray

    @property
    def seen(self) -> np.ndarray:
        return self.weights[0] > 0

    def top(self, n: int) -> list[list[int]]:
        """The ``n`` heaviest slots of each topic, best first."""
        slots = np.flatnonzero(self.seen)
        return [slots[np.argsort(-row[slots], kind="stable")[:n]].tolist() for row in self.weights]

    def table(self) -> np.ndarray:
        """exp(E[log weight]) of every slot, and a last one of 1 for places without a word."""
        slots = np.flatnonzero(self.seen)
        out = np.zeros((len(self.prior), self.weights.shape[1] + 1))
        out[:, slots] = exp_expected_log(self.weights[:, slots])
        out[:, -1] = 1
        return out


def digamma(x: np.ndarray) -> np.ndarray:
    """For x > 0: shifted up by 6, then the asymptotic series (error below 1e-10)."""
    # 1 / x + 1 / (x + 5) and the two pairs between them.
    t, y = x * (x + 5), x + 6
    below = (2 * x + 5) * (1 / t + 1 / (t + 4) + 1 / (t + 6))
    z = 1 / (y * y)
    return np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132)))) - below


def trigamma(x: np.ndarray) -> np.ndarray:
    below = sum(1 / (x + i) ** 2 for i in range(6))
    y = 1 / (x + 6)
    z = y * y
    return y + z / 2 + y * z * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z * (1 / 30 - z * (5 / 66 - z * (691 / 2730 - z * 7 / 6)))))) + below


def exp_expected_log(x: np.ndarray) -> np.ndarray:
    """exp(E[log p]) for p drawn from Dirichlet(row)."""
    return np.exp(digamma(x) - digamma(x.sum(-1, keepdims=True)))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, as ``digamma``."""
    t, y = x * (x + 5), x + 6
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(t * (t + 4) * (t + 6))


def _update(params: np.ndarray, beta: np.ndarray, counts: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, ...]:
    """The updated parameters, E[log share] up to a number per text (which cancels out), and each place's normalizer."""
    logs = digamma(params)
    theta = np.exp(logs)
    norm = np.matmul(theta[:, None].astype(beta.dtype), beta)[:, 0] + TINY
    return theta * np.matmul(beta, (counts / norm)[:, :, None])[:, :, 0] + prior, logs, norm


def _raised(old: np.ndarray, old_rest: list, new: np.ndarray, new_rest: list, counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """By how much the bound on a text's log likelihood is higher at ``new`` than at ``old``, which has the same sum."""
    (logs, norm), (new_logs, new_norm) = old_rest, new_rest
    words = np.einsum("tp,tp->t", counts, np.log(new_norm / norm))
    return words + ((prior - new) * new_logs - (prior - old) * logs + log_gamma(new) - log_gamma(old)) @ np.ones(len(prior))


def advance(beta: np.ndarray, counts: np.ndarray, prior: np.ndarray, start: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``settle`` from the parameters ``start`` until no more than ``few`` texts go on: parameters, and which texts have settled."""
    out, settled = start.copy(), np.zeros(len(counts), bool)
    at, params, moving = np.arange(len(counts)), start, ~settled
    # Sums of a few numbers a row are faster as products.
    ones = np.ones(len(prior))

    while moving.sum() > few:
        if 3 * moving.sum() < 2 * len(moving):
            at, params, beta, counts = at[moving], params[moving], beta[moving], counts[moving]
            moving = np.ones(len(at), bool)
        first, _, _ = _update(params, beta, counts, prior)
        second, *rest = _update(first, beta, counts, prior)
        moved = first - params
        bent = second - first - moved
        last = np.abs(second - first) @ ones / len(ones)
        growing = (last > np.abs(moved) @ ones / len(ones)) & (last > SETTLED / 2)
        done = moving & ~(last > SETTLED) & ~growing
        out[at[done]] = second[done]
        settled[at[done]] = True
        moving &= ~done
        if not moving.any():
            break
        far = np.maximum(1, np.sqrt(moved**2 @ ones / np.maximum(bent**2 @ ones, 1e-300)))[:, None]
        ahead = np.maximum(params + 2 * far * moved + far**2 * bent, prior)
        # Every update gives a text the same sum.
        ahead *= (second @ ones / (ahead @ ones))[:, None]
        beyond, *other = _update(ahead, beta, counts, prior)
        good = _raised(first, rest, ahead, other, counts, prior) >= 0
        params = np.where(good[:, None], beyond, second)
    out[at[moving]] = params[moving]
    return out, settled


def settle(beta: np.ndarray, counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Parameters (texts x topics) of texts, given beta (texts x topics x places) and counts (texts x places).

    A text has settled when an update moves its parameters by ``SETTLED`` or less on
    average, and by no more than the one before (it would leave a saddle), however many
    updates that takes. They are extrapolated from every two updates (squared
    extrapolation), where the bound does not fall by it; else updates go on from where
    they were.
    """
    return advance(beta, counts, prior, np.ones((len(counts), len(prior))), 0)[0]


def _arrays(batch: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    """Lengths, slots and counts of the texts of all its blocks."""
    none = np.zeros(0, np.int32)
    return [np.concatenate([none, *(np.frombuffer(v.as_buffer(), np.int32) for v in batch[name])]) for name in ("lengths", "slots", "counts")]


def _together(
    lengths: np.ndarray, slots: np.ndarray, counts: np.ndarray, empty: int, only: np.ndarray | None = None, apart: float = 1.5
) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts (of ``only``) of similar length, ``apart`` times the shortest: which, their slots (``empty`` where a text has no more) and counts."""
    starts = np.cumsum(lengths) - lengths
    long = np.add.reduceat(counts, starts) > SINGLE if len(lengths) else starts > 0
    for kind, of in ((~long, np.float32), (long, float)):
        order = np.flatnonzero(kind if only is None else kind & only)
        order = order[np.argsort(lengths[order], kind="stable")]
        sizes, low = lengths[order].astype(np.int64), 0
        while low < len(order):
            # Those before the first text that is longer by far, or with which they are too many.
            next_sizes = sizes[low : low + TOGETHER]
            fits = (next_sizes <= apart * sizes[low] + 16) & (next_sizes * np.arange(1, len(next_sizes) + 1) <= TOGETHER)
            high = low + max(1, len(fits) if fits.all() else int(fits.argmin()))
            some = order[low:high]
            places = np.arange(sizes[high - 1])
            filled = places < sizes[low:high, None]
            at = (starts[some, None] + places)[filled]
            ids, n = np.full(filled.shape, empty), np.zeros(filled.shape, of)
            ids[filled], n[filled] = slots[at], counts[at]
            yield some, ids, n
            low = high


def _beta(table: np.ndarray, ids: np.ndarray, like: np.ndarray) -> np.ndarray:
    out = np.empty((len(ids), len(table), ids.shape[1]), like.dtype)
    for topic, row in enumerate(table):
        out[:, topic] = row.take(ids)
    return out


def _settled(bags: list[np.ndarray], table: np.ndarray, prior: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups of settled texts: which, their slots, counts, beta and parameters.

    The last few of each group, which take most updates, meet those of the others and go on from where they were.
    """
    empty = table.shape[1] - 1
    left, params = np.zeros(len(bags[0]), bool), np.ones((len(bags[0]), len(prior)))
    for some, ids, counts in _together(*bags, empty):
        beta = _beta(table, ids, counts)
        params[some], done = advance(beta, counts, prior, params[some], len(some) // LAST)
        left[some] = ~done
        yield tuple(a if done.all() else a[done] for a in (some, ids, counts, beta, params[some]))
    for some, ids, counts in _together(*bags, empty, left, 4):
        beta = _beta(table, ids, counts)
        yield some, ids, counts, beta, advance(beta, counts, prior, params[some], 0)[0]


def bag(words: np.ndarray, slots: np.ndarray, n_slots: int) -> tuple[np.ndarray, ...]:
    """Which texts have a word, in ascending number of words, and their distinct slots: how many, which, how often."""
    by_words = np.argsort(words, kind="stable")
    rank = np.empty_like(by_words)
    rank[by_words] = np.arange(len(words))
    keys, counts = np.unique(np.repeat(rank * n_slots, words) + slots, return_counts=True)
    lengths = np.bincount(keys // n_slots, minlength=len(words))
    return by_words[lengths > 0], lengths[lengths > 0], keys % n_slots, counts


def blocks(slots: DataFrame, n_slots: int) -> DataFrame:
    """The bags table of ``slots`` (one column: the slots of a text, an array of int); texts without a word are left out."""

    def block(texts: list[pa.Array]) -> pa.RecordBatch:
        lists = pa.concat_arrays(texts)
        values = bag(lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(), n_slots)[1:]
        return pa.RecordBatch.from_arrays([pa.array([v.astype(np.int32).tobytes()], pa.binary()) for v in values], ["lengths", "slots", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        for batch in batches:
            column = batch.column(0)
            # A batch of Spark's is 16 MB at most, or one text.
            if sum(len(h.values) for h in held) + len(column.values) > BLOCK_SLOTS and held:
                yield block(held)
                held = []
            held.append(column)
        if held and sum(len(h.flatten()) for h in held):
            yield block(held)

    return slots.mapInArrow(run, BLOCK).where(F.length("lengths") > 0)


def stored(bags: DataFrame, path: str) -> DataFrame:
    """``bags`` written once, dealt to all cores alike; whatever their number, a task holds a few."""
    spark = bags.sparkSession
    bags.repartition(spark.sparkContext.defaultParallelism).write.options(**STORED).parquet(path)
    return spark.read.schema(BLOCK).parquet(path)


def _added(sums: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s.as_py(), np.float64) for s in sums["sums"])
    return pa.table([sums["part"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])


def _summed(bags: DataFrame, width: int, rows: int, task: Callable[[Iterator[pa.RecordBatch], np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums (rows x width) and a few more numbers that the tasks return, over all blocks.

    The sums of tasks meet by ranges of slots, so no task and no shuffled row
    grows with the number of tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((rows, width))
        more = task(batches, sums)
        if not more[0]:
            return
        parts = [more, *(sums[:, at : at + RANGE] for at in range(0, width, RANGE))]
        for number, part in enumerate(parts):
            row = [pa.array([number - 1], pa.int32()), pa.array([np.ascontiguousarray(part).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, ["part", "sums"])

    # topics x slots numbers in all, whatever the data.
    met = bags.mapInArrow(run, SUMS).groupBy("part").applyInArrow(_added, SUMS).collect()
    found = {r.part: np.frombuffer(r.sums, np.float64) for r in met}
    if not found:
        return np.zeros((rows, width)), np.zeros(1)
    return np.hstack([found[p].reshape(rows, -1) for p in range(len(found) - 1)]), found[-1]


def _totals(batches: Iterator[pa.RecordBatch], sums: np.ndarray) -> np.ndarray:
    """Adds how often each slot occurs; returns the number of texts."""
    texts = 0
    for batch in batches:
        for row in range(batch.num_rows):
            lengths, slots, counts = _arrays(batch.slice(row, 1))
            sums[0] += np.bincount(slots, counts, sums.shape[1])
            texts += len(lengths)
    return np.array([texts], float)


def _pass(sent, prior: np.ndarray) -> Callable[[Iterator[pa.RecordBatch], np.ndarray], np.ndarray]:
    """Settles every text; adds its words' shares by topic, and returns the number of texts and their summed E[log share]."""

    def task(batches: Iterator[pa.RecordBatch], sums: np.ndarray) -> np.ndarray:
        table, width = sent.value, sums.shape[1]
        more = np.zeros(1 + len(prior))
        for batch in batches:
            for _, ids, counts, beta, params in _settled(_arrays(batch), table, prior):
                theta = exp_expected_log(params)
                share = counts / (np.matmul(theta[:, None].astype(beta.dtype), beta)[:, 0] + TINY)
                slots, theta_of = ids.ravel(), theta.T[:, :, None]
                more += [len(ids), *np.log(theta).sum(0)]
                for topic in range(len(prior)):
                    sums[topic] += np.bincount(slots, (theta_of[topic] * share).ravel(), width + 1)[:width]
        return more

    return task


def _new_prior(prior: np.ndarray, expected: np.ndarray, texts: float, step: float) -> np.ndarray:
    """One Newton step for the prior of the topics, kept positive."""
    gradient = texts * (expected - (digamma(prior) - digamma(prior.sum())))
    c, q = texts * trigamma(prior.sum()), -texts * trigamma(prior)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    moved = prior - step * (gradient - b) / q
    return moved if (moved > 0).all() else prior


def fit(bags: DataFrame, n_slots: int, k: int, iterations: int, seed: int) -> Topics:
    """Topics of the texts in ``bags`` (a stored table of ``blocks``), every text in each of the passes."""
    context = bags.sparkSession.sparkContext
    counted, _ = _summed(bags, n_slots, 1, _totals)
    seen = counted[0] > 0
    weights, prior = np.zeros((k, n_slots)), np.full(k, 1 / k)
    weights[:, seen] = np.random.default_rng(seed).gamma(SHAPE, 1 / SHAPE, (k, int(seen.sum())))
    for number in range(1, iterations + 1 if seen.any() else 1):
        table = Topics(weights, prior).table()
        sent = context.broadcast(table)
        sums, (texts, *expected) = _summed(bags, n_slots, k, _pass(sent, prior))
        sent.destroy()
        step = (OFFSET + number) ** -DECAY
        weights[:, seen] = ((1 - step) * weights + step * (sums * table[:, :-1] + 1 / k))[:, seen]
        prior = _new_prior(prior, np.array(expected) / texts, texts, step)
    return Topics(weights, prior)


def best_topic(topics: Topics, slots: Column, context) -> Column:
    """Number of the most probable topic of a text, from its slots; the first on ties, so for texts of unseen slots."""
    n_slots = topics.weights.shape[1]
    sent = context.broadcast((topics.table(), topics.seen))
    prior = topics.prior

    @F.arrow_udf("int")
    def best(texts: pa.Array) -> pa.Array:
        table, seen = sent.value
        at = texts.flatten().to_numpy()
        text = np.repeat(np.arange(len(texts)), texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        known = seen[at]
        which, *mine = bag(np.bincount(text[known], minlength=len(texts)), at[known], n_slots)
        out = np.zeros(len(texts), np.int32)
        for some, _, _, _, params in _settled(mine, table, prior):
            out[which[some]] = params.argmax(1)
        return pa.array(out, pa.int32())

    return best(slots)
