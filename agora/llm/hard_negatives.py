"""Hard negatives by exact scores in residue arithmetic.

Components become integers, floor(scale x). A score is an integer inner
product. Blocks of anchors meet parts of all rows; each meeting is a product of
two matrices, made once for each of a few odd primes below 256 in float32:
residues lie in [-127, 127], and columns are taken ``COLUMNS`` at a time, so
every sum stays below 2**24 and is exact. As many primes are used as the
product of the longest lengths asks for. The Chinese remainder theorem, as
mixed-radix digits of symmetric residues, gives the signed scores back.

First each anchor finds its positives, the best rows of its own label. Then
every part is searched once more: of the rows of other labels those count whose
score lies in the window that a positive's score spans, and the best of each
window stay. Parts and blocks have a bounded number of bytes; a label of any
size is spread over all parts, and what a part returns is a few rows an anchor.

Null ids, labels and vectors, and vectors with a null or non-finite component,
take no part. A shorter vector counts as filled up with zeros, one without
components scores 0. Repeated rows of an id count once if equal; of different
ones the least label and vector count. Components and scores beyond 64 bits are
held at the ends of that range. Anchors without positives have no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.shared import grouped, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
# Bytes and rows of a packed matrix, at most; anchors scored at a time.
PACK_BYTES, PACK_ROWS = 1 << 21, 4096
AT_A_TIME = 256
PRIMES = [n for n in range(255, 2, -2) if all(n % d for d in range(3, 16, 2) if d < n)]
COLUMNS = 1000
LAST = 2**63 - 1


def _symmetric(x: np.ndarray, p: int) -> np.ndarray:
    """Whole float32 numbers below 2**24 reduced modulo p to [-(p-1)/2, (p-1)/2]."""
    x = x - np.float32(p) * np.rint(x * np.float32(1 / p))
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))  # the first quotient may be off by one


def residues(v: np.ndarray, p: int) -> np.ndarray:
    return _symmetric(np.remainder(v, p).astype(np.float32), p)


def _multiply(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Products of all rows of a and b modulo p, from one float32 product per ``COLUMNS`` columns."""
    total = np.zeros((len(a), len(b)), np.float32)
    for low in range(0, a.shape[1], COLUMNS):
        total = _symmetric(total + residues(a[:, low : low + COLUMNS], p) @ residues(b[:, low : low + COLUMNS], p).T, p)
    return total


def _longest(v: np.ndarray) -> float:
    return float(np.sqrt((v.astype(np.float64) ** 2).sum(1).max(initial=0)))


def primes_for(bound: float) -> list[int]:
    """The largest primes below 256 whose product tells all whole numbers from -bound to bound apart."""
    chosen, product = [], 1
    for p in PRIMES:
        chosen.append(p)
        product *= p
        if product > 2 * bound + 1:
            return chosen
    raise ValueError("vectors too long for the primes below 256")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b (int64), held at the ends of 64 bits."""
    bound = _longest(a) * _longest(b) * (1 + 1e-6) + 1
    primes = primes_for(bound)
    digits: list[np.ndarray] = []
    for p in primes:
        digit = _multiply(a, b, p)
        for q, earlier in zip(primes, digits):
            digit = _symmetric((digit - earlier) * np.float32(pow(q, -1, p)), p)
        digits.append(digit)
    small = math.prod(primes) < 2**62
    score = digits[-1].astype(np.int64) if small else digits[-1].astype(np.int64).astype(object)
    for p, digit in zip(reversed(primes[:-1]), reversed(digits[:-1])):
        score = score * p + digit.astype(np.int64)
    return score if small else np.clip(score, -LAST - 1, LAST).astype(np.int64)


def integers(rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, label, v (floor(scale x), long): one row per id; unusable rows left out."""
    found = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("_v"))
    found = found.where("id IS NOT NULL AND label IS NOT NULL AND _v IS NOT NULL")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform("_v", lambda x: F.floor(x.cast("double") * scale))
    found = found.where(finite).select("id", F.struct("label", scaled.alias("v")).alias("_row"))
    return found.groupBy("id").agg(F.min("_row").alias("_row")).select("id", "_row.label", "_row.v")


PACKED = "place long, ids binary, labels binary, width int, v binary, windows binary, most int"


def _pack(batches):
    """Rows of one place as matrices of bytes: ids, labels, vectors and, for anchors, the scores of their positives."""
    for rows in grouped(batches, ["place"]):
        width, v = _matrix(rows["v"])
        most, windows = _matrix(rows["scores"]) if "scores" in rows.column_names else (0, np.zeros(0, np.int64))
        n = [len(s) for s in rows["scores"].to_pylist()] if most else []
        for i, k in enumerate(n):
            windows[i, k:] = windows[i, 0]  # the same window again finds nothing new
        yield pa.record_batch(
            [pa.array([x], t) for x, t in (
                (rows["place"][0].as_py(), pa.int64()), (rows["id"].to_numpy().tobytes(), pa.binary()), (rows["label"].to_numpy().tobytes(), pa.binary()),
                (width, pa.int32()), (v.tobytes(), pa.binary()), (windows.tobytes(), pa.binary()), (most, pa.int32()))],
            names=["place", "ids", "labels", "width", "v", "windows", "most"],
        )


def _matrix(column: pa.ChunkedArray) -> tuple[int, np.ndarray]:
    lists = pa.concat_arrays(column.chunks)
    values, n = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    width = int(n.max(initial=0))
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width)[None] < n[:, None]] = values
    return width, out


def packed(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The stored matrices of ``rows`` (id, label, v, perhaps scores), at most about ``PACK_BYTES`` each, and their number."""
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    per = max(1, min(PACK_ROWS, PACK_BYTES // (8 * max(1, width or 0))))
    places = max(1, -(-n // per))
    dealt = rows.withColumn("place", F.pmod(F.xxhash64("id"), F.lit(places)))
    dealt = dealt.repartition(places, "place").sortWithinPartitions("place", "id")
    return stored(dealt.mapInArrow(_pack, PACKED), name), places


def first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the k best rows of each group are: highest score first, ties by smaller id."""
    order = np.lexsort((ids, ~score, group))  # ~score falls where score rises, and cannot overflow
    g = group[order]
    starts = np.searchsorted(g, g, side="left")
    return order[np.arange(len(g)) - starts < k]


def _read(side: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(side[prefix + c], np.int64) for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(side[prefix + "v"], np.int64).reshape(len(ids), side[prefix + "width"])


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _find_positives(k: int):
    def run(batches):
        for batch in batches:
            for met in batch.to_pylist():
                a_id, a_label, a = _read(met, "a_")
                p_id, p_label, p = _read(met, "")
                a, p = _same_width(a, p)
                out = []
                for label in np.unique(a_label):
                    cols = np.flatnonzero(p_label == label)
                    for rows in _portions(np.flatnonzero(a_label == label)):
                        score = products(a[rows], p[cols])
                        # k + 1, since the anchor itself may be among them.
                        floor = np.partition(score, len(cols) - k - 1, 1)[:, -k - 1, None] if len(cols) > k + 1 else -LAST - 1
                        r, c = np.nonzero((score >= floor) & (p_id[cols][None] != a_id[rows][:, None]))
                        best = first(r, score[r, c], p_id[cols][c], k)
                        out.append((a_id[rows][r[best]], p_id[cols][c[best]], score[r[best], c[best]]))
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names=["anchor_id", "positive_id", "positive_score"])

    return run


def _portions(rows: np.ndarray):
    return [rows[i : i + AT_A_TIME] for i in range(0, len(rows), AT_A_TIME)]


def _find_negatives(k: int, low: int, high: int):
    names = ["anchor_id", "positive_score", "negative_id", "negative_score"]

    def run(batches):
        for batch in batches:
            for met in batch.to_pylist():
                a_id, a_label, a = _read(met, "a_")
                p_id, p_label, p = _read(met, "")
                a, p = _same_width(a, p)
                spans = np.frombuffer(met["a_windows"], np.int64).reshape(len(a_id), met["a_most"])
                # Whole numbers of any size: least and greatest score of each window, held inside 64 bits.
                least = np.array([[max(-(-low * s // 100), -LAST - 1) for s in row] for row in spans.tolist()], object)
                most = np.array([[high * s // 100 for s in row] for row in spans.tolist()], object)
                least, most = (np.clip(m, -LAST - 1, LAST).astype(np.int64) for m in (least, most))
                out = []
                for rows in _portions(np.arange(len(a_id))):
                    score = products(a[rows], p)
                    inside = (score >= least[rows].min(1)[:, None]) & (score <= most[rows].max(1)[:, None])
                    r, c = np.nonzero(inside & (a_label[rows][:, None] != p_label[None]))
                    found = score[r, c]
                    for j in range(spans.shape[1]):
                        if j and (spans[rows, j] == spans[rows, 0]).all():
                            continue
                        ok = np.flatnonzero((found >= least[rows[r], j]) & (found <= most[rows[r], j]))
                        best = ok[first(r[ok], found[ok], p_id[c[ok]], k)]
                        out.append((a_id[rows[r[best]]], spans[rows[r[best]], j], p_id[c[best]], found[best]))
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

    return run


def _met(parts: DataFrame, places: int, blocks: DataFrame) -> DataFrame:
    """Every block of anchors with every part, the parts spread over tasks."""
    blocks = blocks.select(*[F.col(c).alias("a_" + c) for c in blocks.columns])
    spread = blocks.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(places - 1).cast("long"))))
    return parts.repartition(places, "place").join(spread.repartition(places, "place"), "place")


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on ``id``. Per anchor and positive the first ``negatives`` rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    points = stored(integers(rows, key, label, vector, scale), "points")
    parts, places = packed(points, "parts")
    anchors = points.where(anchor)
    blocks, _ = packed(anchors, "anchors")
    found = _met(parts, places, blocks).mapInArrow(_find_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= positives).drop("_rank")
    found = stored(found, "positives")

    windows = found.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("scores"))
    asked, _ = packed(stored(anchors.join(windows, "id"), "asked"), "asked-blocks")
    schema = "anchor_id long, positive_score long, negative_id long, negative_score long"
    hard = _met(parts, places, asked).mapInArrow(_find_negatives(negatives, low, high), schema)
    # Anchors with fewer windows than others had one repeated; its rows are the same.
    hard = hard.distinct()
    best = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    out = found.join(hard, ["anchor_id", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
