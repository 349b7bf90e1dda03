"""Exact top-k inner product search with vectors bucketed by length.

Components become integers, floor(64 x). Vectors are grouped into ``BUCKETS``
buckets by length (quantiles over all vectors), buckets into parts of about
``PART`` vectors, queries into blocks of about ``QUERIES``. A first pass scores
every query block against parts of the longest vectors; the k-th score it finds
is a lower bound, theta. The second pass meets every part with every block:

- a vector p can matter for q only if cos(q, p) >= t = theta / (|q| * longest
  length of the part), the local threshold; with t > 1 the part is skipped;
- with t of ``COORDINATE`` or more, coordinates prune: in the coordinates where
  |q| is largest, p must lie in the range that cos >= t leaves;
- with a smaller t, lengths prune: p needs |p| >= theta / |q|.

Products of what is left are computed in full. Scores equal to theta stay, so
ties go to the smaller id exactly. Each part returns k rows a query at most.

Null vectors and those with a null or non-finite component take no part, nor
do null ids. A shorter vector counts as filled up with zeros. Repeated rows of
an id count once if equal; of different ones the least vector counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.shared import stored

K = 20
SCALE = 64
BUCKETS = 8
PART = 8192
QUERIES = 4096
COORDINATE = 0.8
FOCUS = 4


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (floor(64 x), long) and length, one row per id; unusable vectors left out."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("_v")).where("id IS NOT NULL AND _v IS NOT NULL")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform("_v", lambda x: F.floor(x.cast("double") * SCALE))
    rows = rows.where(finite).select("id", scaled.alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.withColumn("length", F.sqrt(squares))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, at = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(at), width), np.int64)
    out[np.arange(width)[None] < at[:, None]] = values
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    import pyarrow.compute as pc

    return max(pc.max(pc.list_value_length(c)).as_py() or 0 for c in columns)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows; sums beyond 64 bits are held at the end of the range."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _survivors(q, q_length, theta, p, p_length, unit, by_coordinate) -> np.ndarray | None:
    """Candidates of one part that can reach theta for one query; None: all."""
    if theta is None or theta <= 0 or q_length == 0:
        return None
    # Room for rounding: a candidate is dropped only where the bound is clearly missed.
    t = theta / (q_length * p_length[0]) * (1 - 1e-9) if p_length[0] else 2.0
    if t > 1:
        return np.zeros(0, np.int64)
    if t < COORDINATE:
        return np.arange(np.searchsorted(-p_length, -theta / q_length * (1 - 1e-9), side="right"))
    direction, found = q / q_length, None
    for f in np.argsort(-np.abs(direction))[:FOCUS]:
        x = direction[f]
        room = np.sqrt(max(0.0, (1 - x * x) * (1 - t * t)))
        low = -1.0 if -x >= t else x * t - room
        high = 1.0 if x >= t else x * t + room
        order, values = by_coordinate(f)
        ids = order[np.searchsorted(values, low - 1e-9) : np.searchsorted(values, high + 1e-9, side="right")]
        found = ids if found is None else np.intersect1d(found, ids, assume_unique=True)
        if not len(found):
            break
    return found


def _best(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(queries: pa.Table, part: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], pa.int64())] * 3, names=names)
        if not queries.num_rows or not part.num_rows:
            return empty
        part = part.sort_by([("length", "descending"), ("id", "ascending")])
        width = _width(queries["v"], part["v"])
        q, p = _matrix(queries["v"], width), _matrix(part["v"], width)
        q_id, p_id = queries["id"].to_numpy(), part["id"].to_numpy()
        q_length, p_length = queries["length"].to_numpy(), part["length"].to_numpy()
        theta = queries["theta"].to_pylist() if "theta" in queries.column_names else [None] * len(q)
        unit = p / np.maximum(p_length, 1e-300)[:, None]
        orders: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def by_coordinate(f):
            if f not in orders:
                order = np.argsort(unit[:, f], kind="stable")
                orders[f] = order, unit[order, f]
            return orders[f]

        out = ([], [], [])

        def keep(i: int, ids: np.ndarray, scores: np.ndarray) -> None:
            own = ids != q_id[i]
            if theta[i] is not None:
                own &= scores >= theta[i]
            ids, scores = ids[own], scores[own]
            if len(ids) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                ids, scores = ids[scores >= least], scores[scores >= least]
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
            for column, values in zip(out, (np.full(len(ids), q_id[i]), ids, scores)):
                column.append(values)

        unpruned = []
        for i in range(len(q)):
            chosen = _survivors(q[i], q_length[i], theta[i], p, p_length, unit, by_coordinate)
            if chosen is None or 2 * len(chosen) > len(p):
                unpruned.append(i)  # scored together below
            elif len(chosen):
                keep(i, p_id[chosen], products(q[i : i + 1], p[chosen])[0])
        for a in range(0, len(unpruned), 256):
            some = unpruned[a : a + 256]
            for i, scores in zip(some, products(q[some], p)):
                keep(i, p_id, scores)
        if not out[0]:
            return empty
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=names)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding",
          buckets: int = BUCKETS, part: int = PART, block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k best vectors of other ids."""
    points = stored(integers(vectors, key, vector), "points")
    asked = stored(integers(queries, key, vector), "queries")
    n, blocks = points.count(), max(1, -(-asked.count() // block))
    # At most BUCKETS + 1 numbers, whatever the data.
    edges = points.agg(F.percentile_approx("length", [b / buckets for b in range(1, buckets)], 1000)).first()[0] or []
    edges = sorted(set(edges))
    bucket = sum([F.when(F.col("length") >= e, 1).otherwise(0) for e in edges], F.lit(0)).cast("long")
    parts = max(1, -(-n // (part * (len(edges) + 1))))
    placed = points.withColumn("bucket", bucket).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)))
    numbers = lambda low, high: F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long")))

    def met(rows: DataFrame, seed: bool) -> DataFrame:
        """Every block of queries with every part, or with one part of the longest vectors."""
        spread = rows.withColumn("bucket", numbers(len(edges) if seed else 0, len(edges)))
        spread = spread.withColumn("part", numbers(0, 0 if seed else parts - 1))
        mine = placed.where((F.col("bucket") == len(edges)) & (F.col("part") == 0)) if seed else placed
        mine = mine.withColumn("block", numbers(0, blocks - 1))
        left, right = spread.groupBy("bucket", "part", "block"), mine.groupBy("bucket", "part", "block")
        return left.cogroup(right).applyInArrow(_best(k), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = met(asked, seed=True).withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    bounds = stored(first.select(F.col("query_id").alias("id"), F.col("score").alias("theta")), "bounds")
    bounded = asked.join(bounds, "id", "left")
    every = met(bounded, seed=False)
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
