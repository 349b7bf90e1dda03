"""Near-duplicates: universal hash minima, banding, signature verification, components by alternating stars.

A text's set holds its distinct five-word shingles (ASCII letters lower-cased),
as 64-bit hashes. ``HASHES`` universal hash functions give it as many minima:
``BANDS`` bands of ``ROWS`` minima are its buckets, one bit of each minimum its
signature. Sets that share a bucket and whose signatures agree are compared in
full: they are linked if 100 * intersection >= 75 * union.

No bucket's pairs are all listed. Texts of the same words in the same order (by
SHA-256) are first reduced to one. Then:

1. every member of a bucket meets the bucket's least id: one pair per member;
2. links found give components. Buckets with the same least id form a group; a
   group whose members are all in one component has no more to tell. That ends
   most groups of near copies, whatever their size;
3. the other groups meet in blocks of ``BLOCK`` ids, so large groups are spread
   over tasks: first with signatures only, a bit and then a byte of each minimum. Only members
   that agree with one of another component get their full sets and meet
   again; they are compared in full, all intersections of a block in
   one matrix product, and a task returns each member with the least id its
   links lead to: one row per member.

So components are those of all linked pairs that share a bucket. A pair at
similarity 0.75 misses all buckets with a chance of 5 in a million (0.8: 5 in
100 million) and its signature falls below ``AGREE`` with one in 10 million, its
bytes below ``AGREE_BYTES`` with one in 300 million.

Texts without words are linked with nothing. A null id is linked with nothing
and stays. Rows with the same id are one node that has all their texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from agora.llm import words
from agora.llm.components import components
from agora.llm.shared import few, grouped, portions, stored, utf8

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
AGREE = 92
# Bytes of the minima that agree, at least, before two texts of an open group are compared in full.
AGREE_BYTES = 66
BLOCK = 1024
U = np.uint64

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 1 << 63, HASHES, np.uint64) * U(2) + U(1)
_TERMS = _random.integers(0, 1 << 63, HASHES, np.uint64) * U(2)


def shingles(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, repeats included, and where each text's begin (length + 1 numbers)."""
    starts, stops = words.spans(~words.SPACE[raw], ends)
    h = words.block_hashes(words.LOWER[raw], starts, stops)
    first = words.counts_by_text(starts, ends)
    n = np.diff(first)
    grams = words.ngrams(h, SHINGLE)
    size = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(n)), size)
    place = first[owner] + np.arange(at[-1]) - at[owner]
    out = np.zeros(at[-1], np.uint64)
    whole = n[owner] >= SHINGLE
    out[whole] = grams[place[whole]]
    for k in np.flatnonzero((n > 0) & (n < SHINGLE)):
        out[at[k]] = words.ngrams(h[first[k] : first[k + 1]], int(n[k]))[0]
    return out, at


def minima(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, HASHES) least values of each universal hash function over each text's shingles; no text may be empty."""
    out = np.empty((HASHES, len(at) - 1), np.uint64)
    for k in range(HASHES):
        values = hashes * _FACTORS[k]
        values += _TERMS[k]
        out[k] = np.minimum.reduceat(values, at[:-1]) >> U(32)
    return out.T


SIGNED = "doc long, n_shingles long, digest binary, bands array<long>, bits_a long, bits_b long, low binary"


def _sign(batches):
    weights = U(1) << np.arange(64, dtype=np.uint64)
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        for a, b in portions(ends, words.PORTION):
            h, at = shingles(raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
            n = np.array([len(np.unique(h[at[k] : at[k + 1]])) for k in range(b - a)], np.int64)
            digests = [hashlib.sha256(t).digest() for t in words.normal_texts(raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a])]
            full = np.flatnonzero(n)
            bands, bits = np.zeros((b - a, BANDS), np.uint64), np.zeros((b - a, 2), np.uint64)
            low = np.zeros((b - a, HASHES), np.uint8)
            if len(full):
                least = minima(h, np.concatenate([at[full], at[-1:]]))
                key = np.arange(BANDS, dtype=np.uint64)[None] + U(1)
                for r in range(ROWS):
                    key = words.mix(key * U(0x9E3779B97F4A7C15) + least[:, r::ROWS])
                bands[full] = key
                bit = words.mix(least) & U(1)
                low[full] = words.mix(least) >> U(56)
                bits[full] = np.stack([(bit[:, :64] * weights).sum(1, dtype=np.uint64), (bit[:, 64:] * weights).sum(1, dtype=np.uint64)], 1)
            flat = pa.array(bands.reshape(-1).view(np.int64))
            places = pa.array(np.arange(0, (b - a) * BANDS + 1, BANDS, dtype=np.int32))
            yield pa.record_batch([
                batch.column("doc").slice(a, b - a), pa.array(n), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(places, flat), pa.array(bits[:, 0].copy().view(np.int64)), pa.array(bits[:, 1].copy().view(np.int64)),
                pa.array([row.tobytes() for row in low], pa.binary()),
            ], names=["doc", "n_shingles", "digest", "bands", "bits_a", "bits_b", "low"])


def _sets(batches):
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        for a, b in portions(ends, words.PORTION):
            h, at = shingles(raw[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
            out = [np.unique(h[at[k] : at[k + 1]]).tobytes() for k in range(b - a)]
            yield pa.record_batch([batch.column("doc").slice(a, b - a), pa.array(out, pa.binary())], names=["doc", "members"])


@F.arrow_udf(BooleanType())
def _linked(left: pa.Array, right: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(left, right, strict=True):
        a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        out.append(100 * both >= PERCENT * (len(a) + len(b) - both))
    return pa.array(out, pa.bool_())


def members_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """doc and its full set, for the ids of ``ids`` (doc), stored. ``texts``: doc, text."""
    asked = texts.join(few(ids.distinct(), "asked"), "doc", "left_semi")
    return stored(asked.mapInArrow(_sets, "doc long, members binary"), "sets")


def confirm(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are linked, stored."""
    pairs = stored(pairs.distinct(), "pairs")
    sets = members_of(texts, pairs.select(F.col("a").alias("doc")).union(pairs.select(F.col("b").alias("doc"))))
    met = pairs.join(sets.select(F.col("doc").alias("a"), F.col("members").alias("left")), "a")
    met = met.join(sets.select(F.col("doc").alias("b"), F.col("members").alias("right")), "b")
    return stored(met.where(_linked("left", "right")).select("a", "b"), "links")


_NAMES = ["least", "lo", "hi", "doc", "component", "bits_a", "bits_b"]


def _pairs(g: np.ndarray) -> np.ndarray:
    """Which members of a block (rows of ``_NAMES``) have signatures that agree and are of different components, as a matrix."""
    bits = np.ascontiguousarray(g[:, 5:]).view(np.uint64)
    apart = np.zeros((len(g), len(g)), np.uint8)
    for half in bits.T:
        apart += np.bitwise_count(half[:, None] ^ half[None])
    return (apart <= HASHES - AGREE) & (g[:, None, 4] != g[None, :, 4])


def _agreeing(batches):
    """The rows of each (group, block, block) that are worth comparing in full: signatures agree, and then bytes of the minima."""
    for rows in grouped(batches, ["least", "lo", "hi"]):
        g = np.stack([rows[c].to_numpy().astype(np.int64) for c in _NAMES], 1)
        a, b = np.nonzero(np.triu(_pairs(g)))
        low = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(len(g), HASHES)
        some = np.zeros(len(g), bool)
        for k in range(0, len(a), 1 << 16):
            x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            alike = (low[x] == low[y]).sum(1) >= AGREE_BYTES
            some[x[alike]] = some[y[alike]] = True
        if some.any():
            yield from rows.drop_columns("low").filter(pa.array(some)).combine_chunks().to_batches()


def _meet(batches):
    """Connected members of each (group, block, block): rows of one key follow one another."""
    rows, sets = np.zeros((0, len(_NAMES)), np.int64), []
    for batch in batches:
        more = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _NAMES], 1)
        rows = np.concatenate([rows, more])
        sets += [np.frombuffer(m.as_py(), np.uint64) for m in batch.column("members")]
        at = [0, *(np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1)) + 1)]
        yield from _connected(rows, sets, at)
        rows, sets = rows[at[-1] :], sets[at[-1] :]
    yield from _connected(rows, sets, [0, len(rows)])


def _connected(rows: np.ndarray, sets: list[np.ndarray], at: list[int]):
    a, b = [], []
    for first, last in zip(at[:-1], at[1:]):
        g, members = rows[first:last], sets[first:last]
        some = np.flatnonzero(_pairs(g).any(1))
        if not len(some):
            continue
        both, size = intersections([members[k] for k in some]), np.array([len(members[k]) for k in some])
        linked = 100 * both >= PERCENT * (size[:, None] + size[None] - both)
        doc, label = g[some, 3], g[some, 3]
        while True:
            least = np.where(linked, label[None], label[:, None]).min(1)
            if (least == label).all():
                break
            label = least
        a.append(label[label != doc])
        b.append(doc[label != doc])
    if sum(map(len, a)):
        yield pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets (of distinct numbers), as products of 0/1 matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    owner, column = owner[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out, width = np.zeros((len(sets), len(sets)), np.int64), 4096
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        matrix = np.zeros((len(sets), width), np.float32)  # counts stay far below 2**24
        matrix[owner[a:b], column[a:b] - low] = 1
        out += (matrix @ matrix.T).astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def sign(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc, n_shingles, a digest of its words, the buckets and the signature of its set (stored)."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(_sign, SIGNED), "signed")


def links(texts: DataFrame, signed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) joined by confirmed links, enough for all components; of equal texts only the least id takes part."""
    usable = signed.where(F.col("n_shingles") > 0).where(F.col("doc").isNotNull())
    one = usable.groupBy("digest").agg(F.min("doc").alias("doc"))
    single = usable.select("doc", "bands").join(one.select("doc").distinct(), "doc", "left_semi")
    signatures = usable.select("doc", "bits_a", "bits_b", "low")
    in_buckets = single.select("doc", F.explode("bands").alias("bucket"))
    buckets = in_buckets.groupBy("bucket").agg(F.min("doc").alias("least"), F.max("doc").alias("_most")).where("least < _most")
    met = in_buckets.join(buckets.select("bucket", "least"), "bucket").where("doc != least")
    pairs = stored(met.select("least", "doc").distinct(), "groups")

    named = lambda side: signatures.select(F.col("doc").alias(side), F.struct("bits_a", "bits_b").alias(f"_{side}"))
    apart = sum(F.bit_count(F.col(f"_a.{bits}").bitwiseXOR(F.col(f"_b.{bits}"))) for bits in ("bits_a", "bits_b"))
    asked = pairs.select(F.col("least").alias("a"), F.col("doc").alias("b")).join(named("a"), "a").join(named("b"), "b")
    starry = confirm(texts, asked.where(HASHES - apart >= AGREE).select("a", "b"))

    # The least id has met every member already; its component still counts.
    found = components(starry).withColumnRenamed("node", "doc")
    placed = pairs.join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    groups = placed.groupBy("least").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("_low"), F.max("component").alias("_high")
    )
    groups = groups.where("_low < _high").select("least", F.ceil(F.col("size") / block).cast("long").alias("blocks"))
    rows = stored(placed.join(groups, "least").join(signatures, "doc"), "open-groups")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("block", "_other")).withColumn("hi", F.greatest("block", "_other"))
    rows = rows.select(*_NAMES, "low").repartition("least", "lo", "hi").sortWithinPartitions("least", "lo", "hi")
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes if name != "low")
    rows = stored(rows.mapInArrow(_agreeing, schema), "agreeing")
    rows = rows.join(members_of(texts, rows.select("doc")), "doc").select(*_NAMES, "members")
    rows = rows.repartition("least", "lo", "hi").sortWithinPartitions("least", "lo", "hi")
    return starry.union(stored(rows.mapInArrow(_meet, "a long, b long"), "connected"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable), kept (it is its own component's least id)."""
    signed = sign(docs, key, text)
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    usable = signed.where(F.col("n_shingles") > 0).where(F.col("doc").isNotNull())
    equal = usable.groupBy("digest").agg(F.min("doc").alias("a"), F.max("doc").alias("_most")).where("a < _most")
    copies = usable.join(equal.select("digest", "a"), "digest").where("doc != a").select("a", F.col("doc").alias("b"))
    found = components(copies.union(links(texts, signed)))
    out = signed.join(found.select(F.col("node").alias("doc"), "component"), "doc", "left")
    component = F.coalesce("component", "doc")
    return out.select(
        F.col("doc").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"),
    )
