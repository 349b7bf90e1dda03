"""A manifest of a table as a tree of SHA-256 digests; changed rows are folded by resumed hash states.

Each row is a leaf. Leaves of one source, in ascending order of their key, are
hashed ``ARITY`` at a time, level by level, to the source's subroot; subroots
in the order of their sources give the root the same way.

A parent keeps a copy of its hash state before each child slot. To fold a
replaced child, the copy before its slot is resumed with the replacement and
the siblings to the right only; what stands left of it is not hashed again.
Hash states cannot be stored, so the manifest stores digests, and the task that
folds a parent's children makes its states once and resumes copies of them.

Nothing is whole in one task: leaves are numbered by a range partitioned sort
and offsets of its parts, and hashed in chunks of ``ARITY ** LEVELS`` leaves,
whatever the size of a source. Chunk digests are the next height's nodes. On
the way down each node gets its path to the root, a few kilobytes, and leaves
meet the path of their chunk.

Nulls count as ``-`` in a leaf; a null source is a source of its own, before
all others. Rows with a null key come first, rows with equal keys stand in the
order of their digests, and equal rows each have a place. One row is its own
subroot, one source's subroot is the root, and an empty table gives no rows.
A proof without siblings is the digest of no bytes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.shared import ascii_lower, few, grouped, stored

ARITY = 16
LEVELS = 3
# Rows of a part of the sort, on average.
PART_ROWS = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Parent:
    """A node with the hash state before each child slot. Digests are lowercase hex text, as bytes."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]):
        state = hashlib.sha256()
        self.children, self.states = children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """The node's digest with another child in ``slot``."""
        state = self.states[slot].copy()
        state.update(replacement)
        state.update(b"".join(self.children[slot + 1 :]))
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot] + self.children[slot + 1 :])


def levels_of(n: int, most: int) -> int:
    """Levels that a chunk of a tree with n nodes at this height is hashed up: until one node is left, ``most`` at most."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def rise(digests: list[bytes], levels: int) -> list[list[Parent]]:
    """The parents over ``digests``, level by level."""
    tree = []
    for _ in range(levels):
        tree.append([Parent(digests[i : i + ARITY]) for i in range(0, len(digests), ARITY)])
        digests = [p.digest for p in tree[-1]]
    return tree


def steps_of(tree: list[list[Parent]], i: int) -> list[tuple[Parent, int]]:
    """Parent and slot of leaf i and of the nodes above it in its chunk."""
    out = []
    for row in tree:
        out.append((row[i // ARITY], i % ARITY))
        i //= ARITY
    return out


def leaf(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields: ``-`` for null, else byte count, colon, value."""
    texts = [f.cast("string") for f in fields]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def leaves(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS,
           changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Per row: key, grp, leaf, and replacement: the leaf with ``changed`` columns where ``where`` holds, else null (stored)."""
    changed = changed or {}
    original = leaf([docs[f] for f in fields])
    other = leaf([changed.get(f, docs[f]) for f in fields])
    replacement = F.when(where, other) if where is not None else F.lit(None).cast("string")
    rows = docs.select(docs[key].alias("key"), docs[group].cast("string").alias("grp"), original.alias("leaf"), replacement.alias("replacement"))
    return stored(rows, "leaves")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add pos, the place of a row among those of its group, and n, their number. Nulls first; a null group is one group."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    # Rows alike in everything may stand in any order; a number spreads them over parts.
    rows = rows.withColumn("_copy", F.monotonically_increasing_id())
    columns = [group, *order, "_copy"]
    ranged = rows.repartitionByRange(parts, *columns).sortWithinPartitions(*columns).drop("_copy")
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged").withColumn("_part", F.shiftright("_at", 33))
    runs = ranged.groupBy("_part", F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    # One narrow row for each part and group in it.
    before = Window.partitionBy("_group").orderBy("_part")
    runs = runs.select(
        F.col("_part").alias("_of"), "_group", "_first",
        F.coalesce(F.sum("_size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy("_group")).alias("n"),
    )
    met = ranged.join(few(runs, "runs"), (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return met.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_of", "_group", "_first", "_before")


NODES = "tree long, pos long, n long, digest string"


def _chunk(levels: int) -> Column:
    return F.floor(F.col("pos") / ARITY**levels)


def _tops(levels: int):
    def run(batches):
        out = []
        for rows in grouped(batches, ["tree", "chunk"]):
            n, digests = rows["n"][0].as_py(), [d.encode() for d in rows["digest"].to_pylist()]
            tree = rise(digests, levels_of(n, levels))
            top = tree[-1][0].digest if tree else digests[0]
            out.append((rows["tree"][0].as_py(), rows["chunk"][0].as_py(), -(-n // ARITY**levels), top.decode()))
            if len(out) >= 1024:
                yield _rows(out, NODES_ARROW)
                out = []
        if out:
            yield _rows(out, NODES_ARROW)

    return run


NODES_ARROW = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
STEP_ARROW = pa.struct([("slot", pa.int32()), ("run", pa.string())])
PATHS = "tree long, pos long, path array<struct<slot:int,run:string>>"
PATHS_ARROW = pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("path", pa.list_(STEP_ARROW))])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def heights(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of every height that is the top of chunks, leaves first; trees of one node stay as they are."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = out[-1].select("tree", "pos", "n", "digest").withColumn("chunk", _chunk(levels))
        rows = rows.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")
        out.append(stored(rows.mapInArrow(_tops(levels), NODES), "nodes"))
    return out


def _with_paths(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Nodes and, ahead of each chunk's nodes, the path of the chunk; ``paths`` may have more columns than tree, pos, path."""
    above = paths.withColumnRenamed("pos", "chunk").withColumns({"kind": F.lit(0), "pos": F.lit(None).cast("long")})
    below = nodes.withColumns({"chunk": _chunk(levels), "kind": F.lit(1)})
    rows = above.unionByName(below, allowMissingColumns=True)
    return rows.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "kind", "pos")


def _descend(levels: int):
    def run(batches):
        for rows in grouped(batches, ["tree", "chunk"]):
            path = [(s["slot"], s["run"]) for s in rows["path"][0].as_py()]
            number, nodes = rows["tree"][0].as_py(), rows.slice(1)
            places, digests = nodes["pos"].to_pylist(), [d.encode() for d in nodes["digest"].to_pylist()]
            tree = rise(digests, levels_of(nodes["n"][0].as_py(), levels))
            for first in range(0, len(places), 256):
                some = []
                for i in range(first, min(first + 256, len(places))):
                    own = [(slot, b"".join(p.children).decode()) for p, slot in steps_of(tree, i)]
                    some.append((number, places[i], [{"slot": s, "run": r} for s, r in own + path]))
                yield _rows(some, PATHS_ARROW)

    return run


def paths(nodes: list[DataFrame], top: DataFrame, down_to: int, levels: int) -> DataFrame:
    """tree, pos and path to the root of every node of height ``down_to``; ``top``: the same of each tree's only node."""
    found = top
    for height in reversed(nodes[down_to:-1]):
        rows = _with_paths(height.select("tree", "pos", "n", "digest"), found, levels)
        found = stored(rows.mapInArrow(_descend(levels), PATHS), "paths")
    return found


@dataclass
class Manifest:
    """``rows``: leaves with tree, pos and n. ``sources``: tree, grp, n, subroot. ``root``: one row, none of an empty table.

    ``chunks``: tree, pos, path, subroot, root for each chunk of ``ARITY ** levels`` leaves.
    """

    rows: DataFrame
    sources: DataFrame
    root: DataFrame
    chunks: DataFrame
    levels: int


def build(rows: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of ``leaves``."""
    placed = numbered(rows, "grp", ["key", "leaf"])
    sources = stored(placed.groupBy("grp").agg(F.max("n").alias("n")), "sources")
    ordered = numbered(sources.withColumns({"_all": F.lit(0), "n_leaves": F.col("n")}).drop("n"), "_all", ["grp"])
    sources = stored(ordered.select(F.col("pos").alias("tree"), "grp", F.col("n_leaves").alias("n")), "numbered-sources")
    named = few(sources.select("tree", F.col("grp").alias("_grp")), "trees")
    placed = placed.join(named, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")

    below = heights(placed.withColumn("digest", F.col("leaf")), levels)
    subroots = below[-1].select("tree", F.col("digest").alias("subroot"))
    count = F.lit(sources.count()).cast("long")
    above = heights(below[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), count.alias("n"), "digest"), levels)
    root = above[-1].select(F.col("digest").alias("root"))

    none = F.array().cast("array<struct<slot:int,run:string>>")
    of_sources = paths(above, above[-1].select("tree", "pos", none.alias("path")), 0, levels)
    to_root = of_sources.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path")
    # Leaves get no paths of their own; where every source has one leaf, its path is that of its source.
    found = paths(below, to_root, 1, levels)
    chunks = found.join(subroots, "tree").withColumn("root", root.scalar())
    return Manifest(placed, sources.join(subroots, "tree"), root, chunks, levels)


FOLDED = "key {}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _fold(key_type: pa.DataType, levels: int):
    schema = pa.schema([("key", key_type), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                        ("verified", pa.bool_())])

    def run(batches):
        for rows in grouped(batches, ["tree", "chunk"]):
            subroot, root = rows["subroot"][0].as_py(), rows["root"][0].as_py()
            slots, parents = [], []
            for step in rows["path"][0].as_py():
                text = step["run"].encode()
                parents.append(Parent([text[i : i + 64] for i in range(0, len(text), 64)]))
                slots.append(step["slot"])
            above = list(zip(parents, slots))
            shared = b"".join(p.siblings(slot) for p, slot in above)
            nodes = rows.slice(1)
            digests = [d.encode() for d in nodes["leaf"].to_pylist()]
            tree = rise(digests, levels_of(nodes["n"][0].as_py(), levels))
            proofs, folded = [], []
            for i, other in enumerate(nodes["replacement"].to_pylist()):
                own = steps_of(tree, i)
                proofs.append(hashlib.sha256(b"".join([*(p.siblings(slot) for p, slot in own), shared])).hexdigest())
                digest = digests[i] if other is None else other.encode()
                for parent, slot in [*own, *above]:
                    digest = parent.fold(slot, digest)
                folded.append(digest.decode())
            n = nodes.num_rows
            columns = [nodes["key"].combine_chunks(), nodes["leaf"].combine_chunks(), [subroot] * n, [root] * n, proofs, folded, [f == root for f in folded]]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def prove(manifest: Manifest) -> DataFrame:
    """Per leaf: key, leaf, subroot, root, proof_sha256, folded_root (of its replacement, if any) and verified."""
    rows = manifest.rows.select("tree", "pos", "n", "key", "leaf", "replacement")
    kind = rows.schema["key"].dataType
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    met = _with_paths(rows, manifest.chunks, manifest.levels)
    return met.mapInArrow(_fold(arrow, manifest.levels), FOLDED.format(kind.simpleString()))


def tampered_manifest(docs: DataFrame, key: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """``prove`` for ``documents`` where each row whose key's crc32 is divisible by 5 has its text's A-Z lower-cased."""
    where = F.crc32(docs[key].cast("string").cast("binary")) % 5 == 0
    rows = leaves(docs, key=key, changed={"text": ascii_lower(docs["text"])}, where=where)
    return prove(build(rows, levels)).withColumnRenamed("key", key)
