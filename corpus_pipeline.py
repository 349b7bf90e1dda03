"""A training corpus from ``documents``: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns a DataFrame that is written and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import language, near_dup, packing, quality, token_ids
from agora.llm.shared import few, prepare, stored, table
from agora.llm.vocabularies import default_path

END_ID = 2
# Words a packing worker remembers: it ran the stages before, whose memory it keeps.
REMEMBERED = 150_000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier predicts as 1; it learns from this stage's rows and the labels."""
    prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(spark, model, F.col("text")) >= 0.5)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents op8 names a language for, however they mix languages; texts without letters (null and empty ones too) go."""
    prepare(spark)
    found = language.identify(spark, language.fit(docs), F.col("text"))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), found.alias("found"))
    return rows.where(F.col("found.lang_pred") != language.UNKNOWN).select("doc.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id (null ids last).

    Rows that share an id, or have none, are compared by their texts like any
    others; texts without words go only where an id repeats the same one.
    """
    prepare(spark)
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if not counts.where("n > 1 OR doc_id IS NULL").isEmpty():
        return _by_rows(docs)
    gone = near_dup.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    return docs.join(few(gone, "gone"), docs["doc_id"] == F.col("_gone"), "left_anti")


def _by_rows(docs: DataFrame) -> DataFrame:
    """The same where ids do not tell rows apart: rows get numbers, which are stored so that they do not change."""
    # The documents stay whole in one struct, so that no name of theirs meets one of ours; maps have no hash, but a text.
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), whole), "numbered")
    rows = rows.select("_row", "doc", "doc.doc_id", "doc.text")
    found = near_dup.near_duplicates(rows, key="_row").select(F.col("doc_id").alias("_row"), "n_shingles", "component_id")
    order = F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", F.sha2("text", 256).alias("text"), F.xxhash64(F.to_json("doc")).alias("rest"), "_row"
    )
    linked = (F.col("n_shingles") > 0) | F.col("doc_id").isNull()
    met = found.join(rows.select("_row", "doc_id", order.alias("order")), "_row")
    groups = met.groupBy(
        F.when(linked, F.col("component_id")).alias("component"), F.when(~linked, F.col("doc_id")).alias("id"),
        F.when(~linked, F.col("order.text")).alias("text"),
    )
    first = groups.agg(F.min("order").alias("order")).select("order._row")
    gone = few(found.select("_row").join(first, "_row", "left_anti"), "gone")
    return rows.join(gone, "_row", "left_anti").select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    prepare(spark)
    ids = token_ids.token_ids(F.col("text"), default_path("byte_bpe_50k.json"), END_ID, REMEMBERED)
    return packing.pack_ids(docs, ids)


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("MinHash near-dedup", without_near_duplicates),
    ("best-fit packing", packed),
]

# No stage can be expressed in SQL; tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
