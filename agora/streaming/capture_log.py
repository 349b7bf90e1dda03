"""Captures of posts as an append-only log: the last one of each post is found when the table is read.

A batch becomes one segment: new files in the buckets its posts fall in, and
nothing is read or rewritten, whatever a quarter holds. Buckets that many
segments have written to are compacted: their last captures go to a new version,
and a manifest row makes that version, and the segments after it, the bucket's
content. Rows of a segment count once the segment is noted, and a version once
its manifest row is there, so a run that dies leaves the former state.
One writer at a time, as for all tables of the warehouse.

Folders below the root: ``log/_segment=/part=/bucket=``, ``segments``,
``base/_version=/part=/bucket=``, ``manifest``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from agora import schemas
from agora.operators.raw import dedup_keep_last
from agora.session import work_dir
from agora.sources import tables
from agora.sources.layout import PLACE, Layout, layout_of


@dataclass
class CaptureLog:
    """``arrival`` orders the captures of a key; the last one counts. ``layout`` holds for a new log; an old one keeps its own."""

    spark: SparkSession
    root: str
    schema: StructType
    arrival: Sequence[str]
    layout: Layout

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.layout = layout_of(self.spark, self.root, self.layout)

    def _table(self, name: str, *partitions: StructField) -> DataFrame:
        fields = [*self.schema.fields, *partitions]
        return tables.read_table(self.spark, f"{self.root}/{name}", StructType(fields), by=None)

    def segments(self) -> DataFrame:
        return tables.read_table(self.spark, f"{self.root}/segments", schemas.SEGMENT, by=None)

    def manifest(self) -> DataFrame:
        """part, bucket, version and upto of every compacted place."""
        rows = tables.read_table(self.spark, f"{self.root}/manifest", schemas.COMPACTED, by=None)
        last = F.max_by(F.struct("version", "upto"), "upto")
        return rows.groupBy(*PLACE).agg(last.alias("_m")).select(*PLACE, "_m.*")

    def live(self) -> DataFrame:
        """_segment, part, bucket of what has been written since the place was compacted."""
        met = self.segments().join(self.manifest(), PLACE, "left")
        return met.where(F.col("_segment") > F.coalesce("upto", F.lit(-1))).select("_segment", *PLACE).distinct()

    def append(self, batch: DataFrame) -> int:
        """Write a batch as a new segment and return its number. A batch written twice changes nothing that is read."""
        last = self.segments().agg(F.max("_segment")).first()[0]
        segment = 0 if last is None else last + 1
        path = f"{self.root}/log/_segment={segment}"
        # Captures of one post inside the batch are reduced first; what a dead run left under this number goes.
        rows = self.layout.place(dedup_keep_last(batch, self.layout.keys, self.arrival))
        rows.hint("rebalance", *PLACE).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*PLACE).parquet(path)
        written = tables.read_table(self.spark, path, StructType([*self.schema.fields, *_PLACES]), by=None)
        noted = written.select(*PLACE).distinct().select(F.lit(segment).cast("long").alias("_segment"), *PLACE, F.current_timestamp().alias("written_at"))
        noted.coalesce(1).write.mode("append").parquet(f"{self.root}/segments")
        return segment

    def _captures(self, places: DataFrame | None = None) -> DataFrame:
        """Rows of the current versions and of the segments after them, of some places or all; no other folder is read."""
        live, base = self.live(), self.manifest().select(F.col("version").alias("_version"), *PLACE)
        if places is not None:
            live, base = live.join(places, PLACE, "left_semi"), base.join(places, PLACE, "left_semi")
        log = self._table("log", StructField("_segment", LongType()), *_PLACES).join(live, ["_segment", *PLACE], "left_semi").drop("_segment")
        kept = self._table("base", StructField("_version", StringType()), *_PLACES).join(base, ["_version", *PLACE], "left_semi")
        return kept.drop("_version").unionByName(log)

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The last capture of each post, with its partition; of some time partitions or all."""
        rows = self._captures() if parts is None else self._captures().where(F.col(tables.PART).isin(list(parts)))
        return dedup_keep_last(rows, [*self.layout.keys, *PLACE], self.arrival).select(*self.schema.names, tables.PART)

    def compact(self, least: int = 8) -> int:
        """Write a new version of the buckets with ``least`` or more segments since their last one; returns how many there were."""
        upto = self.segments().agg(F.max("_segment")).first()[0]
        if upto is None:
            return 0
        path, version = work_dir(self.spark, "places"), uuid.uuid4().hex
        chosen = self.live().groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
        chosen.select(*PLACE).coalesce(1).write.parquet(path)
        places = self.spark.read.schema(StructType(_PLACES)).parquet(path)
        n = places.count()
        if n:
            rows = dedup_keep_last(self._captures(places), [*self.layout.keys, *PLACE], self.arrival)
            rows.hint("rebalance", *PLACE).write.partitionBy(*PLACE).parquet(f"{self.root}/base/_version={version}")
            noted = places.select(*PLACE, F.lit(version).alias("version"), F.lit(upto).cast("long").alias("upto"), F.current_timestamp().alias("written_at"))
            noted.coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return n


_PLACES = [StructField(tables.PART, StringType()), StructField("bucket", IntegerType())]
