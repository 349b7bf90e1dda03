"""The layout of a table of posts: partitions by time, hash buckets inside them, kept beside the table.

A table's layout is written once, by the first run that uses it. Later runs,
streams included, take it from there, so that one table never has two year
ranges and a post never two places.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora import schemas
from agora.sources import tables

BUCKET = "bucket"
PLACE = [tables.PART, BUCKET]


@dataclass(frozen=True)
class Layout:
    """Time partitions of ``grain`` over a range of years, each in ``buckets`` parts by a hash of ``keys``.

    ``keys`` hold ``posted_at``: else copies of a post could lie in partitions that a batch does not touch.
    """

    keys: tuple[str, ...]
    grain: str = "quarter"
    buckets: int = 64
    first_year: int = tables.FIRST_YEAR
    last_year: int = tables.LAST_YEAR

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(self.keys))
        if "posted_at" not in self.keys:
            raise ValueError("keys must hold posted_at: else copies of a key can lie in partitions the batch does not touch")

    def place(self, df: DataFrame) -> DataFrame:
        """Add the partition and the bucket of each row."""
        rows = tables.with_partition(df, self.grain, self.first_year, self.last_year)
        return rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def layout_of(spark: SparkSession, path: str, default: Layout) -> Layout:
    """The layout stored beside the table at ``path``; ``default`` is stored where there is none yet."""
    where = f"{path.rstrip('/')}-layout"
    found = tables.read_table(spark, where, schemas.SETTING, by=None).orderBy("written_at").first()
    if found is not None:
        return Layout(**json.loads(found.value))
    rows = spark.range(1).select(F.lit("layout").alias("key"), F.lit(json.dumps(asdict(default))).alias("value"), F.current_timestamp().alias("written_at"))
    rows.coalesce(1).write.mode("append").parquet(where)
    return default
