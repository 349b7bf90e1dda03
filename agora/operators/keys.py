"""Dense surrogate keys by range partitions: no single task sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agora.session import work_dir

# Rows of a range, on average.
RANGE_ROWS = 1_000_000


def in_ranges(df: DataFrame, keys: Sequence[str], rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """``df`` sorted by ``keys`` over ranges of about equal size, with ``_range`` and the row's ``_place`` in it, stored.

    Split points come from a sample of the whole key, so a value that many rows
    share in one column does not make a large range. Stored, because the numbers must
    not change when a lost executor has its ranges made again.
    """
    spark = df.sparkSession
    source, path = work_dir(spark, "to-number"), work_dir(spark, "ranges")
    df.write.parquet(source)
    rows = spark.read.schema(df.schema).parquet(source)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // rows_per_range))
    placed = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    # The identifier is the partition's number in the high bits and the row's in the low 33.
    return placed.withColumns({"_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")


def surrogate_keys(df: DataFrame, keys: Sequence[str], name: str, *, start: int = 1, rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` without gaps in the order of ``keys``, which must be unique; nulls come first.

    Rows are numbered inside ranges and shifted by the sizes of the ranges
    before: one number per range meets in one place, not one row of data.
    """
    placed = in_ranges(df, keys, rows_per_range)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    numbered = placed.join(shifts, "_range").withColumn(name, (F.col("_shift") + F.col("_place") + start).cast("long"))
    return numbered.select(*df.columns, name)
