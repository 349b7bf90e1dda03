"""Stored tables: partitioned Parquet layout, append, partition overwrite, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agora.functions.posts import partition_label, window_partitions
from agora.operators.raw import time_window_filter
from agora.session import work_dir
from agora.sources.local import empty_table

FIRST_YEAR, LAST_YEAR = 2023, 2026
PART = "part"


def with_partition(df: DataFrame, grain: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """Add the partition column: '2024_q1' or '2024', and 'default' outside the covered years."""
    return df.withColumn(PART, partition_label(F.col("posted_at"), grain, first_year, last_year))


def partition_layout(df: DataFrame, grain: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """Rows per partition the table would have."""
    return with_partition(df, grain, first_year, last_year).groupBy(PART).agg(F.count(F.lit(1)).alias("row_count"))


def read_table(spark: SparkSession, path: str, schema: StructType, by: str | None = PART) -> DataFrame:
    """A stored table; empty where nothing has been written yet.

    The partition column is declared as text: left to inference, a table that
    holds only '2024' would read it as a number.
    """
    full = StructType(list(schema.fields))
    if by and by not in full.fieldNames():
        full = full.add(by, "string")
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, full)


def read_window(
    spark: SparkSession,
    path: str,
    schema: StructType,
    since: str,
    until: str,
    grain: str,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
) -> DataFrame:
    """Posts of ``[since, until)`` from a stored table, reading only their partitions.

    Spark prunes by filters on the partition column, not by ``posted_at``, so
    the window is stated for both.
    """
    parts = window_partitions(since, until, grain, first_year, last_year)
    return time_window_filter(read_table(spark, path, schema).where(F.col(PART).isin(parts)), since, until)


def _balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    # Rows meet by partition, so each gets few files; AQE splits a partition
    # that holds a large share of the rows and merges small ones.
    return df.hint("rebalance", *by)


def append_table(df: DataFrame, path: str, by: Sequence[str] = (PART,)) -> None:
    _balanced(df, by).write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str] = (PART,)) -> None:
    """Replace exactly the partitions ``df`` has rows for, even where ``df`` reads ``path``.

    The rows are first written to the shared work folder: overwriting files a
    running plan still reads, or may have to read again after an executor is
    lost, would lose rows.
    """
    spark = df.sparkSession
    staging = work_dir(spark, "staging")
    _balanced(df, by).write.partitionBy(*by).parquet(staging)
    stored = spark.read.schema(df.schema).parquet(staging)
    stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def touched_partitions(df: DataFrame, by: str = PART) -> list:
    """Partition values ``df`` has rows in: at most one per stored partition."""
    return [r[0] for r in df.select(by).distinct().collect()]


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Write a complete new version of a small table; readers of older versions are not disturbed."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path
