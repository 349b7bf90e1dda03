"""Small tables written out in code: seed rows, search settings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def small_table(spark: SparkSession, schema: StructType, rows: Iterable[Sequence]) -> DataFrame:
    """Rows given in code. An Arrow table becomes a local relation, whose exact
    size lets Spark broadcast it by itself; a list of tuples would not."""
    records = [dict(zip(schema.fieldNames(), r, strict=True)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """A table without rows that the optimizer knows to be empty."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
