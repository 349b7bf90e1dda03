"""The raw layer: prepare, deduplicate, merge, mark and select posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agora import fixed, schemas


def union_platforms(x_posts: DataFrame, reddit_posts: DataFrame) -> DataFrame:
    """Both platforms in one frame, tagged; columns one side lacks are null."""
    return x_posts.withColumn("source_type", F.lit(fixed.X_SOURCE)).unionByName(
        reddit_posts.withColumn("source_type", F.lit(fixed.REDDIT_SOURCE)), allowMissingColumns=True
    )


def prepare_raw(df: DataFrame, schema: StructType, counts: Sequence[str], scraped_at: Column | None = None) -> DataFrame:
    """Cut to the table's columns and types, counts null -> 0, NaN -> null, stamp ``scraped_at``."""
    if "scraped_at" not in df.columns:
        df = df.withColumn("scraped_at", F.current_timestamp() if scraped_at is None else scraped_at)
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    out = []
    for field in schema.fields:
        if field.name not in df.columns:
            continue
        value = F.col(field.name)
        if field.name in floating:
            value = F.nanvl(value, F.lit(None).cast("double"))
        if field.name in counts:
            value = F.coalesce(value, F.lit(0))
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last one in ``order_by``.

    A grouped max_by rather than a ranked window: map tasks reduce their copies
    first, so a key holding a large share of all rows never meets in one task.
    ``order_by`` must tell the copies of a key apart.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("last")
    picked = df.groupBy(*keys).agg(last).select(*keys, "last.*")
    return picked.select(*df.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    keep: Sequence[str] = (),
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Merge ``source`` into ``target``; both unique on ``keys``.

    Matched rows take every source column, nulls included, except those in
    ``keep`` and those the source lacks. New rows take ``defaults`` there.
    """
    defaults = defaults or {}
    old = [c for c in target.columns if c not in keys]
    new = [c for c in source.columns if c not in keys]
    stored = target.select(*keys, F.struct(*old).alias("_old"))
    incoming = source.select(*keys, F.struct(*new).alias("_new"))
    out = []
    for name in target.columns:
        if name in keys:
            value = F.col(name)
        elif name in keep or name not in new:
            value = F.when(F.col("_old").isNull(), F.lit(defaults.get(name))).otherwise(F.col(f"_old.{name}"))
        else:
            value = F.when(F.col("_new").isNull(), F.col(f"_old.{name}")).otherwise(F.col(f"_new.{name}"))
        out.append(value.alias(name))
    return stored.join(incoming, list(keys), "full_outer").select(*out)


def upsert_raw(target: DataFrame, source: DataFrame) -> DataFrame:
    """Raw merge on (id, posted_at): payload is replaced, ``is_processed`` survives, new rows are pending."""
    return upsert(target, source, ["id", "posted_at"], keep=["is_processed"], defaults={"is_processed": False})


def delete_by_ids(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys are not in ``ids``."""
    return df.join(ids.select(*keys), list(keys), "left_anti")


def mark_processed(df: DataFrame, ids: DataFrame, keys: Sequence[str] = ("id", "posted_at")) -> DataFrame:
    """Set ``is_processed`` where the keys occur in ``ids``; other rows keep their flag."""
    hit = ids.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (
        df.join(hit, list(keys), "left")
        .withColumn("is_processed", F.coalesce(F.col("_hit"), F.col("is_processed")))
        .select(*df.columns)
    )


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` plus the rows of ``new`` whose keys it lacks; the first of repeated new keys wins by value order."""
    rest = [c for c in new.columns if c not in keys]
    if rest:
        one = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    else:
        one = new.distinct()
    absent = one.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(absent, allowMissingColumns=True)


def time_window_filter(df: DataFrame, since: str, until: str) -> DataFrame:
    """Posts with ``since <= posted_at < until``; stored tables use ``tables.read_window``."""
    at = F.col("posted_at")
    return df.where((at >= F.lit(since).cast("timestamp")) & (at < F.lit(until).cast("timestamp")))


def get_unprocessed(df: DataFrame, platform: str) -> DataFrame:
    """Pending posts with the platform's own fields packed as one struct ``extra``."""
    extra = schemas.X_EXTRA if platform == fixed.X_SOURCE else schemas.REDDIT_EXTRA
    return df.where(~F.col("is_processed")).select(
        "id", "text_content", "posted_at", F.struct(*extra.fieldNames()).alias("extra")
    )


def pack_extra(df: DataFrame, fields: Sequence[str], name: str = "extra") -> DataFrame:
    """Replace ``fields`` by one JSON text column."""
    packed = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name)
    return df.select(*[c for c in df.columns if c not in fields], packed)


def unpack_extra(df: DataFrame, schema: StructType, name: str = "extra") -> DataFrame:
    """Replace the JSON text column by its fields."""
    parsed = df.withColumn(name, F.from_json(F.col(name), schema))
    return parsed.select(*[c for c in df.columns if c != name], f"{name}.*")


def config_lookup(config: DataFrame, keys: DataFrame, default: str | None) -> DataFrame:
    """``keys`` with the value of each wanted key, or ``default`` where the table has no such key."""
    found = config.select("key", "value").withColumn("_hit", F.lit(True))
    value = F.when(F.col("_hit"), F.col("value")).otherwise(F.lit(default))
    return keys.join(found, "key", "left").select(*keys.columns, value.alias("value"))


def set_config(config: DataFrame, entries: DataFrame) -> DataFrame:
    """Upsert key/value entries such as the time of the last run; new ones get the time as ``created_at``."""
    return upsert(config, entries, ["key"], keep=["created_at"], defaults={"created_at": F.current_timestamp()})
