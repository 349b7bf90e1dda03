"""The warehouse: raw tables, staging, facts, rejects and views below one folder.

Each step is one set-based Spark job over whatever is pending; there is no
paging, and each can be run again after a failure without doubling rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora import fixed, schemas
from agora.functions.text import clean_text
from agora.operators import load, raw
from agora.operators.dims import Dimensions, build_dim_topic, default_dimensions, topic_rows
from agora.operators.query import setting
from agora.plans.star import MONTHLY, add_up, summarise
from agora.plans.views import VIEWS
from agora.session import pin, work_dir
from agora.sources import tables
from agora.sources.local import empty_table

RAW_TABLES = {
    fixed.X_SOURCE: ("raw_x", schemas.RAW_X, schemas.X_COUNTS),
    fixed.REDDIT_SOURCE: ("raw_reddit", schemas.RAW_REDDIT, schemas.REDDIT_COUNTS),
}
POST_KEY = ["source_type", "id", "posted_at"]

# Adds columns to a frame of cleaned posts (processed_text).
Step = Callable[[DataFrame], DataFrame]


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    dims: Dimensions | None = None
    first_year: int = tables.FIRST_YEAR
    last_year: int = tables.LAST_YEAR

    def __post_init__(self) -> None:
        pin(self.spark)
        self.root = self.root.rstrip("/")
        self.dims = self.dims or default_dimensions(self.spark)

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _stored_raw(self, source: str) -> DataFrame:
        name, schema, _ = RAW_TABLES[source]
        return tables.read_table(self.spark, self._path(name), schema)

    def _processed(self, source: str) -> DataFrame:
        ledger = tables.read_table(self.spark, self._path("processed"), schemas.PROCESSED)
        return ledger.where(F.col("source_type") == source)

    def raw(self, source: str) -> DataFrame:
        """Raw posts; which are processed is kept in a ledger beside them, so raw files are not rewritten for it."""
        return raw.mark_processed(self._stored_raw(source), self._processed(source), ("id", "posted_at", tables.PART))

    def _log(self, name: str, rows: list[tuple], schema) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(self._path(name))

    def _pending_parts(self, source: str) -> list[str]:
        """Raw partitions written since posts were last staged: at most one per stored partition."""
        scans = tables.read_table(self.spark, self._path("scans"), schemas.SCAN, by=None)
        last = scans.where(F.col("source_type") == source).agg(F.max("scanned_at")).first()[0]
        uploads = tables.read_table(self.spark, self._path("uploads"), schemas.UPLOAD, by=None)
        uploads = uploads.where(F.col("source_type") == source)
        if last is not None:
            uploads = uploads.where(F.col("uploaded_at") >= F.lit(last))
        return tables.touched_partitions(uploads, "touched")

    def config(self) -> DataFrame:
        """Settings the warehouse has written, such as ``last-updated``: the last value of each key."""
        every = tables.read_table(self.spark, self._path("app_config"), schemas.SETTING, by=None)
        return every.groupBy("key").agg(F.max_by("value", "written_at").alias("value"), F.min("written_at").alias("created_at"))

    def dimensions(self) -> Dimensions:
        """The dimensions, with the topics that loads have added."""
        stored = tables.read_table(self.spark, self._path("dim_topic"), schemas.STORED_TOPIC, by=None)
        last = raw.dedup_keep_last(stored, ["topic_id"], ["written_at"]).drop("written_at")
        seed = self.dims.topic.join(last, "topic_id", "left_anti")
        return replace(self.dims, topic=seed.unionByName(last))

    def _extend_topics(self, staged: DataFrame) -> None:
        """Store staged labels the topic dimension lacks, and keywords of topics that had none."""
        known = self.dimensions().topic
        found = topic_rows(staged.where(F.size("top_keywords") > 0)).select("topic_label", "top_keywords")
        bare = known.where(F.size("top_keywords") == 0).drop("top_keywords")
        named = bare.join(found, "topic_label")
        nothing = F.array().cast("array<string>")
        new = build_dim_topic(staged.withColumn("top_keywords", F.coalesce("top_keywords", nothing)), known)
        changed = named.unionByName(new.join(known.select("topic_id"), "topic_id", "left_anti"))
        now = F.lit(datetime.now(timezone.utc)).alias("written_at")
        rows = changed.select(F.col("topic_id").cast("int"), "topic_label", "topic_category", "top_keywords", now)
        rows.coalesce(1).write.mode("append").parquet(self._path("dim_topic"))

    def staged(self) -> DataFrame:
        return tables.read_table(self.spark, self._path("staging"), schemas.STAGED)

    def facts(self) -> DataFrame:
        return tables.read_table(self.spark, self._path("fact_post"), schemas.FACT)

    def rejected(self) -> DataFrame:
        return tables.read_table(self.spark, self._path("rejects"), schemas.REJECT)

    def _part(self, df: DataFrame, grain: str) -> DataFrame:
        return tables.with_partition(df, grain, self.first_year, self.last_year)

    def _current(self):
        """The newest complete version of the views (version, loaded_until), None before the first."""
        known = tables.read_table(self.spark, self._path("view_versions"), schemas.VIEW_VERSION, by=None)
        return known.orderBy(F.desc("built_at"), F.desc("version")).first()

    def _monthly(self, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._path('monthly')}/version={version}")

    def view(self, name: str) -> DataFrame:
        """A stored view, whichever session built it."""
        current = self._current()
        if current is None:
            raise LookupError("no views have been built yet")
        return self.spark.read.parquet(f"{self._path(name)}/version={current.version}")

    def upload(self, source: str, scraped: DataFrame, arrival: list[str]) -> None:
        """Merge scraped posts into the raw table; only the partitions they fall in are rewritten.

        ``arrival`` orders repeated captures of one post; the last one counts.
        The partitions are noted first: they count as pending if the run dies.
        """
        name, schema, counts = RAW_TABLES[source]
        last = raw.dedup_keep_last(scraped, ["id"], arrival)
        incoming = self._part(raw.prepare_raw(last, schema, counts), "quarter").persist()
        try:
            touched = tables.touched_partitions(incoming)
            now = datetime.now(timezone.utc)
            self._log("uploads", [(source, part, now) for part in touched], schemas.UPLOAD)
            stored = self._stored_raw(source).where(F.col(tables.PART).isin(touched))
            merged = raw.upsert(
                stored, incoming, ["id", "posted_at"], keep=["is_processed"], defaults={"is_processed": False}
            )
            tables.overwrite_partitions(merged, self._path(name))
            self._log("app_config", [("last-updated", now.isoformat(), now)], schemas.SETTING)
        finally:
            incoming.unpersist()

    def transform(self, source: str, score: Step, topics: Step, **cleaning) -> None:
        """Clean, score and stage the pending posts that are not staged yet.

        Only partitions written since the last time are read.
        """
        began = datetime.now(timezone.utc)
        parts = self._pending_parts(source)
        if not parts:
            return
        here = F.col(tables.PART).isin(parts)
        stored = self._stored_raw(source).where(here)
        pending = raw.get_unprocessed(stored, source).select("id", "text_content", "posted_at", "extra.*")
        pending = pending.withColumn("source_type", F.lit(source))
        done = self._processed(source).where(here).select(*POST_KEY).union(self.staged().where(here).select(*POST_KEY))
        pending = pending.join(done, POST_KEY, "left_anti")
        scored = topics(score(clean_text(pending, "text_content", **cleaning)))
        columns = {f.name: f.dataType for f in schemas.STAGED.fields}
        out = scored.select(
            *[
                (F.col(n) if n in scored.columns else F.lit(None)).cast(t).alias(n)
                for n, t in columns.items()
            ]
        )
        tables.append_table(self._part(out, "quarter"), self._path("staging"))
        self._log("scans", [(source, began)], schemas.SCAN)

    def load(self) -> int:
        """Turn staged posts into facts, keep what cannot be resolved as rejects, then clear staging.

        Every write skips rows already there, so a run that died halfway is
        finished by running again. Returns the number of new facts.
        """
        staged = self.staged()
        if staged.isEmpty():
            return 0
        self._extend_topics(staged)
        keys = load.resolve_keys(staged, self.dimensions())
        # Resolved once, into the shared work folder; every step below reads that.
        path = work_dir(self.spark, "resolved")
        keys.write.parquet(path)
        resolved = self.spark.read.schema(keys.schema).parquet(path)
        years = self._part(load.accepted(resolved), "year")
        touched = tables.touched_partitions(self._part(resolved, "year"))
        facts = self.facts().where(F.col(tables.PART).isin(touched))
        now = F.lit(datetime.now(timezone.utc))
        fresh = load.new_facts(facts, years).withColumn("loaded_at", now)
        tables.append_table(fresh, self._path("fact_post"))
        stored = self.facts().where(F.col(tables.PART).isin(touched))
        loaded = stored.where(F.col("loaded_at") == now).count()

        key = ["source_type", "source_id", "posted_at"]
        refused = self._part(load.rejects(resolved), "year")
        known = self.rejected().where(F.col(tables.PART).isin(touched))
        tables.append_table(load.new_facts(known, refused, key), self._path("rejects"))

        tables.append_table(staged.select(*POST_KEY, tables.PART), self._path("processed"))
        # One writer at a time: whatever is staged now has just been loaded.
        empty = empty_table(self.spark, staged.schema)
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(tables.PART).parquet(
            self._path("staging")
        )
        return loaded

    def load_and_refresh(self) -> int:
        """Load, then refresh the views if they are older than the facts, whichever run loaded those."""
        loaded = self.load()
        current, newest = self._current(), self.facts().agg(F.max("loaded_at")).first()[0]
        if newest is not None and (current is None or current.loaded_until is None or current.loaded_until < newest):
            self.refresh_views()
        return loaded

    def cleaning_options(self, config: DataFrame) -> dict:
        """Word lists of the cleaner as the configuration table states them, else the defaults."""
        return {
            "dropped_hashtags": setting(config, "unnecessary-hashtags", fixed.DROPPED_HASHTAGS),
            "slang": setting(config, "slang-mapping", fixed.SLANG),
        }

    def refresh_views(self, years: list[int] | None = None, version: str | None = None, full: bool = False) -> dict[str, str]:
        """Bring the four views up to date in a new version folder and make it the current one.

        Only facts loaded since the current version are read: their monthly sums
        are added to its stored summary, which all views are built from; sums, squares
        and counts merge exactly. Dimensions are joined anew. ``full`` reads all facts,
        which is needed after facts were deleted or changed, and is done where there is no version yet.
        With ``years``, all facts of those years are read, and their months replace those
        of the summary; the next refresh is a full one. The version is recorded
        last, so a run that dies leaves the former one current.
        """
        version = version or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        facts, current = self.facts(), self._current()
        until = facts.agg(F.max("loaded_at")).first()[0]
        added = current is not None and current.loaded_until is not None and not current.by_years and version != current.version
        rest = None
        if years:
            if current is None:
                raise LookupError("years can only be replaced in views that exist; refresh all of them first")
            labels = {str(y) if self.first_year <= y <= self.last_year else "default" for y in years}
            facts = facts.where(F.col(tables.PART).isin(sorted(labels)) & F.year("posted_at").isin(list(years)))
            rest = self._monthly(current.version).where(~F.col("year").isin(list(years)))
            # Facts of other years may be newer than the views; the views stay due for them.
            until = current.loaded_until
        elif added and not full:
            # Each load writes its own files, so the filter leaves row groups of former loads unread.
            facts = facts.where(F.col("loaded_at") > F.lit(current.loaded_until))
            rest = self._monthly(current.version)
        dims = self.dimensions()
        summary = summarise(facts, dims, MONTHLY)
        if rest is not None:
            summary = summary.unionByName(rest).groupBy(*MONTHLY).agg(*add_up())
        monthly = self.spark.read.parquet(tables.write_version(summary, self._path("monthly"), version))
        out = {name: tables.write_version(build(monthly, dims), self._path(name), version) for name, build in VIEWS.items()}
        record = self.spark.createDataFrame([(version, datetime.now(timezone.utc), until, bool(years))], schemas.VIEW_VERSION)
        record.write.mode("append").parquet(self._path("view_versions"))
        for name, where in out.items():
            self.spark.read.parquet(where).createOrReplaceTempView(name)
        return out
