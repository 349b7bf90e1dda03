import re
from datetime import datetime
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agora.operators import bloom
from agora.operators.raw import dedup_keep_last
from agora.session import work_dir
from agora.sources import tables
from agora.sources.layout import Layout
from agora.streaming.capture_log import CaptureLog
from agora.streaming.ingest import _outermost, append_new, latest, merge_latest, stream_dedup, stream_ingest, stream_upsert, write_first

SCHEMA = "platform_id int, source_id string, posted_at timestamp, seq int, v string"


def captures(spark, n, start=0):
    rows = [
        (1, "hot" if i % 3 == 0 else str(i % 50), datetime(2023 + (i % 50) % 4, 1, 1), start + i, f"v{start + i}") for i in range(n)
    ]
    rows = [(p, s, datetime(2024, 5, 1) if s == "hot" else at, q, v) for p, s, at, q, v in rows]
    return spark.createDataFrame(rows, SCHEMA)


def content(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


KEYS = ["platform_id", "source_id", "posted_at"]


def test_ingest_picks_up_only_new_files(spark):
    feed, out, progress = (work_dir(spark, n) for n in ("feed", "out", "progress"))
    first, second = captures(spark, 300), captures(spark, 600, start=100)
    first.repartition(3).write.parquet(feed)

    def run():
        query = stream_ingest(spark, feed, first.schema, out, progress, files_per_batch=2)
        query.awaitTermination()
        return tables.read_table(spark, out, first.schema)

    expected = content(first.unionByName(second).select(*KEYS).distinct(), *KEYS)
    assert run().count() == first.select(*KEYS).distinct().count()
    second.repartition(2).write.mode("append").parquet(feed)
    assert content(run(), *KEYS) == expected
    assert content(run(), *KEYS) == expected  # nothing new


def test_repeated_batch_adds_nothing(spark):
    out, batch = work_dir(spark, "out"), captures(spark, 200)
    append_new(batch, out, batch.schema)
    once = content(tables.read_table(spark, out, batch.schema), *KEYS, "seq")
    append_new(batch, out, batch.schema)
    assert content(tables.read_table(spark, out, batch.schema), *KEYS, "seq") == once


def test_stream_upsert_equals_batch_keep_last(spark):
    feed, out, progress = (work_dir(spark, n) for n in ("feed", "out", "progress"))
    df = captures(spark, 900)
    df.repartition(7, "seq").write.parquet(feed)
    stream_upsert(
        spark, feed, df.schema, out, progress, keys=KEYS, arrival=["seq"], files_per_batch=2
    ).awaitTermination()
    def stored():
        return content(latest(spark, out, df.schema, KEYS, ["seq"]), *df.columns)

    assert stored() == content(dedup_keep_last(df, KEYS, ["seq"]), *df.columns)
    # A late repeat of old captures changes nothing.
    merge_latest(df.where("seq < 100"), out, df.schema, KEYS, ["seq"])
    assert stored() == content(dedup_keep_last(df, KEYS, ["seq"]), *df.columns)


def files_below(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_a_small_batch_writes_to_its_own_buckets_only(spark):
    """Whatever the quarter holds, ten posts add files to their buckets and read or rewrite none."""
    out = work_dir(spark, "log")
    many = spark.range(5000).select(
        F.lit(1).alias("platform_id"), F.col("id").cast("string").alias("source_id"),
        F.lit(datetime(2024, 5, 1)).alias("posted_at"), F.lit(1).alias("seq"), F.lit("v").alias("v"),
    )
    log = CaptureLog(spark, out, many.schema, ["seq"], Layout(KEYS, buckets=16))
    log.append(many)
    before = files_below(out)
    stamps = {f: Path(f).stat().st_mtime_ns for f in before}
    ten = many.limit(10).withColumn("seq", F.lit(2))
    log.append(ten)
    added = files_below(f"{out}/log") - before
    touched = {r.bucket for r in log.layout.place(ten).select("bucket").distinct().collect()}
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in added} == touched and len(touched) < 16
    assert {f: Path(f).stat().st_mtime_ns for f in before} == stamps
    assert log.read().where("seq = 2").count() == 10 and log.read().count() == 5000


def test_compaction_swaps_the_buckets_that_have_many_segments(spark):
    out, df = work_dir(spark, "log"), captures(spark, 400)
    log = CaptureLog(spark, out, df.schema, ["seq"], Layout(KEYS, buckets=4))
    for k in range(0, 400, 100):
        log.append(df.where(f"seq >= {k} AND seq < {k + 100}"))
    expected = content(dedup_keep_last(df, KEYS, ["seq"]), *df.columns)
    assert content(log.read(), *df.columns) == expected
    # A run that died between version and manifest: the old state counts.
    log._captures().write.partitionBy("part", "bucket").parquet(f"{out}/base/_version=dead")
    assert content(log.read(), *df.columns) == expected
    assert log.compact(4) > 0 and log.live().count() < log.segments().count()
    assert content(log.read(), *df.columns) == expected
    assert log.compact(4) == 0
    late = captures(spark, 30, start=1000)
    log.append(late)
    expected = content(dedup_keep_last(df.unionByName(late), KEYS, ["seq"]), *df.columns)
    assert content(log.read(), *df.columns) == expected
    assert log.compact(1) > 0 and content(log.read(), *df.columns) == expected and log.live().count() == 0
    # Compacted segments are not read any more, nor is another time partition.
    read = log.read(["2024_q2"]).inputFiles()
    assert content(log.read(["2024_q2"]), *KEYS) == [k for k in content(log.read(), *KEYS) if k[2] == datetime(2024, 5, 1)]
    assert read is not None


def test_a_table_keeps_its_year_range(spark):
    """A post of 2027 in a table that goes to 2030 is stored once, by whichever run."""
    row = spark.createDataFrame([(1, "a", datetime(2027, 3, 1), 1, "v")], SCHEMA)
    out = work_dir(spark, "facts")
    append_new(row, out, row.schema, last_year=2030)
    append_new(row, out, row.schema)
    assert [r.part for r in tables.read_table(spark, out, row.schema).collect()] == ["2027"]
    out = work_dir(spark, "raw")
    merge_latest(row, out, row.schema, KEYS, ["seq"], last_year=2030)
    merge_latest(row.withColumn("seq", F.lit(2)), out, row.schema, KEYS, ["seq"])
    assert [(r.part, r.seq) for r in latest(spark, out, row.schema, KEYS, ["seq"]).collect()] == [("2027_q1", 2)]


def test_new_posts_read_no_file_of_the_table(spark, monkeypatch):
    """Filters tell new posts apart; rows they may hold are checked against the stored keys of their buckets."""
    out = work_dir(spark, "facts")
    posts = lambda low, high: spark.range(low, high).select(
        F.lit(1).alias("platform_id"), F.col("id").cast("string").alias("source_id"),
        F.lit(datetime(2024, 5, 1)).alias("posted_at"), F.col("id").cast("int").alias("seq"), F.lit("v").alias("v"),
    )
    append_new(posts(0, 2000), out, posts(0, 1).schema)
    read = []
    real = tables.read_table

    def counted(spark, path, *more, **named):
        if path == out:
            read.append(path)
        return real(spark, path, *more, **named)

    monkeypatch.setattr(tables, "read_table", counted)
    append_new(posts(10_000, 10_010), out, posts(0, 1).schema)
    assert read == []
    append_new(posts(1990, 2010), out, posts(0, 1).schema)
    assert read == [out]
    monkeypatch.undo()
    # Filters that hold everything are slow, not wrong.
    monkeypatch.setattr("agora.streaming.ingest.perhaps_stored", lambda rows, *_: rows.withColumn("held", F.lit(True)))
    append_new(posts(2005, 2020), out, posts(0, 1).schema)
    assert sorted(r.seq for r in tables.read_table(spark, out, posts(0, 1).schema).collect()) == [*range(2020), *range(10_000, 10_010)]


def test_filters_have_no_false_negatives_and_few_false_positives():
    draw = np.random.default_rng(2)
    for n in (1, 7, 100, 5000):
        held, other = draw.integers(0, 2**63, (2, n), np.uint64)
        data = bloom.filter_bytes(held)
        assert bloom.may_hold([data], held).all() and bloom.may_hold([], other).sum() == 0
        assert bloom.may_hold([data], other).mean() < 0.01


def test_only_rows_that_may_be_stored_come_back_from_the_filters(spark):
    """A first batch asks none; later each row is judged once, whatever other rows share its hash."""
    out, df = work_dir(spark, "facts"), captures(spark, 60).dropDuplicates(KEYS)
    placed = Layout(KEYS, "year", 4, 2023, 2026).place(df)
    parts = tables.touched_partitions(placed)
    first = bloom.perhaps_stored(placed, out, KEYS, parts)
    assert "CoGroup" not in first._jdf.queryExecution().toString() and first.where("held").count() == 0
    bloom.add_filters(placed.where("seq % 2 = 0"), out, KEYS)
    twice = bloom.perhaps_stored(placed.unionByName(placed), out, KEYS, parts)
    assert twice.columns == [*placed.columns, "held"] and twice.count() == 2 * df.count()
    held = {r.seq for r in twice.where("held").collect()}
    assert {r.seq for r in df.where("seq % 2 = 0").collect()} <= held and len(held) < df.count()


def test_stream_dedup_keeps_one_of_each_across_batches(spark):
    feed, out = work_dir(spark, "feed"), work_dir(spark, "out")
    df = captures(spark, 600).withColumn("posted_at", F.lit("2024-05-01").cast("timestamp"))
    df.repartition(5).write.parquet(feed)
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    unique = stream_dedup(source, ["source_id"], "posted_at", "30 days")
    unique.writeStream.format("parquet").option("checkpointLocation", work_dir(spark, "progress")).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    ids = [r.source_id for r in spark.read.schema(df.schema).parquet(out).collect()]
    assert len(ids) == len(set(ids)) == df.select("source_id").distinct().count()


def test_copies_go_where_they_are_read_and_each_key_is_stored_once(spark):
    """One state, in a number of partitions made for the cores; the session keeps its own settings."""
    feed, out, progress = (work_dir(spark, n) for n in ("feed", "out", "progress"))
    hot = spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) AS id", "timestamp '2024-05-01' AS at")
    hot.coalesce(1).write.parquet(feed)
    hot.where("id < '3'").coalesce(1).write.mode("append").parquet(feed)
    settings = {key: spark.conf.get(key, None) for key in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        stream = spark.readStream.schema(hot.schema).option("maxFilesPerTrigger", 1).parquet(feed)
        run = write_first(stream, out, progress, keys=["id"], captured="at", delay="30 days")
        run.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", settings["spark.sql.shuffle.partitions"])
    assert {key: spark.conf.get(key, None) for key in settings} == settings
    ids = [r.id for r in spark.read.schema(hot.schema).parquet(out).collect()]
    assert len(ids) == len(set(ids)) == 4001
    first = next(p for p in run.recentProgress if p.numInputRows)
    assert [s.customMetrics["numDroppedDuplicateRows"] < 20 for s in first.stateOperators] == [True]
    partitions = [p for p in Path(progress.removeprefix("file:"), "state", "0").iterdir() if p.name.isdigit()]
    assert len(partitions) == 4 * spark.sparkContext.defaultParallelism


def test_a_late_copy_does_not_displace_one_that_is_not_late(spark):
    feed, out = work_dir(spark, "feed"), work_dir(spark, "out")
    rows = lambda *r: spark.createDataFrame(r, "id string, at timestamp").coalesce(1).write.mode("append").parquet(feed)
    rows(("z", datetime(2024, 6, 1)))
    rows(("y", datetime(2024, 6, 1)))
    rows(("a", datetime(2024, 1, 1)), ("a", datetime(2024, 6, 2)), ("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 1)))
    source = spark.readStream.schema("id string, at timestamp").option("maxFilesPerTrigger", 1).parquet(feed)
    run = write_first(source, out, work_dir(spark, "progress"), keys=["id"], captured="at", delay="30 days")
    run.awaitTermination()
    assert content(spark.read.schema("id string, at timestamp").parquet(out), "id", "at") == [
        ("a", datetime(2024, 6, 2)), ("y", datetime(2024, 6, 1)), ("z", datetime(2024, 6, 1)),
    ]


def test_rows_a_filter_removes_displace_no_copy(spark):
    feed, out = work_dir(spark, "feed"), work_dir(spark, "out")
    rows = [("a", datetime(2024, 6, day), day == 2) for day in (1, 2, 3)]
    spark.createDataFrame(rows, "id string, at timestamp, good boolean").coalesce(1).write.parquet(feed)
    good = F.arrow_udf(lambda column: column, "boolean")
    source = spark.readStream.schema("id string, at timestamp, good boolean").parquet(feed).where(good("good"))
    write_first(source, out, work_dir(spark, "progress"), keys=["id"], captured="at", delay="30 days").awaitTermination()
    assert content(spark.read.schema(source.schema).parquet(out), "id", "at") == [("a", datetime(2024, 6, 2))]


def test_each_key_keeps_its_earliest_and_latest_capture_of_an_arrow_batch():
    draw = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        at = [None if x == 0 else int(x) for x in draw.integers(0, 40, n)]
        word = [None if x == 0 else str(x) for x in draw.integers(0, 6, n)]
        pair = [None if x == 0 else {"a": int(x), "b": [1.5, None]} for x in draw.integers(0, 4, n)]
        number = [None if x == 0 else float(x) for x in draw.integers(0, 3, n)]
        kept = _outermost(
            pa.array(at, pa.int64()), pa.array(word, pa.string()),
            pa.array(pair, pa.struct([("a", pa.int64()), ("b", pa.list_(pa.float64()))])), pa.array(number, pa.float64()),
        ).to_pylist()
        groups = {}
        for i, key in enumerate(zip(word, map(repr, pair), number, strict=True)):
            groups.setdefault(key, []).append(i)
        assert len(kept) == n
        for places in groups.values():
            timed = [i for i in places if at[i] is not None]
            assert all(kept[i] for i in places if at[i] is None)
            chosen = [at[i] for i in timed if kept[i]]
            assert sorted(set(chosen)) == sorted({f(at[i] for i in timed) for f in (min, max) if timed}) and len(chosen) <= 2
