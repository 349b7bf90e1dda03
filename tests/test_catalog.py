"""Every registered query against its SQL twin, whole tables, values included."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from agora.catalog import load_all

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
QUERIES, SQL = load_all()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _sorted(rows):
    return sorted((tuple(map(_plain, row)) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = _sorted(frame.select(*columns).collect())
    assert rows, "a registered query has rows on every table size"
    if name in SQL:
        result = duck.execute(SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert rows == _sorted([tuple(r[i] for i in order) for r in result.fetchall()])


def test_entry_is_the_flagship(spark):
    frame = entry.entry(spark)
    assert "avg_engagement" in frame.columns and frame.count() > 0


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_embed_related_splits_large_families(spark, monkeypatch):
    from agora.catalog import tables

    tables_of = {
        "orders": spark.createDataFrame([(1,), (2,), (3,)], "o_orderkey long"),
        "lineitem": spark.createDataFrame([(1, k, 1.0) for k in range(1000)] + [(3, 1, 2.0)], "l_orderkey long, l_linenumber int, l_quantity double"),
    }
    kept, embed = [], tables.Q.embed_related
    monkeypatch.setattr(tables.sample, "read", lambda spark, sf, name: tables_of[name])
    monkeypatch.setattr(tables.Q, "embed_related", lambda *a, **b: kept.append(embed(*a, **b)) or kept[-1])
    rows = [tuple(r) for r in tables.embed_related(spark, "").collect()]
    assert sorted(rows, key=str) == sorted([(1, k, 1.0) for k in range(1000)] + [(2, None, -1.0), (3, 1, 2.0)], key=str)
    assert max(len(r.lines) for r in kept[0].collect()) < 500


def test_config_lookup_asks_for_every_order_and_document(spark, sf_dir):
    found = QUERIES["config_lookup"](spark, sf_dir).collect()
    asked = sum(spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "documents"))
    assert sum(r.lookups for r in found) == asked and len({r.key for r in found}) == len(found)
    assert {r.value == "default" for r in found} == {True, False}
