"""Declarative table queries: projection, filters, order, paging, embedding."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

Filter = tuple[str, str, Any]

_IS = {"null": None, "true": True, "false": False}


def _is(column: Column, value: Any) -> Column:
    value = _IS.get(value, value) if isinstance(value, str) else value
    if value is not None and not isinstance(value, bool):
        raise ValueError("is: compares with null, true or false")
    return column.isNull() if value is None else column.eqNullSafe(F.lit(value))


def _contains(column: Column, values: Sequence[Any]) -> Column:
    """Array containment: every wanted value occurs in the array."""
    hits = [F.array_contains(column, v) for v in values]
    return reduce(lambda a, b: a & b, hits, column.isNotNull())


FILTERS = {
    "eq": lambda c, v: c == v,
    "neq": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
    "is": _is,
    "in": lambda c, v: c.isin(list(v)),
    "contains": _contains,
}


def after(order: Sequence[tuple[str, bool]], last: Sequence[Any]) -> Column:
    """Rows that follow the row with values ``last`` in ``order``: a page's filter, in place of an offset.

    The order is that of ``query``: ascending with nulls last, descending with
    nulls first. What holds for the first column alone is stated beside the
    rest, so that it reaches the scan.
    """
    if len(last) != len(order) or not order:
        raise ValueError("a cursor has one value for each ordered column")

    def beyond(name: str, descending: bool, value: Any) -> Column:
        column = F.col(name)
        if value is None:
            return column.isNotNull() if descending else F.lit(False)
        return column < F.lit(value) if descending else (column > F.lit(value)) | column.isNull()

    same, out = F.lit(True), F.lit(False)
    for (name, descending), value in zip(order, last):
        out = out | (same & beyond(name, descending, value))
        same = same & F.col(name).eqNullSafe(F.lit(value))
    (name, descending), value = order[0], last[0]
    if value is None:
        return out
    first = F.col(name) <= F.lit(value) if descending else (F.col(name) >= F.lit(value)) | F.col(name).isNull()
    return first & out


def pages(df: DataFrame, order: Sequence[tuple[str, bool]], size: int) -> Iterator[list[Row]]:
    """The rows of ``df`` in ``order``, ``size`` at a time; each page starts after the last row of the one before.

    ``order`` must end on a unique column. A page is read like a first page,
    however many came before it.
    """
    last = None
    while True:
        rows = query(df if last is None else df.where(after(order, last)), order=order, limit=size).collect()
        if rows:
            yield rows
        if len(rows) < size:
            return
        last = [rows[-1][name] for name, _ in order]


def query(
    df: DataFrame,
    select: Sequence[str | Column] | None = None,
    where: Sequence[Filter] = (),
    order: Sequence[tuple[str, bool]] = (),
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Filter, order, page and project a table.

    ``where`` holds (column, operator, value) triples, all of which must hold,
    two on one column included. ``order`` holds (column, descending) pairs; nulls
    sort last ascending and first descending. End ``order`` on a unique column
    when paging. An offset needs a limit: alone it would send all other rows
    through one task; filter by ``after`` the last row of the page before instead.
    """
    if offset is not None and limit is None:
        raise ValueError("an offset needs a limit; to read on to the end, filter by what comes after the last row")
    for column, op, value in where:
        if op not in FILTERS:
            raise ValueError(f"unknown filter {op!r}")
        df = df.where(FILTERS[op](F.col(column), value))
    if order:
        df = df.orderBy(*[F.col(c).desc_nulls_first() if desc else F.col(c).asc_nulls_last() for c, desc in order])
    if offset is not None:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*select) if select else df


def filter_in_table(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """IN for lists too long to write out: keep rows whose value occurs in ``values``."""
    return df.join(values.select(column), column, "left_semi")


def single_row(df: DataFrame) -> Row:
    """The only row of ``df``; an error if there are none or several."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise LookupError("expected one row, found " + ("none" if not rows else "several"))
    return rows[0]


def setting(config: DataFrame, key: str, default: Any = None) -> Any:
    """One configuration value, read from its JSON; ``default`` if the key is absent or empty."""
    rows = config.where(F.col("key") == key).select("value").limit(1).collect()
    return default if not rows or rows[0].value is None else json.loads(rows[0].value)


def page_with_total(
    df: DataFrame, order: Sequence[tuple[str, bool]], limit: int, offset: int = 0, name: str = "total_count"
) -> DataFrame:
    """One page, each row beside the exact count of the whole result."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return query(df, order=order, limit=limit, offset=offset).withColumn(name, total)


def embed_one(parent: DataFrame, child: DataFrame, on: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """Embed the at most one child row of each parent as a struct column, null if there is none."""
    related = child.select(*on, F.struct(*fields).alias(name))
    return parent.join(related, list(on), "left")


def embed_related(
    parent: DataFrame,
    child: DataFrame,
    on: Sequence[str],
    fields: Sequence[str],
    name: str,
    *,
    child_key: Sequence[str] = (),
    parts: int = 1,
) -> DataFrame:
    """Embed child rows into their parent as an array of structs.

    Every parent yields ``parts`` rows, numbered by ``<name>_part``, whatever
    the size of its family; each child is in exactly one of them, chosen by the
    hash of ``child_key``. A part without children holds an empty array. Ask
    for more parts where a family may be too large for one array.
    """
    keys, part = list(on), f"{name}_part"
    number = F.pmod(F.xxhash64(*child_key), F.lit(parts)).cast("int") if parts > 1 else F.lit(0)
    fields_of = F.sort_array(F.collect_list(F.struct(*fields))).alias(name)
    grouped = child.withColumn(part, number).groupBy(*keys, part).agg(fields_of)
    every = parent.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    nothing = F.array().cast(grouped.schema[name].dataType)
    return every.join(grouped, [*keys, part], "left").withColumn(name, F.coalesce(name, nothing))
