"""Newest-partition and control-table operators (the ``max(date)`` idioms).

A daily batch reads, for each source, the newest partition at or before the
run date (the caller's ``where`` carries that bound).  The newest value is a one-row aggregate: partial max per task, one
tiny final merge.  Consumers compare against it as a scalar subquery
(``mode="subquery"``, the default: lazy, evaluated once, no join), with a
broadcast semi join on the single row (``mode="join"``), or with a literal
obtained by collecting the scalar once (``mode="literal"``), which lets
Parquet partition pruning and row-group skipping act statically.
"""

from __future__ import annotations

import datetime as _dt
import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.newest import UNKNOWN
from . import observe

# How a newest value reaches the consumers: "subquery" (default) keeps it as
# a lazy scalar subquery, run asynchronously when the query starts and used
# for runtime partition pruning; "literal" collects the one-row aggregate
# once while the plan is built (static pruning, one blocking job per value;
# measured slower on the test data).
NEWEST_MODE = os.environ.get("RUMBO_NEWEST_MODE", "subquery")


def newest(df: DataFrame, column: str, where: Column | None = None,
           alias: str | None = None) -> DataFrame:
    """One-row frame holding ``max(column)`` (optionally over filtered rows)."""
    src = df.filter(where) if where is not None else df
    return src.agg(F.max(column).alias(alias or column))


def scalar(one_row: DataFrame, mode: str | None = None) -> Column:
    """The single value of a one-row, one-column frame as a Column.

    ``literal``: one small job now, the value becomes a literal (foldable, so
    partition filters on it prune statically).  ``subquery``: a scalar
    subquery evaluated when the consuming query runs.
    """
    if (mode or NEWEST_MODE) == "literal":
        value = one_row.first()[0]
        return F.lit(value).cast(one_row.schema.fields[0].dataType)
    return one_row.scalar()


def newest_scalar(df: DataFrame, column: str, where: Column | None = None, mode: str | None = None) -> Column:
    """``max(column)`` (over ``where`` rows) as a Column, see :func:`scalar`."""
    return scalar(newest(df, column, where), mode)


def newest_scalars(df: DataFrame, columns: list[str], where: Column | None = None,
                   mode: str | None = None) -> list[Column]:
    """Several ``max(column)`` values from one scan, see :func:`scalar`."""
    src = df.filter(where) if where is not None else df
    row = src.agg(*[F.max(c).alias(c) for c in columns])
    if (mode or NEWEST_MODE) == "literal":
        return [F.lit(v).cast(f.dataType) for v, f in zip(row.first(), row.schema.fields)]
    both = row.select(F.struct(*columns).alias("newest")).scalar()
    return [both[c] for c in columns]


def keep_newest(df: DataFrame, column: str, control: DataFrame | None = None,
                control_col: str | None = None, where: Column | None = None,
                mode: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` equals the newest value.

    ``control`` defaults to ``newest(df, column, where)`` (the newest value of
    the same table); pass another one-row frame to use a control table.
    """
    if control is None:
        control = newest(df, column, where, alias="__newest")
        control_col = "__newest"
    control_col = control_col or control.columns[-1]
    mode = mode or NEWEST_MODE
    if mode in ("subquery", "literal"):
        return df.filter(F.col(column) == scalar(control.select(control_col), mode))
    # The control side is one row: broadcasting it is always bounded.
    ctl = control.select(F.col(control_col).alias("__newest"))
    return df.join(F.broadcast(ctl), F.col(column) == F.col("__newest"), "left_semi")


def newest_of(src, table: str, column: str, at_most=None, equal: dict | None = None, mode: str | None = None) -> Column:
    """Newest value of ``column`` not after ``at_most`` among the rows ``equal`` names, as a Column.

    A literal where ``src`` can tell it without reading the table
    (``src.newest``); otherwise the aggregate over the table, see :func:`newest_scalar`.
    """
    find = getattr(src, "newest", None)
    value = find(table, column, at_most, equal) if find is not None else UNKNOWN
    df = getattr(src, table)
    if value is None:
        observe.note(f"nothing in {table} up to {at_most}")
    if value is not UNKNOWN:
        return F.lit(value).cast(df.schema[column].dataType)
    conds = [F.col(c) == F.lit(v) for c, v in (equal or {}).items()]
    conds += [F.col(column) <= F.lit(at_most)] if at_most is not None else []
    return newest_scalar(df, column, reduce(lambda a, b: a & b, conds) if conds else None, mode)


def newest_days_where(src, table: str, days: dict[str, str | None], until: _dt.date, where: Column,
                      mode: str | None = None) -> list[Column]:
    """Newest value not after ``until`` of several day columns over the rows ``where`` holds, as Columns.

    ``days`` maps a column to the pattern of its text, or to None for a date.
    """
    df = getattr(src, table)
    find = getattr(src, "newest_where", None)
    if find is not None:
        return [F.lit(v).cast(df.schema[c].dataType) for c, v in zip(days, find(table, days, until, where))]
    bound = reduce(lambda a, b: a & b, [F.col(c) <= F.lit(until.strftime(p) if p else until) for c, p in days.items()])
    return newest_scalars(df, list(days), where & bound, mode)


def control_table(entries: list[tuple[str, DataFrame, str]], date_type: str = "date") -> DataFrame:
    """UNION ALL of (label, newest value) rows, one per source (``C1``, ``C2``).

    Values are cast to one type first: mixing int and string partitions in a
    union fails under ANSI.
    """
    rows = [
        df.agg(F.max(F.col(c).cast(date_type)).alias("C2")).select(F.lit(label).alias("C1"), "C2")
        for label, df, c in entries
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def control_entry(control: DataFrame, label: str) -> DataFrame:
    """The one row of ``control`` for ``label`` (as a one-row frame)."""
    return control.filter(F.col("C1") == label).select("C2")


def control_row(spark, label: str, value: Column, date_type: str = "string") -> DataFrame:
    """One ``(C1, C2)`` row of a control table from a known newest value."""
    return spark.range(1).select(F.lit(label).alias("C1"), value.cast(date_type).alias("C2"))
