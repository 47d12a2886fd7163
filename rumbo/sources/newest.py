"""Newest values without reading the tables' data.

Every journey starts by asking a table for its newest day.  Three answers, from
the cheapest:

* a **partition column**: the partitions' names, from the metastore
  (``SHOW PARTITIONS``) or from a listing of the table's folders; no file is opened
  (:func:`partition_value`);
* a **day column**, with or without a condition on other columns: bands of days
  that reach back from a known day, each twice as far as the one before, until
  one holds a row (:func:`newest_in_bands`).  The lower bound is a pushed
  filter, so Parquet skips, by the minimum and maximum in its footers, every row group that
  ends before the band: as a rule one pass that reads the newest row groups;
* a column **under a condition** in a partitioned table: partitions are read
  from the newest downwards, 1, 2, 4, ... at a time, until no unread one can
  hold a newer value (:func:`newest_under`).

(Spark's aggregate push-down would answer the second case from the footers alone,
but it finds a file's column by its place in the declared schema, not by
its name, and is wrong without a warning where files differ in column order;
it is not used.)

All are exact.  A partition counts when its folder holds a data file that is
not empty, or when the metastore lists it.  Sources keep the answers they have given: one set of
sources is one view of the warehouse, as its tables' file listings are.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The name of the partition that holds rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class _Unknown:
    """Metadata cannot tell (a view, statistics missing, a type without them)."""

    def __repr__(self) -> str:
        return "UNKNOWN"


UNKNOWN = _Unknown()


@dataclass(frozen=True)
class Partition:
    """Values by column, in the order of the partitioning; ``path`` of its folder if known."""

    values: tuple[tuple[str, Any], ...]
    path: str | None = None

    def __getitem__(self, column: str) -> Any:
        return dict(self.values)[column]

    def condition(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in self.values])


def typed(value: str, kind: T.DataType) -> Any:
    """A partition value as its column's type."""
    if isinstance(kind, T.IntegralType):
        return int(value)
    if isinstance(kind, T.DateType):
        return _dt.date.fromisoformat(value)
    return value


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_")) and "=" not in name


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds, at any depth, a data file that is not empty."""
    for f in _files(spark, path):
        name = f.getPath().getName()
        if _hidden(name):
            continue
        if f.isDirectory():
            if has_data(spark, f.getPath().toString()):
                return True
        elif f.getLen() > 0:
            return True
    return False


def folder_partitions(spark: SparkSession, root: str, schema: T.StructType, equal: Mapping[str, Any] | None = None) -> list[Partition]:
    """Partitions of a table below ``root`` (folders ``column=value``); only folders that meet ``equal`` are entered."""
    equal = equal or {}
    found, level = [], [((), root)]
    while level:
        deeper = []
        for values, path in level:
            leaf = True
            for f in _files(spark, path):
                column, eq, value = f.getPath().getName().partition("=")
                if not f.isDirectory() or not eq:
                    continue
                leaf = False
                value = unquote(value)
                if value == NO_VALUE:
                    continue
                value = typed(value, schema[column].dataType)
                if column not in equal or equal[column] == value:
                    deeper.append((values + ((column, value),), f.getPath().toString()))
            if leaf and values:
                found.append(Partition(values, path))
        level = deeper
    return found


def catalog_partitions(spark: SparkSession, table: str, schema: T.StructType, equal: Mapping[str, Any] | None = None) -> list[Partition] | None:
    """Partitions that the metastore lists for ``table``; None for views and tables without partitions."""
    try:
        rows = spark.sql(f"SHOW PARTITIONS {table}").collect()      # one row a partition
    except PySparkException:
        return None
    types = {f.name.lower(): f.dataType for f in schema.fields}
    out = []
    for (spec,) in rows:
        values = [(c.lower(), unquote(v)) for c, _, v in (p.partition("=") for p in spec.split("/"))]
        if any(v == NO_VALUE for _, v in values):
            continue
        values = tuple((c, typed(v, types[c])) for c, v in values)
        if all(v == equal[c] for c, v in values if c in (equal or {})):
            out.append(Partition(values))
    return out


def partition_value(partitions: Sequence[Partition], column: str, at_most: Any = None, spark: SparkSession | None = None) -> Any:
    """Newest value of a partition column among ``partitions`` that hold data (with a path: looked for, newest first)."""
    order = sorted((p for p in partitions if at_most is None or p[column] <= at_most), key=lambda p: p[column], reverse=True)
    for p in order:
        if p.path is None or has_data(spark, p.path):
            return p[column]
    return None


def _largest(df: DataFrame, column: str) -> Any:
    return df.agg(F.max(column)).first()[0]


def newest_under(df: DataFrame, column: str, bounds: Sequence[tuple[Partition, Any]], where: Column, at_most: Any = None) -> Any:
    """Newest value among the rows ``where`` holds.

    ``bounds`` give each partition's greatest value.  Partitions are read in falling order
    of it, 1, 2, 4, ... at a time, until no unread partition reaches beyond the value found.
    """
    capped = sorted(((p, hi if at_most is None else min(hi, at_most)) for p, hi in bounds if hi is not None), key=lambda x: x[1], reverse=True)
    rows = df.filter(where)
    if at_most is not None:
        rows = rows.filter(F.col(column) <= F.lit(at_most))
    best, i, step = None, 0, 1
    while i < len(capped) and (best is None or capped[i][1] > best):
        some = capped[i:i + step]
        found = _largest(rows.filter(reduce(lambda a, b: a | b, [p.condition() for p, _ in some])), column)
        best = max((v for v in (best, found) if v is not None), default=None)
        i, step = i + step, step * 2
    return best


# The last pass has no lower bound; the one before it reaches this far back.
BAND_DAYS = 4096


def band(df: DataFrame, days: Mapping[str, str | None], low: _dt.date | None, until: _dt.date | None) -> DataFrame:
    """Rows with any of the day columns in ``[low, until]`` (all of them not after ``until``).

    ``days`` maps a column to the pattern of its text (``%Y%m%d``), or to None for a date or a time.
    """
    def text(c: str, day: _dt.date) -> Any:
        return day.strftime(days[c]) if days[c] else day

    if until is not None:
        df = df.filter(reduce(lambda a, b: a & b, [F.col(c) <= F.lit(text(c, until)) for c in days]))
    if low is not None:
        df = df.filter(reduce(lambda a, b: a | b, [F.col(c) >= F.lit(text(c, low)) for c in days]))
    return df


def _day(value: Any) -> Any:
    return value.date() if isinstance(value, _dt.datetime) else value


def newest_in_bands(df: DataFrame, days: Mapping[str, str | None], start: _dt.date, until: _dt.date | None = None,
                    where: Column | None = None) -> list[Any]:
    """Newest value of each of some day columns over the rows ``where`` holds, none later than ``until``.

    ``start`` is where to look first, ``until`` or a guess of the newest day; a wrong guess
    costs passes, not the result, as a band has no upper end but ``until``.
    """
    rows = df.filter(where) if where is not None else df
    found: dict[str, Any] = {}
    back: int | None = 1
    while len(found) < len(days):
        unknown = {c: p for c, p in days.items() if c not in found}
        low = start - _dt.timedelta(days=back) if back is not None else None
        bounded = band(rows, days, None, until)
        got = band(bounded, unknown, low, None).agg(*[F.max(c).alias(c) for c in unknown]).first()
        # a row is in the band for any of the columns: a value before it may have a newer one outside
        at_least = {c: (low.strftime(p) if p else low) if low is not None else None for c, p in unknown.items()}
        found |= {c: got[c] for c in unknown if low is None or got[c] is not None and _day(got[c]) >= at_least[c]}
        back = back * 2 if back is not None and back * 2 <= BAND_DAYS else None
    return [found[c] for c in days]


class NewestValues:
    """Mixin of sources: ``newest(...)`` without reading data, :data:`UNKNOWN` where that cannot be told.

    A class that uses it has ``table(name)`` and ``partitions(name, equal)`` (None: not known).
    """

    def newest(self, name: str, column: str, at_most: Any = None, equal: Mapping[str, Any] | None = None) -> Any:
        """Newest value of a column, not after ``at_most``, in the partitions that ``equal`` names."""
        key = (name, column, at_most, tuple(sorted((equal or {}).items())))
        known = self.__dict__.setdefault("_newest", {})
        if key not in known:
            known[key] = self._find(name, column, at_most, dict(equal or {}))
        return known[key]

    def _find(self, name: str, column: str, at_most: Any, equal: dict[str, Any]) -> Any:
        partitions = self.partitions(name, equal)
        by = [c for c, _ in partitions[0].values] if partitions else []
        if column in by and set(equal) <= set(by):
            return partition_value(partitions, column, at_most, self.spark)
        df = self.table(name)
        if isinstance(at_most, _dt.date) and isinstance(df.schema[column].dataType, T.DateType):
            where = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in equal.items()]) if equal else None
            return newest_in_bands(df, {column: None}, at_most, at_most, where)[0]
        return UNKNOWN

    def newest_where(self, name: str, days: Mapping[str, str | None], until: _dt.date, where: Column) -> list[Any]:
        """Newest value of each day column not after ``until`` over the rows ``where`` holds (a condition on data columns)."""
        key = (name, tuple(days.items()), until, str(where))
        known = self.__dict__.setdefault("_newest", {})
        if key not in known:
            partitions = self.partitions(name) if len(days) == 1 else None
            ((column, pattern),) = days.items() if len(days) == 1 else ((None, None),)
            if partitions and column in [c for c, _ in partitions[0].values]:
                top = until.strftime(pattern) if pattern else until
                known[key] = [newest_under(self.table(name), column, [(p, p[column]) for p in partitions], where, top)]
            else:
                known[key] = newest_in_bands(self.table(name), days, until, until, where)
        return known[key]
