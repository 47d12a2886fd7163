"""Top-1-per-key operators (``row_number() ... = 1``).

Spark plans ``row_number() = 1`` with a ``WindowGroupLimit`` on both sides of
the shuffle, so each task ships at most one row per key and the window only
sorts survivors.  Every ordering gets a unique last key: without it the chosen
row would depend on shuffle order (the source queries had no tie-breaker).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                      rank_col: str | None = None) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` must end with a unique tie-breaker.  NULL sort keys follow Spark
    defaults (first when ascending, last when descending).
    """
    w = Window.partitionBy(*keys).orderBy(*_as_cols(order))
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    return out if rank_col else out.drop(name)


def latest_row_per_key(df: DataFrame, keys: Sequence[str], date_col: str,
                       tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Newest row per key (``order by date desc``), then tie-breakers."""
    order = [F.col(date_col).desc()] + list(tie_breakers)
    return first_row_per_key(df, keys, order)


def worst_row_per_key(df: DataFrame, keys: Sequence[str], amount_col: str,
                      tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Lowest amount per key (the deepest overdraft)."""
    return first_row_per_key(df, keys, [F.col(amount_col).asc()] + list(tie_breakers))


def latest_in_window(df: DataFrame, key: str, date_col: str, since, until=None,
                     where: Column | None = None,
                     tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Newest row per ``key`` among rows dated in ``[since, until]``.

    The date filter sits below the window, so Parquet skips the rest and the
    shuffle only carries the window's rows.
    """
    cond = F.col(date_col) >= F.lit(since)
    if until is not None:
        cond = cond & (F.col(date_col) <= F.lit(until))
    if where is not None:
        cond = cond & where
    return latest_row_per_key(df.filter(cond), [key], date_col, tie_breakers)


def priority_order(process: str, section: str, priority_value: str,
                   tie_breakers: Sequence[str | Column] = ()) -> list[Column]:
    """Web-hit ordering: ``(p <> v AND p = '')``, ``p``, ``(s = '')``, ``s DESC``.

    Empty processes go last and empty sections go last; otherwise processes
    ascending and sections descending.  The ``p <> v`` part does not lift ``v``
    above other values (kept as the rule was written).
    """
    p, s = F.col(process), F.col(section)
    return [
        ((p != F.lit(priority_value)) & (p == F.lit(""))).asc_nulls_first(),
        p.asc_nulls_first(),
        (s == F.lit("")).asc_nulls_first(),
        s.desc_nulls_last(),
        *tie_breakers,
    ]
