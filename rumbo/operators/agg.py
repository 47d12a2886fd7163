"""Aggregate operators used by the journeys.

All are plain ``groupBy().agg()`` with built-in functions, so Spark runs a
partial (map-side) aggregation before the shuffle and a final one after it:
what crosses the network is one row per key per task, whatever the skew of
the key (a customer holding a third of all rows still produces one partial
row per task).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag


def max_per_key(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(alias))


# Amounts are summed as decimals: a sum of doubles depends on the order of its
# rows, and tests of its sign or against a limit hang on it.  28 digits, 6 of them decimals,
# leave the sum 38 digits: no group of fewer than 10**10 rows can overflow.
AMOUNT = "decimal(28,6)"


def exact_sum(value: str | Column) -> Column:
    """Sum of an amount in decimal arithmetic, the same in every order of the rows."""
    return F.sum((F.col(value) if isinstance(value, str) else value).cast(AMOUNT))


def sum_sign_flag(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """``CASE WHEN SUM(value) > 0 THEN 1 ELSE 0 END`` per key, exact."""
    return df.groupBy(key).agg(flag(exact_sum(value) > 0).alias(alias))


def pivot_max(df: DataFrame, key: str, pivot_col: str, value: str,
              columns: Mapping[str, str], default=None) -> DataFrame:
    """One column per listed pivot value holding ``max(value)``.

    Written as ``max(CASE WHEN pivot = v THEN value END)`` so the listed values
    fix the output schema (no distinct pass over the data, as an unlisted
    ``pivot`` would need).
    """
    aggs = []
    for v, name in columns.items():
        m = F.max(F.when(F.col(pivot_col) == F.lit(v), F.col(value)))
        aggs.append((F.coalesce(m, F.lit(default)) if default is not None else m).alias(name))
    return df.groupBy(key).agg(*aggs)


def account_mix(df: DataFrame, keys: Sequence[str], product: str, account: str,
                on_flag: str, young_flag: str, easy_flag: str, total_flag: str,
                extra: Sequence[Column] = ()) -> DataFrame:
    """Per holder: distinct accounts, accounts per family, all-ON/young flag.

    ``count(distinct product, account)`` skips pairs with a NULL part, as SQL does.
    """
    return df.groupBy(*keys).agg(
        *extra,
        F.count_distinct(F.col(product), F.col(account)).alias("NUMERO_CUENTAS"),
        F.sum(on_flag).alias("NUMERO_CUENTAS_ON"),
        F.sum(young_flag).alias("NUMERO_CUENTAS_JOVEN"),
        F.sum(easy_flag).alias("NUMERO_CUENTAS_FACIL"),
        flag(F.sum(F.col(young_flag) + F.col(on_flag)) == F.sum(total_flag))
        .alias("INDICADOR_TODAS_ONJOVEN"),
    )
