"""Column-level helpers: every one returns a built-in Spark ``Column``.

They stay inside whole-stage codegen (no Python UDF anywhere), so they are
safe in the hot path of a 100 TB scan.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean condition -> int 1/0 (NULL condition -> 0, as CASE WHEN does)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def if_null(c: str | Column, default) -> Column:
    """``CASE WHEN isnull(c) THEN default ELSE c END`` with a typed default."""
    return F.coalesce(col(c), F.lit(default))


def empty_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(""))


def active(end_col: str = "ffigco") -> Column:
    """A record without end date is still in force."""
    return F.col(end_col).isNull()


def live_contract(entity: int = P.ENTITY, status: int = P.STATUS_ACTIVE,
                  with_feigfi: bool = True) -> Column:
    """Entity, status and open-ended predicate shared by every contract table."""
    cond = (F.col("xcoemp") == entity) & (F.col("cosiig") == status) & active("ffigco")
    if with_feigfi:
        cond = cond & F.col("feigfi").isNull()
    return cond


def snapshot_is(value: str) -> Column:
    return F.col("snapshot") == F.lit(value)


def strip_leading_zeros(c: str | Column) -> Column:
    """'0020' -> '20'; '000' -> '' (so an all-zero code never matches)."""
    return F.regexp_replace(col(c), r"^0+", "")


def as_int_code(c: str | Column) -> Column:
    """Zero-padded text code -> int; text that is no number gives NULL."""
    return col(c).try_cast("int")


def code_label(c: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Map a code through a literal map; unmapped or NULL codes give ``default``.

    The map is one literal expression (``try_element_at(map(...), code)``), so the
    lookup costs no join and no shuffle whatever the size of the input.
    """
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = F.try_element_at(m, col(c))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def language_label(c: str | Column) -> Column:
    return code_label(c, P.LANGUAGE_LABELS, P.LANGUAGE_DEFAULT)


def insurer_name(tax_id: str | Column) -> Column:
    return code_label(tax_id, P.INSURER_BY_TAX_ID)


def tax_id_of(c: str | Column) -> Column:
    """Characters 8..21 of the mandate identifier (the creditor's tax id)."""
    return F.substring(col(c), P.TAX_ID_START, P.TAX_ID_LEN)


def like_any(c: str | Column, patterns: Iterable[str]) -> Column:
    c = col(c)
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def like_none(c: str | Column, patterns: Iterable[str]) -> Column:
    c = col(c)
    return reduce(lambda a, b: a & b, [~c.like(p) for p in patterns])


def classify_text(c: str | Column, include: Iterable[str], exclude: Iterable[str],
                  label: str) -> Column:
    """``label`` when the text matches any include and no exclude pattern, else NULL."""
    return F.when(like_any(c, include) & like_none(c, exclude), F.lit(label))


def home_receipt_label(text: str | Column) -> Column:
    return classify_text(text, P.HOME_INCLUDE_PATTERNS, P.HOME_EXCLUDE_PATTERNS, P.HOME_LABEL)


def concat_key(*cols: str | Column, sep: str = "") -> Column:
    """Concatenate key parts as text; NULL if any part is NULL (Hive ``concat``)."""
    parts = [col(c).cast("string") for c in cols]
    if sep:
        parts = [x for p in parts for x in (p, F.lit(sep))][:-1]
    return F.concat(*parts)


def account_hash(*cols: str | Column, sep: str = "") -> Column:
    """md5 pseudonym of an account key (NULL in -> NULL out)."""
    return F.md5(concat_key(*cols, sep=sep))


def last_chars(c: str | Column, n: int = 4) -> Column:
    """Last ``n`` characters (``substring(s, -n)``)."""
    return F.substring(col(c), -n, n)


def add_months(c: str | Column, months: int, month_end: str = "last_day") -> Column:
    """``add_months`` with an explicit month-end rule.

    ``last_day`` (Hive, where the rules run): a month-end date stays at month
    end, 2019-02-28 + 12 -> 2020-02-29.
    ``clamp`` (Spark / DuckDB): 2019-02-28 + 12 -> 2020-02-28.
    """
    shifted = F.add_months(col(c), months)
    if month_end == "clamp":
        return shifted
    if month_end == "last_day":
        return F.when(col(c) == F.last_day(col(c)), F.last_day(shifted)).otherwise(shifted)
    raise ValueError(month_end)


def date_key(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    return F.date_format(col(c), fmt)


