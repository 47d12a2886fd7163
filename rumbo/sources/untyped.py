"""The stand-ins as an untyped extract would bring them: text columns, padding, and values that do not fit.

Rules (over every row of the stand-in tables): codes, days and amounts come as text; codes are
zero-padded or followed by blanks; by the account number or customer, some rows have a code, day
or amount that is no such value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Remainders of the account number (or customer) whose rows have a value that does not fit.
BAD_CODE, BAD_DAY, BAD_AMOUNT, NO_HOLDER = 3, 11, 5, 17


def _number(column: str) -> Column:
    """The digits of an account number."""
    return F.col(column).cast("bigint")


def _code(column: str, width: int) -> Column:
    """A code as zero-padded text with a trailing blank."""
    return F.concat(F.lpad(F.col(column).cast("string"), width, "0"), F.lit(" "))


class UntypedStandins:
    """``contracts``, ``account_balance`` and ``plan_operations`` as text; the other tables as they are."""

    def __init__(self, base):
        self.base = base

    def __getattr__(self, name: str):
        if name.startswith("_") or name == "base":
            raise AttributeError(name)
        return getattr(self.base, name)

    @property
    def contracts(self) -> DataFrame:
        n = F.pmod(_number("idprig"), F.lit(40))
        return self.base.contracts.withColumns({
            "copser": F.when(n == BAD_CODE, F.lit("S/N")).otherwise(_code("copser", 8)),
            "cosiig": _code("cosiig", 5), "xcoemp": _code("xcoemp", 4),
            "fiigco": F.when(n == BAD_DAY, F.lit("0001-99-99")).otherwise(F.col("fiigco").cast("string")),
            "copemk": F.when(n == NO_HOLDER, F.lit("  ")).otherwise(F.col("copemk").cast("string"))})

    @property
    def account_balance(self) -> DataFrame:
        n = F.pmod(F.col("copemk"), F.lit(40))
        return self.base.account_balance.withColumns({
            "copser": _code("copser", 8),
            "cavt20": F.when(n == BAD_AMOUNT, F.lit("12.345,00")).otherwise(F.concat(F.lit(" "), F.col("cavt20").cast("decimal(18,2)").cast("string")))})

    @property
    def plan_operations(self) -> DataFrame:
        n = F.pmod(_number("idprig"), F.lit(40))
        return self.base.plan_operations.withColumns({
            "cox1b7": _code("cox1b7", 3),
            "cacv7j": F.when(n == BAD_AMOUNT, F.lit("N/D")).otherwise(F.col("cacv7j").cast("decimal(18,4)").cast("string"))})
