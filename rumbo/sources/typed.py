"""Typed source contract: declared types, safe casts and a quarantine.

The rules compare one column as a number in one place and as padded text in
another, and read amounts whose sums are held against limits.  The warehouse does not
promise types, so a typed source does:

* every column that a rule reads has one declared type (:func:`declared`); codes are
  integers, amounts are decimals, days are dates, the rest is text;
* a column that comes in another type is trimmed and cast with ``try_cast``; a
  column that comes in its declared type is passed through untouched, so its
  filters still reach the Parquet scan and prune partitions;
* a row with a value that does not fit its declared type, or without a value
  that its table needs, is not read by the rules: :meth:`TypedSources.table`
  leaves it out and :meth:`TypedSources.quarantine` gives it with the columns that
  failed, why, and the row as it came.

``TypedSources`` wraps any sources; journeys run on it unchanged.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import write_run

# FIXED VALUES: declared type of each column, by name.  Columns not named are text.
INTEGERS = ("xcoemp copser cosiig inz120 inz121 inz122 cox1b7 inanom cotpmk coh004 caedad edad_cliente entidad id_canal_preferido "
            "id_cartera id_tipo_persona ind_banca_personal ind_banca_privada ind_banca_virtual ind_correspondencia_internet "
            "coocda qcopc3 codsi7 colnng cosgri")
NUMBERS = "copemk casfpt id_cliente id_gestor cogrmk cogsmk idpers co_cliente cope14 co_codpers_mt"
DAYS = ("fevaig feigfi ffigco fiigco fecaig feopen feclpp fenac9 fecha_derivado fc_nacimiento fc_fallecimiento_disolucion "
        "ffcpmk qfaope feprnz")
AMOUNTS = "cavt20 imlimk cacv7j imlppm cacv0d porcpa qmnopd imd2c0 im_saldfinmestotvolrecur_mt imulig"
SCORES = "nupropen probabilidad nupropenmin"
# Tables in which a column has another type.
IN_TABLE = {("policies", "copser"): "string", ("account_domiciliations", "copser"): "string", ("payroll_amounts", "copser"): "string",
            ("customer_attrs", "cogsmk"): "string", ("customers_daily", "dt"): "int", ("dictionary_attrs", "codamk"): "int"}
# A table needs a value in those of these columns that it has.
NEEDED = ("xcoemp", "copser", "idprig", "copemk", "id_cliente", "idpers", "co_cliente", "cope14")

AMOUNT_DIGITS, AMOUNT_DECIMALS = 18, 2

_KINDS = {**dict.fromkeys(INTEGERS.split(), "int"), **dict.fromkeys(NUMBERS.split(), "bigint"), **dict.fromkeys(DAYS.split(), "date"),
          **dict.fromkeys(AMOUNTS.split(), "amount"), **dict.fromkeys(SCORES.split(), "double")}


def declared(table: str, column: str, decimals: int = AMOUNT_DECIMALS) -> T.DataType:
    """The declared type of a column of a table."""
    kind = IN_TABLE.get((table, column), _KINDS.get(column, "string"))
    return T.DecimalType(AMOUNT_DIGITS, decimals) if kind == "amount" else T.DataType.fromDDL(kind)


class TypedSources:
    """``base``'s tables in their declared types, without the rows that do not fit them.

    ``decimals`` of the amounts; ``needed`` overrides the columns that a table must have values in.
    """

    def __init__(self, base, decimals: int = AMOUNT_DECIMALS, needed: Mapping[str, Sequence[str]] | None = None):
        self.base, self.decimals, self.needed = base, decimals, needed or {}
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str):
        if name.startswith("_") or name in ("base", "needed"):
            raise AttributeError(name)
        own = getattr(self.base, name)
        if not isinstance(own, DataFrame):          # the base's metadata: newest, partitions, marks, ...
            return own
        return self.table(name)

    def _cast(self, name: str, raw: DataFrame, column: str) -> Column | None:
        """The column in its declared type, or None where it has that type already."""
        kind, have = declared(name, column, self.decimals), raw.schema[column].dataType
        if have == kind:
            return None
        c = F.col(f"`{column}`")
        if isinstance(kind, T.StringType):
            return c.cast("string")
        if isinstance(have, T.StringType):
            return F.trim(c).try_cast(kind)
        return c.try_cast(kind)

    def _faults(self, name: str, raw: DataFrame) -> dict[str, Column]:
        """Per column that can fail: the reason as text, null where the value is good."""
        needed = self.needed.get(name, [c for c in NEEDED if c in raw.columns])
        out: dict[str, Column] = {}
        for f in raw.schema.fields:
            c, cast = F.col(f"`{f.name}`"), self._cast(name, raw, f.name)
            reason = None
            if cast is not None and not isinstance(declared(name, f.name, self.decimals), T.StringType):
                blank = c.isNull() | (F.trim(c) == "") if isinstance(f.dataType, T.StringType) else c.isNull()
                reason = F.when(~blank & cast.isNull(), F.lit("type"))
                if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType):
                    # a number that needs more decimals than declared would be rounded; a double's own
                    # error in its last bits is far below a hundredth of the last decimal
                    decimals = kind.scale if isinstance(kind := declared(name, f.name, self.decimals), T.DecimalType) else 0
                    lost = F.abs(cast.cast("double") - c) > F.lit(10.0 ** -(decimals + 2))
                    reason = reason.when(cast.isNotNull() & lost, F.lit("precision"))
                if f.name in needed:
                    reason = reason.when(blank, F.lit("missing"))
            elif f.name in needed:
                reason = F.when(c.isNull(), F.lit("missing"))
            if reason is not None:
                out[f.name] = reason
        return out

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            raw = getattr(self.base, name)
            faults = self._faults(name, raw)
            good = raw.filter(reduce(lambda a, b: a & b, [r.isNull() for r in faults.values()])) if faults else raw
            casts = {f.name: self._cast(name, raw, f.name) for f in raw.schema.fields}
            self._cache[name] = good.select(*[F.col(f"`{c}`") if x is None else x.alias(c) for c, x in casts.items()])
        return self._cache[name]

    def quarantine(self, name: str) -> DataFrame:
        """``(table_name, faults, row)`` of the rows that :meth:`table` leaves out.

        ``faults``: array of ``(column, reason, value)``, reason ``type`` (the value does not fit),
        ``precision`` (an amount has more decimals than declared) or ``missing``; ``row``: the row as JSON.
        """
        raw = getattr(self.base, name)
        cells = [F.when(reason.isNotNull(), F.struct(F.lit(c).alias("column"), reason.alias("reason"),
                                                     F.col(f"`{c}`").cast("string").alias("value")))
                 for c, reason in self._faults(name, raw).items()]
        kind = "array<struct<column: string, reason: string, value: string>>"
        faults = F.filter(F.array(*cells), lambda x: x.isNotNull()) if cells else F.array()
        return raw.select(F.lit(name).alias("table_name"), faults.cast(kind).alias("faults"), F.to_json(F.struct("*")).alias("row")).filter(
            F.size("faults") > 0)

    def write_quarantine(self, names: Sequence[str], path: str, as_of: _dt.date) -> None:
        """Write the quarantined rows of some tables as the ``as_of`` partition of ``path``; a re-run replaces it."""
        rows = reduce(DataFrame.unionByName, [self.quarantine(n) for n in names])
        write_run(rows, path, as_of)
