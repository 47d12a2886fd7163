"""Account, contract and balance operators (overdraft and ownership rules).

Inputs use the bank's column names: account key ``(xcoemp, copser, idcoec,
idprig)``, contract-to-account key ``(xcoemp, copser, idprig)``, holder
``copemk``, balance ``cavt20``, balance day ``fevaig``, partition
``(snapshot, extractiondate)``.  Partition predicates are plain comparisons
with literals, so Spark prunes partitions and pushes them to Parquet.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import (as_int_code, flag, live_contract, snapshot_is, strip_leading_zeros)
from . import agg, joins

ACCOUNT_KEY = ["xcoemp", "copser", "idcoec", "idprig"]
CONTRACT_KEY = ["xcoemp", "copser", "idprig"]


def day_key(d: _dt.date, offset_days: int = 0) -> str:
    """``date_format(date_sub(d, n), 'yyyyMMdd')`` computed once on the driver."""
    return (d - _dt.timedelta(days=offset_days)).strftime("%Y%m%d")


def balances_on(balances: DataFrame, as_of: _dt.date, days_back: int, snapshot: str,
                where: Column | None = None) -> DataFrame:
    """Live accounts of one daily partition (``extractiondate = as_of - n``)."""
    cond = (snapshot_is(snapshot) & (F.col("extractiondate") == day_key(as_of, days_back))
            & live_contract())
    return balances.filter(cond & where if where is not None else cond)


def overdrawn_accounts(balances: DataFrame, as_of: _dt.date) -> DataFrame:
    """Accounts with a negative balance yesterday (newest partition)."""
    return balances_on(balances, as_of, 1, P.SNAPSHOT_LATEST, F.col("cavt20") < 0)


def principal_holders(contracts: DataFrame) -> DataFrame:
    """Live principal-holder contract rows ``(copemk, xcoemp, copser, idprig)``."""
    cond = (snapshot_is(P.SNAPSHOT_LATEST) & (as_int_code("coprbs") == P.RELATION_PRINCIPAL)
            & (F.col("xcoemp") == P.ENTITY) & F.col("ffigco").isNull()
            & (F.col("cosiig") == P.STATUS_ACTIVE))
    return contracts.filter(cond).select("copemk", *CONTRACT_KEY)


def holder_contracts(contracts: DataFrame, holder_codes: DataFrame) -> DataFrame:
    """Live contracts whose zero-stripped relation code is a holder code."""
    codes = holder_codes.filter(snapshot_is(P.SNAPSHOT_LATEST)).select(
        F.col("coprbs").alias("__code"))
    live = contracts.filter(snapshot_is(P.SNAPSHOT_LATEST) & (F.col("xcoemp") == P.ENTITY)
                            & F.col("ffigco").isNull() & (F.col("cosiig") == P.STATUS_ACTIVE))
    return live.join(codes, strip_leading_zeros(live["coprbs"]) == codes["__code"], "left_semi")


def natural_persons(person_board: DataFrame, active_only: bool = False) -> DataFrame:
    """Person ids of natural persons (optionally only active customers)."""
    cond = snapshot_is(P.SNAPSHOT_LATEST) & (F.col("cotpmk") == P.PERSON_NATURAL)
    if active_only:
        cond = cond & (F.col("coh004") == P.PERSON_ACTIVE_CODE)
    return person_board.filter(cond).select("copemk")


def last_positive_day(balances: DataFrame, as_of: _dt.date,
                      days: int = P.OVERDRAFT_HISTORY_DAYS, accounts: DataFrame | None = None) -> DataFrame:
    """Newest day with a non-negative balance in the ``days`` days up to the run date, per account.

    ``accounts`` (rows with the account key) restricts the history to those
    accounts before aggregating: the window holds every account's days, the
    consumers only need yesterday's overdrawn ones.
    """
    hist = balances.filter(snapshot_is(P.SNAPSHOT_HISTORIC)
                           & (F.col("extractiondate") >= day_key(as_of, days))
                           & (F.col("extractiondate") <= day_key(as_of))
                           & (F.col("cavt20") >= 0) & live_contract())
    if accounts is not None:
        hist = hist.join(accounts.select(*ACCOUNT_KEY), ACCOUNT_KEY, "left_semi")
    return hist.groupBy("copemk", *ACCOUNT_KEY).agg(F.max("fevaig").alias("MAX_DIA_SALDO_POSITIVO"))


def positive_day_before(balances: DataFrame, as_of: _dt.date) -> DataFrame:
    """Accounts with a positive balance the day before yesterday."""
    return balances_on(balances, as_of, 2, P.SNAPSHOT_HISTORIC, F.col("cavt20") > 0).select(
        F.col("cavt20").alias("SALDO_AYER"), *ACCOUNT_KEY)


def new_overdrafts(balances: DataFrame, contracts: DataFrame, person_board: DataFrame,
                   as_of: _dt.date) -> DataFrame:
    """Accounts overdrawn yesterday and positive the day before, of natural persons.

    Output: holder ``ID_URSUS``, amounts, flags and the account key.
    """
    today = overdrawn_accounts(balances, as_of).select(
        F.col("cavt20").alias("IMPORTE_DESCUBIERTO"), F.col("fevaig").alias("FECHA_DESCUBIERTO"),
        F.col("inz120").alias("IND_RECEPTORA_NOMINA"), F.col("inz121").alias("IND_RECEPTORA_PENSION"),
        F.col("inz122").alias("IND_RECEPTORA_DESEMPLEO"),
        F.col("imlimk").alias("IMPORTE_LIMITE_DESCUBIERTO"), *ACCOUNT_KEY)
    holders = principal_holders(contracts).withColumnRenamed("copemk", "ID_URSUS")
    # LEFT JOIN + null-rejecting filters downstream == inner joins.
    a = today.join(holders, CONTRACT_KEY, "inner")
    a = a.join(positive_day_before(balances, as_of), ACCOUNT_KEY, "inner")
    a = joins.semi(a, natural_persons(person_board), [("ID_URSUS", "copemk")])
    return a


def overdraft_trigger(balances: DataFrame, contracts: DataFrame, person_board: DataFrame,
                      as_of: _dt.date) -> DataFrame:
    """The overdraft journey's trigger rows with their per-account indicators."""
    a = new_overdrafts(balances, contracts, person_board, as_of)
    return a.select(
        "ID_URSUS",
        F.concat(F.col("copser").cast("string"), F.col("xcoemp").cast("string"), F.col("idprig"))
        .alias("CODIGO_CUENTA"),
        F.substring("idprig", -4, 4).alias("NUMERO_CUENTA"),
        "IMPORTE_DESCUBIERTO",
        flag(F.col("IMPORTE_DESCUBIERTO") < 0).alias("IND_DESCUBIERTO"),
        flag(F.col("SALDO_AYER") >= 0).alias("IND_AYER_CUBIERTO"),
        "FECHA_DESCUBIERTO", "IND_RECEPTORA_NOMINA", "IND_RECEPTORA_PENSION", "IND_RECEPTORA_DESEMPLEO",
        flag(F.col("IMPORTE_LIMITE_DESCUBIERTO") >= F.col("IMPORTE_DESCUBIERTO")).alias("IND_SERV_DESCUBIERTO_CUBRE"),
        *ACCOUNT_KEY)


def total_balance_cover(trigger: DataFrame, contracts: DataFrame, balances: DataFrame,
                        id_col: str = "ID_URSUS") -> DataFrame:
    """Per trigger customer: 1 when the sum of all their live accounts is positive.

    The trigger is reduced to distinct customers first, so a customer with k
    trigger rows is summed once (same sign as the k-fold sum).
    """
    who = trigger.select(F.col(id_col).alias("copemk"))
    owned = principal_holders(contracts).join(who, "copemk", "left_semi")
    live = balances.filter(snapshot_is(P.SNAPSHOT_LATEST) & live_contract()).select(*CONTRACT_KEY, "cavt20")
    j = owned.join(live, CONTRACT_KEY, "left")
    return agg.sum_sign_flag(j, "copemk", "cavt20", "IND_SALDO_TOTAL_CUENTAS_CUBRE_DESCUBIERTO")


def _only(df: DataFrame, holders: DataFrame | None, key: str = "copemk") -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``holders`` (first column), if given.

    Used before per-holder aggregations whose result is only joined to a small
    trigger: the semi join (broadcast by AQE when the trigger is small) drops
    the other holders' rows before the shuffle.
    """
    if holders is None:
        return df
    ids = holders.select(F.col(holders.columns[0]).alias("__h"))   # a semi join needs no distinct keys
    return df.join(ids, df[key] == ids["__h"], "left_semi")


def best_credit_card_limit(cards: DataFrame, holders: DataFrame | None = None) -> DataFrame:
    """Max available limit over live credit cards owned 100 %, per holder."""
    cond = (snapshot_is(P.SNAPSHOT_LATEST) & (F.col("cacv0d") > 0) & live_contract()
            & (F.trim("titar3") == P.CARD_TYPE_CREDIT) & (F.col("porcpa") == P.CARD_OWNERSHIP_FULL))
    return _only(cards.filter(cond), holders).groupBy("copemk").agg(F.max("cacv0d").alias("MAX_LIMITE_DISPONIBLE_TARJ_CRED"))


def preapproved_loans(loans: DataFrame, holders: DataFrame | None = None) -> DataFrame:
    """Live pre-approved loans per (holder, amount, payroll code): validity and flag.

    Grouped as the rule was written, so a holder with several amounts or
    payroll codes has several rows.
    """
    cond = (snapshot_is(P.SNAPSHOT_LATEST) & live_contract()
            & (F.trim("coelpp") == P.LOAN_STATE) & (F.trim("coespq") == P.LOAN_SUBSTATE)
            & (F.trim("cdtcls") != P.LOAN_EXCLUDED_CLASS) & (F.col("copser") == P.LOAN_PRODUCT))
    g = _only(loans.filter(cond), holders).groupBy("copemk", "imlppm", "inanom").agg(F.max("feclpp").alias("VIGENCIA_LPP"))
    return g.select("copemk", F.col("imlppm").alias("IMPORTE_LPP"), "VIGENCIA_LPP",
                    flag(F.col("inanom").isin(*P.PAYROLL_ADVANCE_CODES)).alias("IND_ANTICIPO_NOMINA"))


def owners_of(product_contracts: DataFrame, contracts: DataFrame, holder_codes: DataFrame,
              holders: DataFrame | None = None) -> DataFrame:
    """``(copemk, copser, idcoec, idprig, xcoemp)`` per live product account and holder.

    A ``LEFT JOIN`` to holder contracts: accounts without a holder contract
    give a NULL holder (kept, as written).  With ``holders`` only those
    holders' rows are produced (NULL-holder rows can never match a holder, so
    they are not produced either).
    """
    key = ["copser", "idcoec", "idprig", "xcoemp"]
    live = product_contracts.filter(snapshot_is(P.SNAPSHOT_LATEST) & live_contract()).select(*key)
    hc = _only(holder_contracts(contracts, holder_codes), holders).select(
        F.col("copemk"), F.col("copser").alias("__s"), F.col("idprig").alias("__p"), F.col("xcoemp").alias("__e"))
    how = "left" if holders is None else "inner"
    j = live.join(hc, (live.copser == hc.__s) & (live.idprig == hc.__p) & (live.xcoemp == hc.__e), how)
    return j.select("copemk", *key)


def yearly_contributions(operations: DataFrame, as_of: _dt.date, accounts: DataFrame | None = None) -> DataFrame:
    """Sum of contribution operations dated in the run year, per plan account
    (optionally only for the given plan accounts); a decimal, exact in any order."""
    year = as_of.year
    cond = ((F.col("xcoemp") == P.ENTITY) & F.col("cox1b7").isin(*P.CONTRIBUTION_OPERATION_TYPES)
            & ((F.year("fecaig") == year) | (F.year("feopen") == year)))
    ops = operations.filter(cond)
    if accounts is not None:
        key = ["copser", "idcoec", "idprig", "xcoemp"]
        ops = ops.join(accounts.select(*key), key, "left_semi")
    return ops.groupBy("copser", "idcoec", "idprig", "xcoemp").agg(
        agg.exact_sum("cacv7j").alias("APORTACION_ANUAL"))


def days_overdrawn(balances: DataFrame, as_of: _dt.date) -> DataFrame:
    """Per account overdrawn yesterday: days since its last non-negative day
    in the window (accounts without one are dropped)."""
    od = overdrawn_accounts(balances, as_of).select(
        "copemk", *ACCOUNT_KEY, F.col("fevaig").alias("FECHA_DESCUBIERTO"), F.col("cavt20").alias("SALDO_HOY"))
    lp = last_positive_day(balances, as_of, accounts=od)
    j = od.join(lp, ["copemk", *ACCOUNT_KEY], "inner")
    return j.select("copemk", "idprig", "FECHA_DESCUBIERTO", "SALDO_HOY", "MAX_DIA_SALDO_POSITIVO",
                    F.datediff("FECHA_DESCUBIERTO", "MAX_DIA_SALDO_POSITIVO").alias("NUM_DIAS_DESCUBIERTO"))
