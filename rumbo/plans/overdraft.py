"""Overdraft datasets: the master list and the new-overdraft journey."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import account_hash, flag
from ..operators import accounts, dedupe, scoring
from ..operators.reuse import reuse


def overdraft_master(src, as_of: _dt.date, compare_abs: bool = False, history: DataFrame | None = None) -> DataFrame:
    """Every account overdrawn yesterday, of a natural-person principal holder,
    with days overdrawn (dropped when no non-negative day in the last 15),
    loan / card cover and payroll-advance flags.

    ``compare_abs`` compares limits with the overdrawn amount instead of the
    (negative) balance; the rule as written compares with the balance.
    ``history`` gives the last non-negative days from carried state
    (``streaming.balance_state``) in place of the 15 partitions.
    """
    bal = src.account_balance
    a = accounts.overdrawn_accounts(bal, as_of).select(
        F.col("fevaig").alias("FECHA_DESCUBIERTO"), F.col("cavt20").alias("SALDO_HOY"), *accounts.ACCOUNT_KEY)
    holders = accounts.principal_holders(src.contracts).withColumnRenamed("copemk", "CODIGO_PERSONA")
    a = a.join(holders, accounts.CONTRACT_KEY, "inner")
    a = a.join(accounts.natural_persons(src.person_board),
               a.CODIGO_PERSONA == F.col("copemk"), "left_semi")
    a = reuse(a)                        # read by the history, loan and card branches
    lp = accounts.last_positive_day(bal, as_of, accounts=a) if history is None else history
    lp = lp.withColumnRenamed("copemk", "CODIGO_PERSONA")
    # NUM_DIAS_DESCUBIERTO IS NOT NULL keeps only accounts with a positive day.
    a = a.join(lp, ["CODIGO_PERSONA", *accounts.ACCOUNT_KEY], "inner")
    a = a.withColumn("NUM_DIAS_DESCUBIERTO", F.datediff("FECHA_DESCUBIERTO", "MAX_DIA_SALDO_POSITIVO"))
    who = a.select("CODIGO_PERSONA")
    loans = accounts.preapproved_loans(src.loans, who).withColumnRenamed("copemk", "__lc")
    cards = accounts.best_credit_card_limit(src.cards, who).withColumnRenamed("copemk", "__cc")
    j = (a.join(loans, a.CODIGO_PERSONA == loans.__lc, "left")
         .join(cards, a.CODIGO_PERSONA == cards.__cc, "left"))
    amount = -F.col("SALDO_HOY") if compare_abs else F.col("SALDO_HOY")
    return j.select(
        "CODIGO_PERSONA", F.col("idprig").alias("C0"), F.col("NUM_DIAS_DESCUBIERTO").alias("C1"),
        flag((F.col("IMPORTE_LPP") >= amount) & (F.col("VIGENCIA_LPP") > F.col("FECHA_DESCUBIERTO"))).alias("C2"),
        flag(F.col("MAX_LIMITE_DISPONIBLE_TARJ_CRED") >= amount).alias("C3"),
        F.coalesce(F.col("IND_ANTICIPO_NOMINA"), F.lit(0)).alias("C4"),
        account_hash("copser", "xcoemp", "idprig").alias("C5"),
        F.col("FECHA_DESCUBIERTO").alias("C6"))


def overdraft_journey(src, as_of: _dt.date, compare_abs: bool = False) -> DataFrame:
    """Customers entering overdraft yesterday (positive the day before): their
    deepest new overdraft, with cover and propensity indicators."""
    trig = reuse(accounts.overdraft_trigger(src.account_balance, src.contracts, src.person_board, as_of))
    worst = dedupe.worst_row_per_key(trig, ["ID_URSUS"], "IMPORTE_DESCUBIERTO",
                                     [F.col("CODIGO_CUENTA").asc_nulls_first(), F.col("idcoec").asc_nulls_first()])
    cover = accounts.total_balance_cover(trig, src.contracts, src.account_balance).withColumnRenamed("copemk", "__tc")
    who = trig.select("ID_URSUS")      # the day's new overdrafts: every enrichment is reduced to them first
    cards = accounts.best_credit_card_limit(src.cards, who).withColumnRenamed("copemk", "__cc")
    loans = accounts.preapproved_loans(src.loans, who).withColumnRenamed("copemk", "__lc")
    when = scoring.newest_threshold_date(src, as_of)
    prop_a = scoring.propensity_a(src.scores_a, src.model_thresholds, [P.OVERDRAFT_MODEL_SCORES_A],
                                  "__pa", "PROPENSION_LPP_SAS", when, ids=who)
    prop_b = scoring.propensity_b(src.scores_b, src.model_thresholds, [P.OVERDRAFT_MODEL_SCORES_B],
                                  "__pb", "PROPENSION_LPP_BD", when, ids=who)
    w = worst
    j = (w.join(cover, w.ID_URSUS == cover.__tc, "left")
         .join(cards, w.ID_URSUS == cards.__cc, "left")
         .join(loans, w.ID_URSUS == loans.__lc, "left")
         .join(prop_a, w.ID_URSUS == prop_a.__pa, "left")
         .join(prop_b, w.ID_URSUS == prop_b.__pb, "left"))
    amount = -F.col("IMPORTE_DESCUBIERTO") if compare_abs else F.col("IMPORTE_DESCUBIERTO")
    return j.select(
        "ID_URSUS", F.col("NUMERO_CUENTA").alias("C0"),
        F.col("IND_SALDO_TOTAL_CUENTAS_CUBRE_DESCUBIERTO").alias("C1"),
        F.col("IND_SERV_DESCUBIERTO_CUBRE").alias("C2"),
        flag(F.col("MAX_LIMITE_DISPONIBLE_TARJ_CRED") > amount).alias("C3"),
        flag((F.col("IMPORTE_LPP") >= amount) & (F.col("VIGENCIA_LPP") > F.col("FECHA_DESCUBIERTO"))).alias("C4"),
        flag((F.col("PROPENSION_LPP_SAS") == 1) | (F.col("PROPENSION_LPP_BD") == 1)).alias("C5"),
        F.coalesce(F.col("IND_ANTICIPO_NOMINA"), F.lit(0)).alias("C6"),
        F.md5("CODIGO_CUENTA").alias("C7"))
