"""Insurance operators: expiring competitor receipts and own-policy flags."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import add_months, classify_text, flag, insurer_name, snapshot_is, tax_id_of
from . import observe


def expiring_receipts(receipts: DataFrame, as_of: _dt.date, month_end: str = "last_day", home_label: str = P.HOME_LABEL) -> DataFrame:
    """Prepaid insurance receipts paid exactly ``RECEIPT_AGE_MONTHS`` ago.

    Output: Persona, FECHA_VENCIMIENTO (+12 months), Concepto (text without
    commas), COMPANIA (insurer from the creditor tax id), RAMO (``home_label``
    for home receipts, else NULL).
    """
    paid = F.to_date("qfaope")
    tax_id = tax_id_of("idprac")
    cond = ((F.datediff(F.lit(as_of), paid) <= P.RECEIPT_MAX_AGE_DAYS)
            & (F.col("qcacc7") == P.RECEIPT_PREPAID) & F.col("qcspc1").isin(*P.RECEIPT_TYPES)
            & snapshot_is(P.SNAPSHOT_LATEST) & tax_id.isin(*P.INSURER_TAX_IDS_ALLOWED)
            & (F.col("cope14") != 0) & (F.col("qcopc3") == P.RECEIPT_OPERATION)
            & (F.col("qmnopd") > P.RECEIPT_MIN_AMOUNT)
            & (F.col("qfaope") == add_months(F.lit(as_of), -P.RECEIPT_AGE_MONTHS, month_end)))
    text = F.concat("qncnes", "qncne1")
    out = receipts.filter(cond).select(
        F.col("cope14").alias("Persona"),
        add_months("qfaope", P.POLICY_TERM_MONTHS, month_end).alias("FECHA_VENCIMIENTO"),
        F.regexp_replace(text, ",", "").alias("Concepto"),
        insurer_name(tax_id).alias("COMPANIA"),
        classify_text(text, P.HOME_INCLUDE_PATTERNS, P.HOME_EXCLUDE_PATTERNS, home_label).alias("RAMO"))
    return observe.watch(out, "insurers", lambda got: f"{got['unnamed']} receipts of insurers without a name" if got["unnamed"] else None,
                         unnamed=F.count_if(F.col("COMPANIA").isNull()))


def own_policies(policies: DataFrame) -> DataFrame:
    """Live policies of the bank's own insurer."""
    return policies.filter(snapshot_is(P.SNAPSHOT_LATEST) & (F.col("xcoemp") == P.ENTITY)
                           & F.col("ffigco").isNull() & (F.col("cosiig") == P.STATUS_ACTIVE)
                           & (F.col("codsi7") == P.POLICY_OWN_COMPANY))


def policy_flags(policies: DataFrame, persons: DataFrame | None = None) -> DataFrame:
    """Per holder: max of the premium-threshold flags and a home-policy marker.

    Pre-aggregated per holder before joining, so a holder with many policies
    adds one row to the join (max distributes over the join).  ``persons``
    (first column) restricts the policies to those holders first.
    """
    p = own_policies(policies)
    if persons is not None:
        who = persons.select(F.col(persons.columns[0]).alias("__p"))
        p = p.join(who, p.copemk == who["__p"], "left_semi")
    amt, br = F.col("imd2c0"), F.col("colnng")
    return p.groupBy(F.col("copemk").alias("Persona")).agg(
        F.max(flag(br == P.POLICY_BRANCH_HOME)).alias("SEGURO_HOGAR"),
        F.max(flag((amt >= P.POLICY_MIN_HEALTH) & (br == P.POLICY_BRANCH_HEALTH))).alias("SEGURO_SALUD_MAYOR_200"),
        F.max(flag((amt >= P.POLICY_MIN_AUTO) & (br == P.POLICY_BRANCH_AUTO))).alias("SEGURO_AUTO_MAYOR_120"),
        F.max(flag((amt >= P.POLICY_MIN_FUNERAL) & (br == P.POLICY_BRANCH_FUNERAL)
                   & (F.col("cosgri") == P.POLICY_FUNERAL_GUARANTEE))).alias("SEGURO_DECESOS_MAYOR_60"))


def already_insured(trigger: DataFrame, policies: DataFrame,
                    insurers=P.HOME_EXCLUSION_INSURERS) -> DataFrame:
    """Trigger persons with a receipt from a listed insurer and an own home policy."""
    home = own_policies(policies).filter(F.col("colnng") == P.POLICY_BRANCH_HOME).select(
        F.col("copemk").alias("Persona"))
    return trigger.filter(F.col("COMPANIA").isin(*insurers)).select("Persona").join(home, "Persona", "left_semi")
