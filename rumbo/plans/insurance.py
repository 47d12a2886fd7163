"""Home-insurance expiry: customers paying a competitor's home policy that
expires in two months."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..operators import accounts, insurance, joins
from ..operators.reuse import reuse


def home_insurance_expiry(src, as_of: _dt.date, month_end: str = "last_day", strict_home: bool = False,
                          home_label: str = P.HOME_LABEL, exclusion_insurers: tuple[str, ...] = P.HOME_EXCLUSION_INSURERS) -> DataFrame:
    """One row per (person, expiry date) with own-policy indicators.

    Drops persons already insured at home through the listed insurers, keeps
    receipts classified as home insurance with a description of at least
    ``RECEIPT_MIN_TEXT`` characters, active natural persons only.

    As the rule is written, SEGURO_HOGAR_CONTRATADO is 1 for holders of any own policy;
    ``strict_home`` asks for an own home policy.  ``home_label`` names home receipts
    and ``exclusion_insurers`` the insurers whose customers with an own home policy are dropped.
    """
    trig = reuse(insurance.expiring_receipts(src.receipts, as_of, month_end, home_label))
    excluded = insurance.already_insured(trig, src.policies, exclusion_insurers)
    flags = insurance.policy_flags(src.policies, persons=trig.select("Persona")).withColumnRenamed("Persona", "__p")
    a = joins.anti(trig, excluded, ["Persona"])
    a = a.filter(F.col("RAMO").isNotNull() & (F.length("Concepto") >= P.RECEIPT_MIN_TEXT))
    a = a.join(accounts.natural_persons(src.person_board, active_only=True),
               a.Persona == F.col("copemk"), "left_semi")
    a = a.select("Persona", "FECHA_VENCIMIENTO").distinct()
    j = a.join(flags, a.Persona == flags.__p, "left")
    return j.select(
        F.col("Persona").alias("PERSONA"), "FECHA_VENCIMIENTO",
        (F.coalesce("SEGURO_HOGAR", F.lit(0)) if strict_home else F.when(F.col("SEGURO_HOGAR").isNull(), 0).otherwise(1))
        .alias("SEGURO_HOGAR_CONTRATADO"),
        F.coalesce("SEGURO_SALUD_MAYOR_200", F.lit(0)).alias("SEGURO_SALUD_MAYOR_200"),
        F.coalesce("SEGURO_AUTO_MAYOR_120", F.lit(0)).alias("SEGURO_AUTO_MAYOR_120"),
        F.coalesce("SEGURO_DECESOS_MAYOR_60", F.lit(0)).alias("SEGURO_DECESOS_MAYOR_60"))
