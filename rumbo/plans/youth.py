"""Young-customer retention: account holders who turn 26 within 30 days."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import flag
from ..operators import agg, joins, people
from ..operators.reuse import reuse


def young_retention(src, as_of: _dt.date, month_end: str = "last_day") -> DataFrame:
    """One row per holder (and grain columns) with programme, payroll, digital
    and account-mix indicators.

    Exclusions: accounts whose holder fails a programme criterion, and holders
    with a digital profile who also hold a non-"easy" account.  Only holders
    reaching the milestone age remain.
    """
    all_x = people.youth_accounts(src, as_of)
    y = people.milestone_birthdays(src.person_board, as_of, month_end)
    # Only holders reaching the milestone survive (inner join with y), so the
    # exclusions are computed for them alone: x = their account rows, and the
    # failing-criteria exclusion looks at every principal holder of those
    # accounts (the holders all_x would list for them, read from the contracts).
    x = reuse(all_x.join(y.select(F.col("copemk").alias("tt")), "tt", "left_semi"))
    x_accounts = people.principal_rows(src.contracts).join(     # both sides are entity 0
        x.select("copser", "idprig"), ["copser", "idprig"], "left_semi")
    newest = people.programme_newest(src, as_of)
    z = people.programme_rows(src, as_of, passing=True, newest=newest).select(
        F.col("copemk").alias("__z"), F.col("marin6").alias("dom_ingresos_pst"),
        F.col("marin3").alias("accionistas_pst"), F.col("marin5").alias("racs_pst"),
        F.col("marin1").alias("joven_menos_18_pst"), F.col("marin2").alias("joven_18_25_pst"))
    payroll = people.live_payroll(src.payroll_contracts).join(
        x.select(F.col("tt").alias("copemk")), "copemk", "left_semi")
    u = joins.presence(payroll, "copemk", "INDICADOR_DOMICILIACION_INGRESOS_D", as_key="__u")
    digital = people.digital_profiles(src, as_of)
    v = (digital.join(x.select(F.col("tt").alias("id_cliente")), "id_cliente", "left_semi")
         .select(F.col("id_cliente").alias("__v")).withColumn("PERFIL_DIGITAL", F.lit(1)))
    failing = people.programme_rows(src, as_of, passing=False, newest=newest, distinct=False).select(
        F.col("copemk").alias("tt"))
    w = x_accounts.join(failing, "tt", "inner").select("copser", "idprig")        # anti-join keys
    t = (x.filter(F.col("cuenta_facil") == 0).join(digital, x.tt == digital.id_cliente, "inner")
         .select("tt"))

    base = joins.anti(x, w, ["copser", "idprig"])
    base = joins.anti(base, t, ["tt"])
    base = base.join(y, base.tt == y.copemk, "inner").drop("copemk")
    j = (base.join(z, base.tt == z.__z, "left")
         .join(u, base.tt == u.__u, "left")
         .join(v, base.tt == v.__v, "left"))
    grain = ["Persona", "fecha_nacimiento", "saldo_RACs", "edad", "dom_ingresos_pst", "accionistas_pst",
             "racs_pst", "joven_menos_18_pst", "joven_18_25_pst", "INDICADOR_DOMICILIACION_INGRESOS_D",
             "PERFIL_DIGITAL"]
    g = agg.account_mix(j, grain, "copser", "idprig", "cuenta_on", "cuenta_joven", "cuenta_facil", "total_cuentas")
    return g.select(
        F.col("Persona").alias("ID_URSUS"), F.lit(P.JOURNEY_YOUNG).alias("CODIGO_JOURNEY"),
        F.col("fecha_nacimiento").alias("FECHA_NACIMIENTO"), F.col("saldo_RACs").alias("IMPORTE_RECURSOS"),
        F.col("dom_ingresos_pst").alias("INDICADOR_INGRESOS_DOMICILIADOS_PST"),
        F.col("accionistas_pst").alias("INDICADOR_ACCIONISTA_PST"),
        F.col("racs_pst").alias("INDICADOR_RACS_PST"),
        F.col("joven_menos_18_pst").alias("INDICADOR_JOVEN_MENOR18_PST"),
        F.col("joven_18_25_pst").alias("INDICADOR_JOVEN_1825_PST"),
        flag(F.col("INDICADOR_DOMICILIACION_INGRESOS_D") == 1).alias("INDICADOR_DOMICILIACION_INGRESOS_DIARIO"),
        flag(F.col("PERFIL_DIGITAL") == 1).alias("INDICADOR_PERFIL_DIGITAL"),
        "NUMERO_CUENTAS", "NUMERO_CUENTAS_ON", "NUMERO_CUENTAS_JOVEN", "NUMERO_CUENTAS_FACIL",
        "INDICADOR_TODAS_ONJOVEN")
