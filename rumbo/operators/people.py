"""Customer-level operators: customer master, managers, youth rules."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import add_months, empty_if_null, flag, if_null, language_label, snapshot_is
from . import control, dedupe

CUSTOMER_COLUMNS = [
    "tfno_movil", "tenencia_email", "nombre", "edad_cliente", "entidad", "fecha_nacimiento",
    "canal_preferido", "indConectaTuExperto", "idcliente", "codigopostal", "idgestor",
    "idioma_preferencia", "oficina", "segmento_socieco", "segmento_estrval", "tipo_persona",
    "indbancapersonal", "indbancaprivada", "indbancavirtual", "indclasifactividad", "prefijo_mv",
    "tfno_fijo", "fecha_fallecimiento",
]


def clean_customers(customers: DataFrame) -> DataFrame:
    """Contact fields with defaults, language label and flags (one row per input row)."""
    mobile = F.coalesce("telefono_movil_1", "telefono_movil_2")
    prefix = F.coalesce("prefijo_telefono_movil_1", "prefijo_telefono_movil_2")
    email = F.col("ds_email")
    return customers.select(
        empty_if_null(mobile).alias("tfno_movil"),
        F.when(email.isNull() | (email == ""), F.lit("NO")).otherwise(email).alias("tenencia_email"),
        F.col("ds_nombre").alias("nombre"), "edad_cliente", "entidad",
        F.col("fc_nacimiento").alias("fecha_nacimiento"),
        if_null("id_canal_preferido", 0).alias("canal_preferido"),
        flag(F.col("id_cartera").isin(*P.EXPERT_PORTFOLIOS)).alias("indConectaTuExperto"),
        F.col("id_cliente").alias("idcliente"), F.col("id_codigo_postal").alias("codigopostal"),
        F.col("id_gestor").alias("idgestor"),
        language_label("id_idioma_preferencia").alias("idioma_preferencia"),
        F.col("id_oficina").alias("oficina"), F.col("id_segm_soec").alias("segmento_socieco"),
        F.col("id_segm_valor_estrategico").alias("segmento_estrval"),
        F.col("id_tipo_persona").alias("tipo_persona"),
        F.col("ind_banca_personal").alias("indbancapersonal"),
        F.col("ind_banca_privada").alias("indbancaprivada"),
        if_null("ind_banca_virtual", 0).alias("indbancavirtual"),
        F.col("id_clasificacion_actividad").alias("indclasifactividad"),
        # a present prefix is always reported as '34' (the substring branch never runs)
        F.when(prefix.isNull(), F.lit("")).otherwise(F.lit(P.MOBILE_PREFIX)).alias("prefijo_mv"),
        empty_if_null("telefono_fijo").alias("tfno_fijo"),
        F.col("fc_fallecimiento_disolucion").alias("fecha_fallecimiento"),
        "fecha_derivado",
    )


def latest_customers(customers: DataFrame, partition_value) -> DataFrame:
    """Newest cleaned row per natural person of the bank in one monthly partition."""
    base = customers.filter((F.col("dt") == partition_value) & (F.col("entidad") == P.ENTITY)
                            & (F.col("id_tipo_persona") == P.PERSON_NATURAL))
    clean = clean_customers(base)
    ties = [F.col(c).asc_nulls_first() for c in CUSTOMER_COLUMNS if c != "idcliente"]
    return dedupe.latest_row_per_key(clean, ["idcliente"], "fecha_derivado", ties)


def manager_contacts(managers: DataFrame, contacts: DataFrame) -> DataFrame:
    """Manager code -> e-mail, centre, type (managers without contact are dropped)."""
    m = managers.filter(snapshot_is(P.SNAPSHOT_LATEST))
    c = contacts.filter(snapshot_is(P.SNAPSHOT_LATEST))
    j = m.join(c, m.cogsmk == c.cogrmk, "inner")
    return j.select(F.col("cogsmk").alias("codgestor"), F.col("coemai").alias("emailgestor"),
                    F.col("codice").alias("codigocentro"), F.col("cotgmk").alias("tipogestor"))


def milestone_birthdays(person_board: DataFrame, as_of: _dt.date, month_end: str = "last_day") -> DataFrame:
    """Active natural persons who reach the milestone age in ``MILESTONE_LEAD_DAYS`` days."""
    due = F.date_add(F.lit(as_of), P.MILESTONE_LEAD_DAYS)
    cond = ((F.col("cotpmk") == P.PERSON_NATURAL) & (F.col("coh004") == P.PERSON_ACTIVE_CODE)
            & snapshot_is(P.SNAPSHOT_LATEST)
            & (due == add_months("fenac9", P.MILESTONE_MONTHS, month_end)))
    return person_board.filter(cond).select(
        "copemk", F.col("fenac9").alias("fecha_nacimiento"),
        (F.col("casfpt") / 100).alias("saldo_RACs"), F.col("caedad").alias("edad"))


def birthday_by_parts(birth_col: str, as_of: _dt.date, years: int) -> "F.Column":
    """Draft rule: same day next month and ``years`` of difference, plus the
    December branch (which needs ``month(as_of) + 1 = 1`` and so never fires)."""
    b = F.col(birth_col)
    d, m, y = as_of.day, as_of.month, as_of.year
    main = (F.dayofmonth(b) == d) & (F.month(b) == m + 1) & (F.lit(y) - F.year(b) == years)
    dec = (F.dayofmonth(b) == d) & (F.month(b) == 12) & F.lit(m + 1 == 1) & (F.lit(y) - F.year(b) == years - 1)
    return main | dec


def principal_rows(contracts: DataFrame) -> DataFrame:
    """Live principal-holder rows ``(tt, xcoemp, copser, idprig)`` of the bank."""
    return contracts.filter((F.col("xcoemp") == P.ENTITY) & F.col("ffigco").isNull()
                            & (F.col("cosiig") == P.STATUS_ACTIVE) & snapshot_is(P.SNAPSHOT_LATEST)
                            & (F.col("coprbs").try_cast("int") == P.RELATION_PRINCIPAL)).select(
        F.col("copemk").alias("tt"), "xcoemp", "copser", "idprig")


def youth_accounts(src, as_of: _dt.date) -> DataFrame:
    """Youth-product accounts on the newest balance day with their principal holder.

    Output ``(Persona, tt, copser, idprig)`` plus product-family 0/1 flags.
    The newest day is taken over the whole balance table up to ``as_of``.
    """
    balances, contracts = src.account_balance, src.contracts
    newest = control.newest_of(src, "account_balance", "fevaig", as_of)
    a = balances.filter((F.col("xcoemp") == P.ENTITY) & F.col("feigfi").isNull()
                        & (F.col("fevaig") == newest) & F.col("ffigco").isNull()
                        & (F.col("cosiig") == P.STATUS_ACTIVE) & F.col("copser").isin(*P.YOUTH_PRODUCTS)
                        & snapshot_is(P.SNAPSHOT_LATEST)).select("xcoemp", "copser", "idprig", "copemk").distinct()
    b = principal_rows(contracts)
    j = a.join(b, ["xcoemp", "copser", "idprig"], "inner").select(
        F.col("copemk").alias("Persona"), "tt", "copser", "idprig").distinct()
    s = F.col("copser")
    return j.select("*",
                    flag(s == P.YOUTH_PRODUCT_ON).alias("cuenta_on"),
                    flag(s == P.YOUTH_PRODUCT_YOUNG).alias("cuenta_joven"),
                    flag(s.isin(*P.YOUTH_PRODUCTS_EASY)).alias("cuenta_facil"),
                    flag(s.isin(*P.YOUTH_PRODUCTS)).alias("total_cuentas"))


def programme_newest(src, as_of: _dt.date) -> list:
    """[newest extraction, newest evaluation day] of the programme up to ``as_of``, as Columns."""
    return control.newest_days_where(src, "programme", {"extractiondate": "%Y%m%d", "fevaig": None}, as_of,
                                     F.trim("clvpro") == P.PROGRAMME_KEY)


def programme_rows(src, as_of: _dt.date, passing: bool, newest=None, distinct: bool = True) -> DataFrame:
    """Programme evaluations of the newest run: all three criteria met
    (``passing``) or any of four failed.  ``newest`` shares the two newest
    values between calls; ``distinct=False`` when only existence matters."""
    programme = src.programme
    key = F.trim("clvpro") == P.PROGRAMME_KEY
    newest_ext, newest_eval = newest if newest is not None else programme_newest(src, as_of)
    if passing:
        crit = (F.col("marin3") == "S") & (F.col("marin5") == "S") & (F.col("marin6") == "S")
    else:
        crit = ((F.col("marin1") == "N") | (F.col("marin3") == "N") | (F.col("marin5") == "N")
                | (F.col("marin6") == "N"))
    rows = programme.filter((F.col("fevaig") == newest_eval) & (F.col("extractiondate") == newest_ext)
                            & key & crit)
    out = rows.select("copemk", "fevaig", "marin6", "marin3", "marin5", "marin1", "marin2")
    return out.distinct() if distinct else out


def digital_profiles(src, as_of: _dt.date) -> DataFrame:
    """Customers with every contact permission on the newest derivation day up to ``as_of``."""
    customers = src.customers_daily
    newest = control.newest_of(src, "customers_daily", "fecha_derivado", as_of)
    cond = ((F.col("fecha_derivado") == newest) & F.col("telefono_movil_1").isNotNull()
            & (F.col("ds_email") == "SI") & (F.col("ind_cr_electronica") == "S")
            & (F.col("ind_disp_moviles") == "S") & (F.col("ind_telemarketing") == "S")
            & (F.col("ind_correspondencia_internet") == 1))
    return customers.filter(cond).select("id_cliente", "telefono_movil_1").distinct()


def live_payroll(payroll: DataFrame) -> DataFrame:
    return payroll.filter(snapshot_is(P.SNAPSHOT_LATEST) & (F.col("xcoemp") == P.ENTITY)
                          & F.col("ffigco").isNull() & (F.col("cosiig") == P.STATUS_ACTIVE))

