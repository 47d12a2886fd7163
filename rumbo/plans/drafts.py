"""Draft variants of the young-retention and home-insurance journeys.

They are the earlier rule sets (birthday by date parts, own home policies
expiring in 56 days) and read newest partitions through a control table (a
UNION ALL of per-source newest dates).  Enrichments are LEFT JOINs kept at the
grain the sources give (no de-duplication), as the drafts were written.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import flag, snapshot_is
from ..operators import agg, control, joins, observe, people
from ..operators.reuse import reuse

BOARD = "tbl_BGTTB_TABLON_CLIENTES_MES_TT"
DOMICILIATIONS = "tbl_IGV0_CP_AHCAD_DOM"
MONTHLY_ACCOUNTS = "tbl_IGV0_CP_AHCAD_M"
CONTRACTING = "tbl_BGTMD_PB150_INICIOCONTRATACIONPRODUCTO_D"


# FIXED VALUES: control label -> table and its day partition.
CONTROL_SOURCES = {DOMICILIATIONS: ("account_domiciliations", "extractiondate"), BOARD: ("monthly_board", "process_date"),
                   MONTHLY_ACCOUNTS: ("monthly_accounts", "extractiondate"), CONTRACTING: ("contracting_events", "dt")}


def control_dates(src, labels: list[str], as_of: _dt.date) -> DataFrame:
    """Control table ``(C1 label, C2 newest partition up to as_of)`` for the listed sources."""
    return reduce(DataFrame.unionByName, [control.control_row(getattr(src, CONTROL_SOURCES[label][0]).sparkSession, label, newest_day(src, label, as_of))
                                         for label in labels])


def newest_day(src, label: str, as_of: _dt.date):
    """The newest day partition of a control label's table up to the run date, as a Column.

    Sources with load marks (``src.marks``) have it from the control table; others from the table's partitions.
    """
    marks = getattr(src, "marks", None)
    if marks is not None:
        mark = marks.newest(label, as_of, as_of.strftime("%Y%m%d"))
        if mark is None:
            observe.note(f"control table without a row: {label} up to {as_of}")
        return F.lit(mark)
    return control.newest_of(src, *CONTROL_SOURCES[label], as_of.strftime("%Y%m%d"))


def _managers(src) -> DataFrame:
    return people.manager_contacts(src.managers, src.manager_contacts).select(
        F.col("codgestor").alias("COD_GESTOR"), F.col("emailgestor").alias("EMAIL_GESTOR"))


def young_retention_draft(src, as_of: _dt.date, products: tuple[str, str, str] = P.DRAFT_DOMICILED_PRODUCTS,
                          contracting_product: str = P.DRAFT_ON_CONTRACTING_PRODUCT) -> DataFrame:
    """Customers whose birthday (26th) falls on the same day next month.

    ``products``: the easy, the online and the payroll account; ``contracting_product``: the online account in the contracting events.
    """
    easy, online, payroll = products
    pb = src.person_board.filter(snapshot_is(P.SNAPSHOT_LATEST)
                                 & people.birthday_by_parts("fenac9", as_of, P.DRAFT_AGE_YEARS))
    g = _managers(src)
    a = pb.join(g, pb.cogsmk == g.COD_GESTOR, "left").select(
        F.col("copemk").alias("Persona"), F.col("fenac9").alias("FechaNacimiento"), "EMAIL_GESTOR",
        flag(F.col("in82mk") == "1").alias("TenenciaPorSerTu"), flag(F.col("in94mk") == "1").alias("ClienteDigital"))
    dom = src.account_domiciliations
    b = dom.filter((F.col("extractiondate") == newest_day(src, DOMICILIATIONS, as_of))
                   & F.col("copser").isin(*products)
                   & (F.col("coddmc") == P.DRAFT_DOMICILE_OFFICE)).select(
        F.col("copemk").alias("__b"),
        flag(F.col("copser") == easy).alias("TENENCIA_CUENTA_FACIL"),
        flag(F.col("copser") == online).alias("TENENCIA_CUENTA_ON"),
        flag(F.col("copser") == payroll).alias("NOMINA_DOMICILIADA"))
    c = src.monthly_board.filter(F.col("process_date") == newest_day(src, BOARD, as_of)).select(
        F.col("co_codpers_mt").alias("__c"), F.col("im_saldfinmestotvolrecur_mt").alias("ImporteRecursos"))
    d = src.monthly_accounts.filter(F.col("extractiondate") == newest_day(src, MONTHLY_ACCOUNTS, as_of)).select(
        flag(F.col("co1504").isin(*P.DRAFT_INCOME_CODES)).alias("INGRESOS_DOMICILIADOS"), F.col("copemk").alias("__d"))
    ev = src.contracting_events.filter(F.col("dt") == newest_day(src, CONTRACTING, as_of))
    f = ev.filter(F.col("co_producto_ursus") == contracting_product).select(
        flag(F.col("co_producto_ursus") == contracting_product).alias("CONTRATACION_CUENTA_ON"),
        F.col("co_cliente").alias("__f"))
    # every enrichment is reduced to the day's persons first; domiciliation and
    # monthly-account rows fan out per person: skew-safe joins
    a = reuse(a)
    who = a.select("Persona")
    b, c, d, f = (joins.semi(x, who, [(k, "Persona")]) for x, k in ((b, "__b"), (c, "__c"), (d, "__d"), (f, "__f")))
    j = joins.left_join_skew_safe(a, b, [("Persona", "__b")]).join(c, F.col("Persona") == c.__c, "left")
    j = joins.left_join_skew_safe(j, d, [("Persona", "__d")]).join(f, F.col("Persona") == f.__f, "left")
    return j.select(
        F.col("Persona").alias("ID_URSUS"), F.lit(P.JOURNEY_YOUNG).alias("CODIGO_JOURNEY"),
        F.col("FechaNacimiento").alias("FECHA_NACIMIENTO"), F.col("TenenciaPorSerTu").alias("TENENCIA_XSER_TU"),
        F.col("ClienteDigital").alias("CLIENTE_DIGITAL"), F.col("ImporteRecursos").alias("IMPORTE_RECURSOS"),
        "TENENCIA_CUENTA_FACIL", "TENENCIA_CUENTA_ON", "NOMINA_DOMICILIADA", "INGRESOS_DOMICILIADOS",
        "CONTRATACION_CUENTA_ON", "EMAIL_GESTOR")


def own_policies_due(src, as_of: _dt.date) -> DataFrame:
    """Own home policies expiring in 56 days."""
    pol = src.policies
    due = F.date_add(F.lit(as_of), P.DRAFT_HOME_LEAD_DAYS)
    return pol.filter(snapshot_is(P.SNAPSHOT_LATEST) & F.col("copser").isin(*P.DRAFT_HOME_PRODUCTS)
                      & ~F.col("idcoas").isin(*P.DRAFT_HOME_EXCLUDED_ISSUERS)
                      & F.col("feprnz").isNotNull() & (F.to_date("feprnz") == due)).select(
        "feprnz", "copemk", "idcoas", "copser")


def insurance_tenure(src, as_of: _dt.date) -> DataFrame:
    """Car, health and funeral insurance flags of the newest monthly board, by ``__d``."""
    m = src.monthly_board.filter(F.col("process_date") == newest_day(src, BOARD, as_of))
    return m.select(
        flag((F.col("in_tensegurauto_mt") == "1") | (F.col("in_tensegurvehisegurauto_mt") == "1")).alias("TENENCIA_SEGURO_AUTO"),
        flag((F.col("in_tensegursaludindem_mt") == "1") | (F.col("in_tensegursaludreemb_mt") == "1")
             | (F.col("in_tensegursaludasistsanit_mt") == "1")).alias("TENENCIA_SEGURO_SALUD"),
        flag((F.col("in_tensegurotrsegurdecenoprimunic_mt") == "1")
             | (F.col("in_tensegurotrsegurdeceprimunic_mt") == "1")).alias("TENENCIA_SEGURO_DECESOS"),
        F.col("co_cliente").alias("__d"))


def own_policy_expiry(src, as_of: _dt.date) -> DataFrame:
    """D38 with D40: own home policies expiring in 56 days and their holders' tenure flags."""
    a = reuse(own_policies_due(src, as_of))
    d = insurance_tenure(src, as_of)
    d = joins.semi(d, a.select(F.col("copemk").alias("__holder")), [("__d", "__holder")])
    return a.join(d, a.copemk == d.__d, "left").select(
        "copemk", "feprnz", "idcoas", "copser", "TENENCIA_SEGURO_AUTO", "TENENCIA_SEGURO_SALUD", "TENENCIA_SEGURO_DECESOS")


def home_insurance_draft(src, as_of: _dt.date) -> DataFrame:
    """Own home policies expiring in 56 days, with portfolio, payroll, tenure,
    consumer-loan and home-purchase propensity indicators (distinct rows)."""
    a = own_policies_due(src, as_of)
    g = _managers(src)
    # every enrichment is reduced to the day's policy holders before it is grouped or joined
    a = reuse(a)
    holders = a.select(F.col("copemk").alias("__holder"))
    t = joins.semi(src.customer_attrs.filter(snapshot_is(P.SNAPSHOT_LATEST)), holders, [("copemk", "__holder")])
    b = t.join(g, t.cogsmk.try_cast("bigint") == g.COD_GESTOR, "left").select(
        F.when(F.col("cogsmk") == "0", 0).otherwise(1).alias("OPORTUNIDAD_GESTOR"),
        flag(F.col("inlp26") == "1").alias("SEGURO_HOGAR_CARTERA_BANKIA"),
        flag(F.col("in61mk") == "1").alias("DESCUENTO_SEGURO"),
        flag(F.col("in77mk") == "1").alias("CLIENTE_RESERVA_COMERCIAL_RED"),
        flag(F.col("in16mk") == "1").alias("CLIENTE_RESERVA_COMERCIAL_MAPFRE"),
        F.col("copemk").alias("__b"), "EMAIL_GESTOR")
    c = src.payroll_amounts.filter(snapshot_is(P.SNAPSHOT_LATEST)).select(
        flag(F.col("copser").isin(*P.DRAFT_PAYROLL_SERVICES)).alias("TENENCIA_SERVICIO_NOMINA"),
        "imulig", F.col("copemk").alias("__c"))
    d = insurance_tenure(src, as_of)
    ev = src.contracting_events
    e = ev.filter((F.col("dt") == newest_day(src, CONTRACTING, as_of))
                  & (F.col("co_producto_ursus") == P.DRAFT_CONSUMER_LOAN_PRODUCT)
                  & (F.col("co_empresa_cont") == "0")).select(
        flag(F.col("co_producto_ursus") == P.DRAFT_CONSUMER_LOAN_PRODUCT).alias("CONTRATACION_PRESTAMO_CONSUMO"),
        F.col("co_cliente").alias("__e"))
    best = agg.max_per_key(joins.semi(src.scores_b.filter(F.col("modelid").isin(*P.DRAFT_HOME_MODELS)),
                                      holders, [("co_cliente", "__holder")]),
                           ["co_cliente", "modelid"], "probabilidad", "PROBA")
    f = best.select(F.col("co_cliente").alias("__f"),
                    F.when(F.col("modelid") == "MSGHCHX1", F.col("PROBA")).otherwise(0.0)
                    .alias("COMPRA_SH_CLIENTE_SINPRESTAMO"),
                    F.when(F.col("modelid") == "MSGHSHX1", F.col("PROBA")).otherwise(0.0)
                    .alias("COMPRA_SH_CLIENTE_PRESTAMO"))
    c, d, e = (joins.semi(x, holders, [(k, "__holder")]) for x, k in ((c, "__c"), (d, "__d"), (e, "__e")))
    j = (a.join(b, a.copemk == b.__b, "left").join(c, a.copemk == c.__c, "left")
         .join(d, a.copemk == d.__d, "left").join(e, a.copemk == e.__e, "left")
         .join(f, a.copemk == f.__f, "left"))
    return j.select(
        F.col("copemk").alias("ID_URSUS"), F.lit(P.JOURNEY_HOME).alias("CODIGO_JOURNEY"),
        F.col("feprnz").alias("FECHA_VEMCIMIENTO"), F.col("idcoas").alias("EMISOR_SEGURO_HOGAR"),
        F.col("copser").alias("TIPOLOGIA_SEGURO"), "OPORTUNIDAD_GESTOR", "SEGURO_HOGAR_CARTERA_BANKIA",
        "DESCUENTO_SEGURO", "CLIENTE_RESERVA_COMERCIAL_RED", "CLIENTE_RESERVA_COMERCIAL_MAPFRE",
        "TENENCIA_SERVICIO_NOMINA", F.col("imulig").alias("IMPORTE_NOMINA"), "TENENCIA_SEGURO_AUTO",
        "TENENCIA_SEGURO_SALUD", "TENENCIA_SEGURO_DECESOS", "CONTRATACION_PRESTAMO_CONSUMO",
        "COMPRA_SH_CLIENTE_SINPRESTAMO", "COMPRA_SH_CLIENTE_PRESTAMO", "EMAIL_GESTOR").distinct()
