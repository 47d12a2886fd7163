"""Core datasets: customer core and contract core."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import snapshot_is
from ..operators import accounts, control, dedupe, joins, people


def customer_core(src, as_of: _dt.date, dt: int | None = None, dedupe_details: bool = False) -> DataFrame:
    """One cleaned row per living natural person, with manager and detail columns.

    ``dt`` is the monthly partition to read; by default the newest one not
    after ``as_of``.  Detail tables are LEFT JOINed as they are: a customer
    with several live value-manager rows appears several times unless
    ``dedupe_details`` keeps one per customer.
    """
    cust = src.customers_daily
    part = F.lit(dt) if dt is not None else control.newest_of(src, "customers_daily", "dt", int(as_of.strftime("%Y%m")))
    latest = people.latest_customers(cust, part).filter(F.col("fecha_fallecimiento").isNull())
    managers = people.manager_contacts(src.managers, src.manager_contacts)
    det1 = src.customer_attrs.filter(snapshot_is(P.SNAPSHOT_LATEST) & (F.col("xcoemp") == P.ENTITY)).select(
        F.col("copemk").alias("codCliente"), F.col("in94mk").alias("Precarterizado"),
        F.col("inpx06").alias("Colectivo_Valor"), F.col("in16mk").alias("indReservaMapfre"))
    det2 = src.value_managers.filter(snapshot_is(P.SNAPSHOT_LATEST) & F.col("ffcpmk").isNull()).select(
        F.col("copemk").alias("CodCliente2"), F.col("cogsmk").alias("CodGestor_Valor"))
    if dedupe_details:
        det1 = dedupe.first_row_per_key(det1, ["codCliente"], [F.col(c).asc_nulls_last() for c in det1.columns[1:]])
        det2 = dedupe.first_row_per_key(det2, ["CodCliente2"], [F.col("CodGestor_Valor").asc_nulls_last()])
    j = (latest.join(managers, latest.idgestor == managers.codgestor, "left")
         .join(det1, latest.idcliente == det1.codCliente, "left"))
    # value-manager rows fan out per customer (as the rule reads them): a hot
    # customer there must not be joined by one task
    j = joins.left_join_skew_safe(j, det2, [("idcliente", "CodCliente2")])
    return j.select(
        "idcliente", "prefijo_mv", "tfno_movil", "tfno_fijo", "tenencia_email", "nombre", "edad_cliente",
        "fecha_nacimiento", "fecha_fallecimiento", "codigopostal", "canal_preferido", "entidad",
        "idioma_preferencia", "oficina", "segmento_socieco", "segmento_estrval", "tipo_persona",
        "indConectaTuExperto", "indbancapersonal", "indbancaprivada", "indbancavirtual",
        "indclasifactividad", "indReservaMapfre",
        F.coalesce(F.col("codgestor"), F.lit(0).cast("bigint")).alias("cod_gestor"),
        F.coalesce(F.col("emailgestor"), F.lit("0")).alias("mailgestor"),
        F.coalesce(F.col("codigocentro"), F.lit("0")).alias("cod_centro"),
        F.coalesce(F.col("tipogestor"), F.lit("0")).alias("tipogestor"),
        "Colectivo_Valor", "Precarterizado", "CodGestor_Valor")


def product_catalogue(catalogue: DataFrame, as_of: _dt.date, days: int = P.CATALOGUE_WINDOW_DAYS) -> DataFrame:
    """Newest on-sale catalogue row per product extracted in the ``days`` days up to ``as_of``."""
    since = accounts.day_key(as_of, days)
    until = accounts.day_key(as_of)      # a run reads nothing extracted after its run date
    live = catalogue.filter((F.col("extractiondate") >= since) & (F.col("extractiondate") <= until)
                            & (F.col("especo") == P.CATALOGUE_ON_SALE) & (F.col("coesin") == P.CATALOGUE_ACTIVE))
    cols = live.select(F.col("copser").alias("COD_PRODUCTO"), F.col("cdfeco").alias("CO_FAMILIA"),
                       F.col("cdseco").alias("CO_SUBFAMILIA"), F.col("dsfeco").alias("DESC_FAMILIA"),
                       F.col("dsseco").alias("DESC_SUBFAMILIA"), "extractiondate")
    ties = [F.col(c).asc_nulls_first() for c in ("CO_FAMILIA", "CO_SUBFAMILIA", "DESC_FAMILIA", "DESC_SUBFAMILIA")]
    return dedupe.latest_row_per_key(cols, ["COD_PRODUCTO"], "extractiondate", ties).drop("extractiondate")


def product_dictionary(attrs: DataFrame, values: DataFrame, attribute: int = P.DICTIONARY_ATTRIBUTE) -> DataFrame:
    """Distinct (code, number, name) of one dictionary attribute."""
    a = attrs.filter((F.col("codamk") == attribute) & snapshot_is(P.SNAPSHOT_LATEST))
    v = values.filter(snapshot_is(P.SNAPSHOT_LATEST))
    j = a.join(v, a.codam1 == v.codamk, "inner")
    return j.select(F.col("coocmk").alias("valor_alf"), F.col("coocda").alias("valor_num"),
                    F.col("noocmk").alias("descrip_valor")).distinct()


def contract_core(src, as_of: _dt.date, since: _dt.date) -> DataFrame:
    """Live holder contracts started after ``since`` with catalogue and name."""
    b = accounts.holder_contracts(src.contracts, src.holder_codes).filter(F.col("fiigco") > F.lit(since))
    prod = product_catalogue(src.catalogue, as_of)
    dic = product_dictionary(src.dictionary_attrs, src.dictionary_values)
    j = (b.join(prod, b.copser == prod.COD_PRODUCTO, "left")
         .join(dic, b.copser == F.trim(dic.valor_alf).try_cast("int"), "left"))
    return j.select(F.col("copser").alias("URSUS_PRODUCTO"), F.col("descrip_valor").alias("DESC_PRODUCTO"),
                    F.col("coprbs").alias("TIPO_RELACION"), F.col("copemk").alias("URSUS_CLIENTE"),
                    "CO_FAMILIA", "CO_SUBFAMILIA", "DESC_FAMILIA", "DESC_SUBFAMILIA",
                    F.col("fiigco").alias("FECHA_CONTRATACION"))


def contract_initial_load(src, as_of: _dt.date, month_end: str = "last_day") -> DataFrame:
    return contract_core(src, as_of, add_months_date(as_of, -P.INITIAL_LOAD_MONTHS, month_end))


def contract_daily_load(src, as_of: _dt.date) -> DataFrame:
    return contract_core(src, as_of, as_of - _dt.timedelta(days=P.DAILY_LOAD_DAYS))


def add_months_date(d: _dt.date, months: int, month_end: str = "last_day") -> _dt.date:
    """Driver-side ``functions.add_months``."""
    import calendar
    y, m = divmod(d.month - 1 + months, 12)
    y, m = d.year + y, m + 1
    last = calendar.monthrange(y, m)[1]
    at_end = month_end == "last_day" and d.day == calendar.monthrange(d.year, d.month)[1]
    return _dt.date(y, m, last if at_end else min(d.day, last))

