"""DuckDB SQL of the journeys and core datasets, built from named parts.

Each part is a CTE stating one rule in words of its own (``principal``: live
principal holders, ``scored_a``: persons over a model's threshold, ...); a
dataset joins the parts it needs.  Nothing of the Spark code is used but the
fixed codes in ``rumbo.params``.
"""

from __future__ import annotations

import datetime as _dt

from rumbo import params as P

from .standins import case_map, with_standins

NOW = "snapshot = 'LATEST'"
OPEN = "xcoemp = 0 AND cosiig = 10000 AND ffigco IS NULL"
ACCOUNT = "xcoemp, copser, idcoec, idprig"
THRESHOLD_DAY = f"(SELECT max(extractiondate) FROM model_thresholds WHERE {NOW})"
CUSTOMER_TIES = [
    "tfno_movil", "tenencia_email", "nombre", "edad_cliente", "entidad", "fecha_nacimiento", "canal_preferido", "indConectaTuExperto",
    "codigopostal", "idgestor", "idioma_preferencia", "oficina", "segmento_socieco", "segmento_estrval", "tipo_persona",
    "indbancapersonal", "indbancaprivada", "indbancavirtual", "indclasifactividad", "prefijo_mv", "tfno_fijo", "fecha_fallecimiento"]


def day(x: _dt.date, back: int = 0) -> str:
    return (x - _dt.timedelta(days=back)).strftime("'%Y%m%d'")


def date(x: _dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def months_on(x: str, n: int) -> str:
    """Date ``n`` months on; the last day of a month stays the last day."""
    moved = f"CAST(CAST({x} AS DATE) + INTERVAL ({n}) MONTH AS DATE)"
    return f"CASE WHEN CAST({x} AS DATE) = last_day(CAST({x} AS DATE)) THEN last_day({moved}) ELSE {moved} END"


def listed(values) -> str:
    return ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values)


def yes(condition: str) -> str:
    """1 where the condition holds, else 0 (also when it is unknown)."""
    return f"CAST(coalesce({condition}, false) AS INTEGER)"


def scored_a(models) -> str:
    return f"""SELECT DISTINCT s.idpers AS person FROM scores_a s
        WHERE s.idmode IN ({listed(models)}) AND s.extractiondate = {THRESHOLD_DAY} AND EXISTS (
            FROM model_thresholds t WHERE t.idmode = s.idmode AND t.iduso = 'MEDICION'
            AND t.extractiondate = {THRESHOLD_DAY} AND t.nupropenmin <= s.nupropen)"""


def scored_b(models) -> str:
    return f"""SELECT DISTINCT s.co_cliente AS person FROM scores_b s
        WHERE s.modelid IN ({listed(models)}) AND s.sessionid = {THRESHOLD_DAY} AND EXISTS (
            FROM model_thresholds t WHERE t.idmode = s.modelid AND t.iduso = 'MEDICION'
            AND t.extractiondate = {THRESHOLD_DAY} AND t.nupropenmin <= s.probabilidad)"""


PRINCIPAL = f"""SELECT copemk AS person, xcoemp, copser, idprig FROM contracts
    WHERE {NOW} AND {OPEN} AND TRY_CAST(coprbs AS INTEGER) = {P.RELATION_PRINCIPAL}"""
HOLDINGS = f"""SELECT c.* FROM contracts c SEMI JOIN (SELECT coprbs AS code FROM holder_codes WHERE {NOW}) h
    ON ltrim(c.coprbs, '0') = h.code WHERE c.{NOW} AND c.xcoemp = 0 AND c.cosiig = 10000 AND c.ffigco IS NULL"""
NATURAL = f"SELECT copemk AS person FROM person_board WHERE {NOW} AND cotpmk = 1"
ACTIVE = f"{NATURAL} AND coh004 = 62120"
OFFERS = f"""SELECT copemk AS person, imlppm AS amount, inanom, max(feclpp) AS valid_to FROM loans
    WHERE {NOW} AND {OPEN} AND feigfi IS NULL AND copser = 93010 AND trim(coelpp) = 'AC' AND trim(coespq) = 'VI'
      AND trim(cdtcls) <> '99' GROUP BY ALL"""
CREDIT = f"""SELECT copemk AS person, max(cacv0d) AS credit FROM cards
    WHERE {NOW} AND {OPEN} AND feigfi IS NULL AND cacv0d > 0 AND trim(titar3) = 'C' AND porcpa = 100 GROUP BY ALL"""


def negative_balances(as_of: _dt.date) -> str:
    return f"""SELECT {ACCOUNT}, cavt20 AS balance, fevaig AS seen, imlimk AS allowance FROM account_balance
    WHERE {NOW} AND extractiondate = {day(as_of, 1)} AND cavt20 < 0 AND {OPEN} AND feigfi IS NULL"""


def good_days(as_of: _dt.date) -> str:
    return f"""SELECT copemk AS person, {ACCOUNT}, max(fevaig) AS good_day FROM account_balance
    WHERE snapshot = 'HISTORIC' AND extractiondate BETWEEN {day(as_of, P.OVERDRAFT_HISTORY_DAYS)} AND {day(as_of)}
      AND cavt20 >= 0 AND {OPEN} AND feigfi IS NULL GROUP BY ALL"""


def customer_core(as_of: _dt.date) -> str:
    language = case_map("id_idioma_preferencia", P.LANGUAGE_LABELS, f"'{P.LANGUAGE_DEFAULT}'")
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in CUSTOMER_TIES)
    parts = [
        ("month_rows", f"""SELECT id_cliente AS idcliente, fecha_derivado, ds_nombre AS nombre, edad_cliente, entidad,
            if(coalesce(prefijo_telefono_movil_1, prefijo_telefono_movil_2) IS NULL, '', '34') AS prefijo_mv,
            coalesce(telefono_movil_1, telefono_movil_2, '') AS tfno_movil, coalesce(telefono_fijo, '') AS tfno_fijo,
            coalesce(nullif(ds_email, ''), 'NO') AS tenencia_email, fc_nacimiento AS fecha_nacimiento,
            fc_fallecimiento_disolucion AS fecha_fallecimiento, id_codigo_postal AS codigopostal,
            coalesce(id_canal_preferido, 0) AS canal_preferido, {language} AS idioma_preferencia, id_oficina AS oficina,
            id_segm_soec AS segmento_socieco, id_segm_valor_estrategico AS segmento_estrval, id_tipo_persona AS tipo_persona,
            {yes('id_cartera IN (700, 701)')} AS indConectaTuExperto, ind_banca_personal AS indbancapersonal,
            ind_banca_privada AS indbancaprivada, coalesce(ind_banca_virtual, 0) AS indbancavirtual,
            id_clasificacion_actividad AS indclasifactividad, id_gestor AS idgestor
          FROM customers_daily WHERE entidad = 0 AND id_tipo_persona = 1
            AND dt = (SELECT max(dt) FROM customers_daily WHERE dt <= {as_of.strftime('%Y%m')})"""),
        ("newest", f"""FROM month_rows QUALIFY 1 = row_number() OVER (
            PARTITION BY idcliente ORDER BY fecha_derivado DESC, {ties})"""),
        ("contact", f"""SELECT m.cogsmk AS manager, m.codice, m.cotgmk, c.coemai FROM managers m
            JOIN manager_contacts c ON c.cogrmk = m.cogsmk AND c.{NOW} WHERE m.{NOW}"""),
        ("attrs", f"SELECT copemk AS person, in94mk, inpx06, in16mk FROM customer_attrs WHERE {NOW} AND xcoemp = 0"),
        ("valued", f"SELECT copemk AS person, cogsmk AS value_manager FROM value_managers WHERE {NOW} AND ffcpmk IS NULL"),
    ]
    return with_standins(["customers_daily", "managers", "manager_contacts", "customer_attrs", "value_managers"], """
SELECT n.* EXCLUDE (fecha_derivado, idgestor), attrs.in16mk AS indReservaMapfre, coalesce(contact.manager, 0) AS cod_gestor,
       coalesce(contact.coemai, '0') AS mailgestor, coalesce(contact.codice, '0') AS cod_centro,
       coalesce(contact.cotgmk, '0') AS tipogestor, attrs.inpx06 AS Colectivo_Valor, attrs.in94mk AS Precarterizado,
       valued.value_manager AS CodGestor_Valor
FROM newest n LEFT JOIN contact ON contact.manager = n.idgestor LEFT JOIN attrs ON attrs.person = n.idcliente
LEFT JOIN valued ON valued.person = n.idcliente
WHERE n.fecha_fallecimiento IS NULL""", parts)


def contract_core(since: _dt.date, as_of: _dt.date) -> str:
    parts = [
        ("holdings", HOLDINGS),
        ("offered", f"""SELECT copser, cdfeco, cdseco, dsfeco, dsseco FROM catalogue
            WHERE extractiondate BETWEEN {day(as_of, P.CATALOGUE_WINDOW_DAYS)} AND {day(as_of)} AND coesin = 'A' AND especo = '{P.CATALOGUE_ON_SALE}'
            QUALIFY 1 = row_number() OVER (PARTITION BY copser ORDER BY extractiondate DESC, cdfeco ASC NULLS FIRST,
                cdseco ASC NULLS FIRST, dsfeco ASC NULLS FIRST, dsseco ASC NULLS FIRST)"""),
        ("named", f"""SELECT DISTINCT TRY_CAST(trim(v.coocmk) AS INTEGER) AS product, v.coocmk, v.coocda, v.noocmk
            FROM dictionary_values v JOIN dictionary_attrs a ON a.codam1 = v.codamk AND a.codamk = {P.DICTIONARY_ATTRIBUTE} AND a.{NOW}
            WHERE v.{NOW}"""),
    ]
    return with_standins(["contracts", "holder_codes", "catalogue", "dictionary_attrs", "dictionary_values"], f"""
SELECT h.copser AS URSUS_PRODUCTO, named.noocmk AS DESC_PRODUCTO, h.coprbs AS TIPO_RELACION, h.copemk AS URSUS_CLIENTE,
       o.cdfeco AS CO_FAMILIA, o.cdseco AS CO_SUBFAMILIA, o.dsfeco AS DESC_FAMILIA, o.dsseco AS DESC_SUBFAMILIA,
       h.fiigco AS FECHA_CONTRATACION
FROM holdings h LEFT JOIN offered o USING (copser) LEFT JOIN named ON named.product = h.copser
WHERE h.fiigco > {date(since)}""", parts)


def overdraft_master(as_of: _dt.date) -> str:
    parts = [("principal", PRINCIPAL), ("natural_person", NATURAL), ("negative", negative_balances(as_of)),
             ("good", good_days(as_of)), ("offers", OFFERS), ("credit", CREDIT)]
    return with_standins(["account_balance", "contracts", "person_board", "loans", "cards"], f"""
SELECT person AS CODIGO_PERSONA, idprig AS C0, CAST(seen - good_day AS INTEGER) AS C1,
       {yes('offers.amount >= balance AND offers.valid_to > seen')} AS C2, {yes('credit >= balance')} AS C3,
       {yes('offers.inanom IN (1, 2)')} AS C4, md5(concat(copser, xcoemp, idprig)) AS C5, seen AS C6
FROM negative JOIN principal USING (xcoemp, copser, idprig) SEMI JOIN natural_person USING (person)
JOIN good USING (person, {ACCOUNT}) LEFT JOIN offers USING (person) LEFT JOIN credit USING (person)
WHERE good_day IS NOT NULL AND seen IS NOT NULL""", parts)


def overdraft_journey(as_of: _dt.date) -> str:
    parts = [
        ("principal", PRINCIPAL), ("natural_person", NATURAL), ("negative", negative_balances(as_of)),
        ("before", f"""SELECT {ACCOUNT} FROM account_balance WHERE snapshot = 'HISTORIC' AND cavt20 > 0
            AND extractiondate = {day(as_of, 2)} AND {OPEN} AND feigfi IS NULL"""),
        ("fallen", f"""SELECT person, {ACCOUNT}, balance, seen, {yes('allowance >= balance')} AS allowed,
            concat(copser, xcoemp, idprig) AS code FROM negative JOIN principal USING (xcoemp, copser, idprig)
            JOIN before USING ({ACCOUNT}) SEMI JOIN natural_person USING (person)"""),
        ("worst", """FROM fallen QUALIFY 1 = row_number() OVER (PARTITION BY person
            ORDER BY balance, code ASC NULLS FIRST, idcoec ASC NULLS FIRST)"""),
        ("total", f"""SELECT p.person, {yes('sum(b.cavt20) > 0')} AS covered FROM principal p SEMI JOIN worst USING (person)
            LEFT JOIN (SELECT xcoemp, copser, idprig, cavt20 FROM account_balance WHERE {NOW} AND {OPEN} AND feigfi IS NULL) b
            USING (xcoemp, copser, idprig) GROUP BY p.person"""),
        ("offers", OFFERS), ("credit", CREDIT),
        ("likely", f"{scored_a([P.OVERDRAFT_MODEL_SCORES_A])} UNION {scored_b([P.OVERDRAFT_MODEL_SCORES_B])}"),
    ]
    return with_standins(["account_balance", "contracts", "person_board", "loans", "cards", "scores_a", "scores_b", "model_thresholds"], f"""
SELECT w.person AS ID_URSUS, right(w.idprig, 4) AS C0, total.covered AS C1, w.allowed AS C2,
       {yes('credit.credit > w.balance')} AS C3, {yes('offers.amount >= w.balance AND offers.valid_to > w.seen')} AS C4,
       {yes('w.person IN (SELECT person FROM likely)')} AS C5, {yes('offers.inanom IN (1, 2)')} AS C6, md5(w.code) AS C7
FROM worst w LEFT JOIN total USING (person) LEFT JOIN credit USING (person) LEFT JOIN offers USING (person)""", parts)


def interest(as_of: _dt.date, web_rows: str, pension: bool) -> str:
    product = "plan_contracts" if pension else "fund_contracts"
    models = (P.PENSION_MODELS_A, P.PENSION_MODELS_B) if pension else (P.FUND_MODELS_A, P.FUND_MODELS_B)
    paid = f"""SELECT {ACCOUNT}, sum(cacv7j) AS paid FROM plan_operations WHERE xcoemp = 0 AND cox1b7 IN (1, 2)
        AND {as_of.year} IN (year(fecaig), year(feopen)) GROUP BY ALL"""
    parts = [
        ("visits", web_rows), ("active", ACTIVE), ("holdings", HOLDINGS), *([("paid_in", paid)] if pension else []),
        ("owned", f"""SELECT h.copemk AS owner{', paid' if pension else ''} FROM {product} p
            JOIN holdings h USING (xcoemp, copser, idprig) {'LEFT JOIN paid_in c ON (c.xcoemp, c.copser, c.idcoec, c.idprig) = (p.xcoemp, p.copser, p.idcoec, p.idprig)' if pension else ''}
            WHERE p.snapshot = 'LATEST' AND p.xcoemp = 0 AND p.cosiig = 10000 AND p.ffigco IS NULL AND p.feigfi IS NULL"""),
        ("likely", f"{scored_a(models[0])} UNION {scored_b(models[1])}"),
    ]
    flags = ["owner IS NOT NULL", *(["paid < 7000"] if pension else []), "v.id_cliente IN (SELECT person FROM likely)"]
    columns = [yes(f) for f in flags] + ["co_canal", "tl_seccion1_pagename", "tl_seccion2_pagename", "tl_seccion3_pagename", "tl_proceso_post"]
    return with_standins(["contracts", "holder_codes", product, "web_hits", "person_board", "scores_a", "scores_b", "model_thresholds",
                          *(["plan_operations"] if pension else [])], f"""
SELECT v.id_cliente AS ID_CLIENTE, {', '.join(f'{c} AS C{i}' for i, c in enumerate(columns))}
FROM visits v SEMI JOIN active ON active.person = v.id_cliente LEFT JOIN owned ON owned.owner = v.id_cliente""", parts)


def young_retention(as_of: _dt.date, trigger: str) -> str:
    parts = [
        ("youth", trigger),
        ("programme_day", "SELECT max(extractiondate) AS loaded, max(fevaig) AS valued FROM programme WHERE trim(clvpro) = 'HIBD2'"),
        ("standing", """SELECT DISTINCT copemk AS holder, marin1, marin2, marin3, marin5, marin6 FROM programme, programme_day
            WHERE trim(clvpro) = 'HIBD2' AND extractiondate = loaded AND fevaig = valued"""),
        ("digital", """SELECT DISTINCT id_cliente AS holder, telefono_movil_1 FROM customers_daily
            WHERE fecha_derivado = (SELECT max(fecha_derivado) FROM customers_daily) AND telefono_movil_1 IS NOT NULL AND ds_email = 'SI'
              AND ind_correspondencia_internet = 1
              AND 'S' = ALL (SELECT unnest([ind_cr_electronica, ind_disp_moviles, ind_telemarketing]))"""),
        ("turning", f"""SELECT copemk AS holder, fenac9, casfpt / 100 AS funds, caedad FROM person_board
            WHERE {NOW} AND cotpmk = 1 AND coh004 = 62120 AND {months_on("fenac9", 312)} = {date(as_of)} + 30"""),
        ("paid", f"SELECT DISTINCT copemk AS holder, 1 AS payroll FROM payroll_contracts WHERE {NOW} AND {OPEN}"),
        ("failed", """SELECT DISTINCT copser, idprig FROM youth SEMI JOIN (
            FROM standing WHERE 'N' IN (marin1, marin3, marin5, marin6)) f ON f.holder = youth.tt"""),
        ("served", "SELECT DISTINCT tt FROM youth SEMI JOIN digital ON digital.holder = youth.tt WHERE cuenta_facil = 0"),
    ]
    return with_standins(["account_balance", "contracts", "person_board", "programme", "payroll_contracts", "customers_daily"], f"""
SELECT y.Persona AS ID_URSUS, 'JR000002' AS CODIGO_JOURNEY, t.fenac9 AS FECHA_NACIMIENTO, t.funds AS IMPORTE_RECURSOS,
       s.marin6 AS INDICADOR_INGRESOS_DOMICILIADOS_PST, s.marin3 AS INDICADOR_ACCIONISTA_PST, s.marin5 AS INDICADOR_RACS_PST,
       s.marin1 AS INDICADOR_JOVEN_MENOR18_PST, s.marin2 AS INDICADOR_JOVEN_1825_PST,
       {yes('paid.payroll = 1')} AS INDICADOR_DOMICILIACION_INGRESOS_DIARIO, {yes('g.holder IS NOT NULL')} AS INDICADOR_PERFIL_DIGITAL,
       count(DISTINCT y.copser || '|' || y.idprig) AS NUMERO_CUENTAS, CAST(sum(y.cuenta_on) AS BIGINT) AS NUMERO_CUENTAS_ON,
       CAST(sum(y.cuenta_joven) AS BIGINT) AS NUMERO_CUENTAS_JOVEN, CAST(sum(y.cuenta_facil) AS BIGINT) AS NUMERO_CUENTAS_FACIL,
       {yes('sum(y.cuenta_joven + y.cuenta_on) = sum(y.total_cuentas)')} AS INDICADOR_TODAS_ONJOVEN
FROM youth y JOIN turning t ON t.holder = y.tt
LEFT JOIN (FROM standing WHERE marin3 = 'S' AND marin5 = 'S' AND marin6 = 'S') s ON s.holder = y.tt
LEFT JOIN paid ON paid.holder = y.tt LEFT JOIN digital g ON g.holder = y.tt
WHERE y.tt NOT IN (SELECT tt FROM served) AND (y.copser, y.idprig) NOT IN (SELECT (copser, idprig) FROM failed)
GROUP BY y.Persona, t.fenac9, t.funds, t.caedad, s.marin1, s.marin2, s.marin3, s.marin5, s.marin6, paid.payroll, g.holder""", parts)


def youth_accounts() -> str:
    return f"""SELECT DISTINCT b.copemk AS Persona, p.person AS tt, b.copser, b.idprig, {yes('b.copser = 11594')} AS cuenta_on,
    {yes('b.copser = 11239')} AS cuenta_joven, {yes('b.copser IN (10300, 10600)')} AS cuenta_facil, 1 AS total_cuentas
FROM account_balance b JOIN ({PRINCIPAL}) p USING (xcoemp, copser, idprig)
WHERE b.{NOW} AND b.xcoemp = 0 AND b.cosiig = 10000 AND b.ffigco IS NULL AND b.feigfi IS NULL
  AND b.copser IN (10300, 10600, 11239, 11594) AND b.fevaig = (SELECT max(fevaig) FROM account_balance)"""


def home_insurance_expiry(trigger: str) -> str:
    parts = [
        ("due", trigger), ("active", ACTIVE),
        ("held", f"""SELECT copemk AS person, colnng, cosgri, imd2c0 FROM policies WHERE {NOW} AND {OPEN} AND codsi7 = 1"""),
        ("own", """SELECT DISTINCT Persona FROM due SEMI JOIN (FROM held WHERE colnng = 5) h ON h.person = due.Persona
            WHERE COMPANIA IN ('CASER', 'PLUS ULTRA SEGUROS')"""),
        ("summary", """SELECT person, max(CAST(colnng = 4 AND imd2c0 >= 200 AS INTEGER)) AS health,
            max(CAST(colnng = 7 AND imd2c0 >= 120 AS INTEGER)) AS car,
            max(CAST(colnng = 8 AND cosgri = 25 AND imd2c0 >= 60 AS INTEGER)) AS funeral FROM held GROUP BY person"""),
    ]
    return with_standins(["receipts", "policies", "person_board"], f"""
SELECT DISTINCT due.Persona AS PERSONA, due.FECHA_VENCIMIENTO, {yes('summary.person IS NOT NULL')} AS SEGURO_HOGAR_CONTRATADO,
       coalesce(health, 0) AS SEGURO_SALUD_MAYOR_200, coalesce(car, 0) AS SEGURO_AUTO_MAYOR_120,
       coalesce(funeral, 0) AS SEGURO_DECESOS_MAYOR_60
FROM due SEMI JOIN active ON active.person = due.Persona ANTI JOIN own ON own.Persona = due.Persona
LEFT JOIN summary ON summary.person = due.Persona
WHERE RAMO IS NOT NULL AND length(Concepto) >= 20""", parts)


MAIL = f"""SELECT m.cogsmk AS manager, c.coemai AS mail FROM managers m
    JOIN manager_contacts c ON c.cogrmk = m.cogsmk AND c.{NOW} WHERE m.{NOW}"""


def newest_rows(table: str, partition: str, columns: str) -> str:
    return f"SELECT {columns} FROM {table} WHERE {partition} = (SELECT max({partition}) FROM {table})"


def any_yes(*columns: str) -> str:
    return yes(f"'1' IN ({', '.join(columns)})")


def young_retention_draft(as_of: _dt.date) -> str:
    birthday = (as_of.day, as_of.month + 1, as_of.year - P.DRAFT_AGE_YEARS)
    parts = [
        ("mail_of", MAIL),
        ("turning", f"""SELECT copemk AS person, fenac9 AS born, {any_yes('in82mk')} AS loyal, {any_yes('in94mk')} AS digital, mail
            FROM person_board LEFT JOIN mail_of ON manager = cogsmk
            WHERE {NOW} AND (day(fenac9), month(fenac9), year(fenac9)) = {birthday}"""),
        ("domiciled", newest_rows("account_domiciliations", "extractiondate", f"""copemk AS person, {yes("copser = '10600'")} AS easy,
            {yes("copser = '11594'")} AS online, {yes("copser = '11229'")} AS payroll""")
            + f" AND coddmc = '{P.DRAFT_DOMICILE_OFFICE}' AND copser IN ({listed(P.DRAFT_DOMICILED_PRODUCTS)})"),
        ("funds", newest_rows("monthly_board", "process_date", "co_codpers_mt AS person, im_saldfinmestotvolrecur_mt AS amount")),
        ("income", newest_rows("monthly_accounts", "extractiondate",
                               f"copemk AS person, {yes(f'co1504 IN ({listed(P.DRAFT_INCOME_CODES)})')} AS direct")),
        ("opened", newest_rows("contracting_events", "dt", "co_cliente AS person, 1 AS started")
            + f" AND co_producto_ursus = '{P.DRAFT_ON_CONTRACTING_PRODUCT}'"),
    ]
    return with_standins(["person_board", "managers", "manager_contacts", "account_domiciliations", "monthly_board", "monthly_accounts",
                          "contracting_events"], f"""
SELECT t.person AS ID_URSUS, '{P.JOURNEY_YOUNG}' AS CODIGO_JOURNEY, born AS FECHA_NACIMIENTO, loyal AS TENENCIA_XSER_TU,
       digital AS CLIENTE_DIGITAL, funds.amount AS IMPORTE_RECURSOS, easy AS TENENCIA_CUENTA_FACIL, online AS TENENCIA_CUENTA_ON,
       payroll AS NOMINA_DOMICILIADA, direct AS INGRESOS_DOMICILIADOS, started AS CONTRATACION_CUENTA_ON, mail AS EMAIL_GESTOR
FROM turning t LEFT JOIN opened ON opened.person = t.person LEFT JOIN income ON income.person = t.person
LEFT JOIN funds ON funds.person = t.person LEFT JOIN domiciled ON domiciled.person = t.person""", parts)


def home_insurance_draft(as_of: _dt.date) -> str:
    parts = [
        ("mail_of", MAIL),
        ("due", f"""SELECT copemk AS person, feprnz, idcoas, copser FROM policies WHERE {NOW}
            AND CAST(feprnz AS DATE) = {date(as_of)} + {P.DRAFT_HOME_LEAD_DAYS}
            AND copser IN ({listed(P.DRAFT_HOME_PRODUCTS)}) AND NOT idcoas IN ({listed(P.DRAFT_HOME_EXCLUDED_ISSUERS)})"""),
        ("profile", f"""SELECT copemk AS person, CAST(cogsmk IS DISTINCT FROM '0' AS INTEGER) AS managed, {any_yes('inlp26')} AS insured,
            {any_yes('in61mk')} AS discount, {any_yes('in77mk')} AS branch, {any_yes('in16mk')} AS insurer, mail
            FROM customer_attrs LEFT JOIN mail_of ON manager = TRY_CAST(cogsmk AS BIGINT) WHERE {NOW}"""),
        ("wages", f"""SELECT copemk AS person, imulig AS wage, {yes(f'copser IN ({listed(P.DRAFT_PAYROLL_SERVICES)})')} AS service
            FROM payroll_amounts WHERE {NOW}"""),
        ("tenure", newest_rows("monthly_board", "process_date", f"""co_cliente AS person,
            {any_yes('in_tensegurauto_mt', 'in_tensegurvehisegurauto_mt')} AS car,
            {any_yes('in_tensegursaludindem_mt', 'in_tensegursaludreemb_mt', 'in_tensegursaludasistsanit_mt')} AS health,
            {any_yes('in_tensegurotrsegurdecenoprimunic_mt', 'in_tensegurotrsegurdeceprimunic_mt')} AS funeral""")),
        ("borrowed", newest_rows("contracting_events", "dt", "co_cliente AS person, 1 AS started")
            + f" AND co_producto_ursus = '{P.DRAFT_CONSUMER_LOAN_PRODUCT}' AND co_empresa_cont = '0'"),
        ("chance", f"""SELECT co_cliente AS person, modelid, max(probabilidad) AS best FROM scores_b
            WHERE modelid IN ({listed(P.DRAFT_HOME_MODELS)}) GROUP BY ALL"""),
    ]
    return with_standins(["policies", "customer_attrs", "managers", "manager_contacts", "payroll_amounts", "monthly_board",
                          "contracting_events", "scores_b"], f"""
SELECT DISTINCT due.person AS ID_URSUS, '{P.JOURNEY_HOME}' AS CODIGO_JOURNEY, feprnz AS FECHA_VEMCIMIENTO,
       idcoas AS EMISOR_SEGURO_HOGAR, copser AS TIPOLOGIA_SEGURO, managed AS OPORTUNIDAD_GESTOR,
       insured AS SEGURO_HOGAR_CARTERA_BANKIA, discount AS DESCUENTO_SEGURO, branch AS CLIENTE_RESERVA_COMERCIAL_RED,
       insurer AS CLIENTE_RESERVA_COMERCIAL_MAPFRE, service AS TENENCIA_SERVICIO_NOMINA, wage AS IMPORTE_NOMINA,
       car AS TENENCIA_SEGURO_AUTO, health AS TENENCIA_SEGURO_SALUD, funeral AS TENENCIA_SEGURO_DECESOS,
       started AS CONTRATACION_PRESTAMO_CONSUMO, if(modelid = '{P.DRAFT_HOME_MODELS[0]}', best, if(modelid IS NULL, NULL, 0)) AS COMPRA_SH_CLIENTE_SINPRESTAMO,
       if(modelid = '{P.DRAFT_HOME_MODELS[1]}', best, if(modelid IS NULL, NULL, 0)) AS COMPRA_SH_CLIENTE_PRESTAMO, mail AS EMAIL_GESTOR
FROM due LEFT JOIN chance ON chance.person = due.person LEFT JOIN borrowed ON borrowed.person = due.person
LEFT JOIN tenure ON tenure.person = due.person LEFT JOIN wages ON wages.person = due.person
LEFT JOIN profile ON profile.person = due.person""", parts)


def own_policy_expiry(as_of: _dt.date) -> str:
    parts = [
        ("due", f"""SELECT copemk, feprnz, idcoas, copser FROM policies WHERE {NOW}
            AND date_diff('day', {date(as_of)}, CAST(feprnz AS DATE)) = {P.DRAFT_HOME_LEAD_DAYS}
            AND copser IN ({listed(P.DRAFT_HOME_PRODUCTS)}) AND NOT idcoas IN ({listed(P.DRAFT_HOME_EXCLUDED_ISSUERS)})"""),
        ("tenure", newest_rows("monthly_board", "process_date", f"""co_cliente AS person,
            {any_yes('in_tensegurauto_mt', 'in_tensegurvehisegurauto_mt')} AS car,
            {any_yes('in_tensegursaludindem_mt', 'in_tensegursaludreemb_mt', 'in_tensegursaludasistsanit_mt')} AS health,
            {any_yes('in_tensegurotrsegurdecenoprimunic_mt', 'in_tensegurotrsegurdeceprimunic_mt')} AS funeral""")),
    ]
    return with_standins(["policies", "monthly_board"], """
SELECT copemk, feprnz, idcoas, copser, car AS TENENCIA_SEGURO_AUTO, health AS TENENCIA_SEGURO_SALUD, funeral AS TENENCIA_SEGURO_DECESOS
FROM due LEFT JOIN tenure ON person = copemk""", parts)
