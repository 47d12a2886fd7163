"""DuckDB SQL for the banking stand-in tables (mirror of rumbo/sources/standins.py).

Each entry is the body of a CTE over the driver's pre-registered views
(customer, orders, lineitem, part, nation, region, events).  Queries list the
CTEs they need through :func:`with_standins`.
"""

from __future__ import annotations

import os

from rumbo.sources.standins import (BRAND_TAX_IDS, EXPIRY_CYCLE, EXPIRY_DAY, MODEL_A, MODEL_B, ORDER_SHIFT_DAYS, QUARTER, QUARTER_DAY,
                                    RECEIPT_CYCLE, RECEIPT_DAY, RECEIPT_TEXT_BY_TYPE, RECEIPT_TEXT_DEFAULT, SECOND_ACCOUNT,
                                    SECOND_PRODUCT, SEGMENT_PRODUCT, THRESHOLD_FACTOR, YEAR)


def case_map(col: str, mapping: dict, default: str = "NULL") -> str:
    def q(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


SHIFT = f"(CAST(o_orderdate AS DATE) + {ORDER_SHIFT_DAYS})"
SHIP_SHIFT = f"(CAST(l_shipdate AS DATE) + {ORDER_SHIFT_DAYS})"
PRIO = "substr(o_orderpriority, 1, 1)"
SEGMENT = case_map("c_mktsegment", SEGMENT_PRODUCT)
CLOSED_IF_F = f"CASE WHEN o_orderstatus = 'F' THEN {SHIFT} END"
CLOSED_BUT = "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 <> {} THEN " + SHIFT + " END"


def entity(key: str) -> str:
    return f"if({key} % 11 = 8, 1, 0)"


def office(key: str) -> str:
    return f"if({key} % 2 = 1, '0002', '0001')"


def status(key: str, n: int = 7, r: int = 6) -> str:
    return f"if({key} % {n} = {r}, 20000, 10000)"


def held(key: str) -> str:
    return f"if({key} % 9 = 4, 'HISTORIC', 'LATEST')"


def older(key: str) -> str:
    return f"if({key} % 8 = 3, 'HISTORIC', 'LATEST')"


def cycle(day: str, anchor, days: int) -> str:
    """First day not before ``day`` at a multiple of ``days`` from ``anchor``."""
    return f"(DATE '{anchor}' - CAST(floor(date_diff('day', {day}, DATE '{anchor}') / {float(days)}) * {days} AS INTEGER))"


def _std(key: str, closed: str = "CAST(NULL AS DATE)") -> str:
    return (f"{entity(key)} AS xcoemp, {status(key)} AS cosiig, {closed} AS ffigco, "
            f"if({key} % 13 = 9, DATE '2023-06-30', NULL) AS feigfi, {held(key)} AS snapshot")


def _pad(c: str, n: int = 12) -> str:
    return f"lpad(CAST({c} AS VARCHAR), {n}, '0')"


VIEWS: dict[str, str] = {}

VIEWS["daily_balance"] = """
SELECT user_id, CAST(ts AS DATE) AS day,
       round(sum(CASE WHEN event_type IN ('purchase', 'error') THEN -value ELSE value END), 2) AS flow
FROM events GROUP BY user_id, CAST(ts AS DATE)"""

# A customer's account, and the second one of every third customer.
VIEWS["accounts"] = f"""
SELECT customer.*, {SEGMENT} AS copser, '0001' AS idcoec, {_pad('c_custkey')} AS idprig, 1 AS place FROM customer
UNION ALL
SELECT customer.*, {case_map('c_mktsegment', SECOND_PRODUCT)}, '0002', {_pad(f'(c_custkey + {SECOND_ACCOUNT})')}, 2 FROM customer WHERE c_custkey % 3 = 0"""

VIEWS["balance_rows"] = f"""
SELECT {entity('c_custkey')} AS xcoemp, copser, idcoec, idprig, c_custkey AS copemk, day AS fevaig,
       if(place = 1, own, round(15 - 0.6 * own, 2)) AS cavt20,
       CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS inz120,
       CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END AS inz121, if(c_custkey % 5 = 0, 1, 0) AS inz122,
       (c_acctbal - 3000) / 10 AS imlimk, if(turn % 7 = 6, 20000, 10000) AS cosiig,
       if(turn % 13 = 9, DATE '2023-06-30', NULL) AS feigfi, if(turn % 17 = 4, DATE '2023-06-30', NULL) AS ffigco,
       strftime(day, '%Y%m%d') AS extractiondate,
       CASE WHEN day = (SELECT max(day) FROM daily_balance) THEN 'LATEST' ELSE 'HISTORIC' END AS snapshot
FROM (SELECT d.day, a.*, a.c_custkey + day(d.day) + 3 * a.place AS turn, round(if(c_custkey % 2 = 0, flow, -flow) + c_custkey % 7 * 3, 2) AS own
      FROM daily_balance d JOIN accounts a ON d.user_id = a.c_custkey // 10) x"""

# Some accounts are in the other snapshot too, with the opposite balance.
VIEWS["account_balance"] = """
SELECT * FROM balance_rows
UNION ALL BY NAME
SELECT * REPLACE (-cavt20 AS cavt20, if(snapshot = 'LATEST', 'HISTORIC', 'LATEST') AS snapshot) FROM balance_rows
WHERE copemk % 4 = if(snapshot = 'LATEST', 1, 2)"""

_HOLDER = f"""if(c_custkey % 19 = 10, DATE '2023-05-31', NULL) AS ffigco, {status('c_custkey', 12, 2)} AS cosiig, {older('c_custkey')} AS snapshot"""
VIEWS["contracts"] = f"""
SELECT {entity('c_custkey')} AS xcoemp, copser, idcoec, idprig, c_custkey AS copemk,
       CASE WHEN c_mktsegment = 'FURNITURE' AND place = 1 THEN '0030' ELSE '0020' END AS coprbs, DATE '2015-01-01' AS fiigco, {_HOLDER}
FROM accounts
UNION ALL
SELECT {entity('c_custkey')}, copser, idcoec, idprig, c_custkey + 1, if(c_custkey % 20 = 11, '0030', '0020'), DATE '2015-01-01', {_HOLDER}
FROM accounts WHERE c_custkey % 10 = 1 AND place = 1
UNION ALL
SELECT {entity('o_orderkey')}, CAST({PRIO} AS INTEGER), {office('o_orderkey')}, {_pad('o_orderkey')}, o_custkey,
       CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 1 THEN '0030' WHEN o_orderstatus = 'O' THEN '0020'
            WHEN o_orderstatus = 'P' THEN '0000' ELSE '0010' END,
       {SHIFT}, {CLOSED_BUT.format(1)}, {status('o_orderkey', 12, 2)}, {older('o_orderkey')}
FROM orders"""

VIEWS["holder_codes"] = "SELECT CAST(r_regionkey * 10 AS VARCHAR) AS coprbs, if(r_regionkey = 3, 'HISTORIC', 'LATEST') AS snapshot FROM region"


def _order_accounts(digit: str, copser: int) -> str:
    return (f"SELECT {copser} AS copser, {office('o_orderkey')} AS idcoec, {_pad('o_orderkey')} AS idprig, o_custkey AS copemk, "
            f"{_std('o_orderkey', CLOSED_BUT.format(2))} FROM orders WHERE {PRIO} = '{digit}'")


VIEWS["fund_contracts"] = _order_accounts("3", 3)
VIEWS["plan_contracts"] = _order_accounts("4", 4)

VIEWS["plan_operations"] = f"""
SELECT 4 AS copser, {office('l_orderkey')} AS idcoec, {_pad('l_orderkey')} AS idprig, {entity('l_orderkey')} AS xcoemp,
       l_extendedprice / 20 AS cacv7j, l_linenumber AS cox1b7,
       {cycle(SHIP_SHIFT, QUARTER_DAY, 2 * YEAR)} AS fecaig, {SHIP_SHIFT} - 40 AS feopen
FROM lineitem"""

VIEWS["payroll_contracts"] = f"SELECT o_custkey AS copemk, {_std('o_orderkey', CLOSED_IF_F)} FROM orders WHERE {PRIO} = '5'"

VIEWS["loans"] = f"""
SELECT o_custkey AS copemk, if(o_orderkey % 13 = 3, 93020, 93010) AS copser, o_totalprice / 100 AS imlppm,
       CAST({SHIFT} + INTERVAL 12 MONTH AS DATE) AS feclpp,
       CASE WHEN o_orderstatus = 'O' THEN 1 WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS inanom,
       if(o_orderkey % 9 = 1, 'BA ', 'AC ') AS coelpp, if(o_orderkey % 11 = 2, 'CA ', 'VI ') AS coespq,
       CASE WHEN o_totalprice > 400000 THEN '99 ' ELSE '01 ' END AS cdtcls, {_std('o_orderkey', f'if(o_orderkey % 29 = 4, {SHIFT}, NULL)')}
FROM orders WHERE {PRIO} = '1'"""

VIEWS["cards"] = f"""
SELECT o_custkey AS copemk, if(o_orderkey % 19 = 7, 0.0, o_totalprice / 1000) AS cacv0d,
       CASE WHEN o_orderstatus = 'P' THEN 'D ' ELSE 'C ' END AS titar3,
       CASE WHEN o_orderstatus = 'F' THEN 50.0 ELSE 100.0 END AS porcpa, {_std('o_orderkey', f'if(o_orderkey % 29 = 4, {SHIFT}, NULL)')}
FROM orders WHERE {PRIO} = '2'"""

BIRTH = "CAST(DATE '1998-03-01' - to_months(CAST(c_nationkey % 2 AS INTEGER)) AS DATE)"

VIEWS["person_board"] = f"""
SELECT c_custkey AS copemk, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 2 ELSE 1 END AS cotpmk,
       CASE WHEN c_acctbal < 0 THEN 0 ELSE 62120 END AS coh004, {BIRTH} AS fenac9,
       CAST(round(c_acctbal * 100) AS BIGINT) AS casfpt, 25 + if(c_custkey % 2 = 0, 1, 0) AS caedad,
       CASE WHEN c_acctbal > 5000 THEN '1' ELSE '0' END AS in82mk,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '1' ELSE '0' END AS in94mk,
       CAST(c_nationkey AS BIGINT) AS cogsmk, {held('c_custkey')} AS snapshot
FROM customer"""

PAD8 = _pad("c_custkey", 8)
VIEWS["customer_rows"] = f"""
SELECT o_orderkey, c_custkey AS id_cliente, {cycle(SHIFT, QUARTER_DAY, YEAR)} AS fecha_derivado,
       CASE WHEN o_orderpriority = '5-LOW' OR o_orderkey % 8 = 3 THEN NULL ELSE '6' || {PAD8} END AS telefono_movil_1,
       CASE WHEN o_orderstatus = 'O' THEN '7' || {PAD8} END AS telefono_movil_2,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE '9' || {PAD8} END AS telefono_fijo,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE '0034' END AS prefijo_telefono_movil_1,
       CASE WHEN o_orderstatus = 'O' THEN '0034' END AS prefijo_telefono_movil_2,
       CASE WHEN o_orderstatus = 'F' THEN '' WHEN o_orderstatus = 'O' THEN 'SI' END AS ds_email,
       c_name AS ds_nombre, c_nationkey + 18 AS edad_cliente, if(c_custkey % 23 = 8, 1, 0) AS entidad, {BIRTH} AS fc_nacimiento,
       CASE WHEN c_acctbal < -500 THEN DATE '2020-06-30' END AS fc_fallecimiento_disolucion,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST({PRIO} AS INTEGER) END AS id_canal_preferido,
       CASE WHEN c_nationkey IN (0, 1) THEN c_nationkey + 700 ELSE 800 END AS id_cartera,
       {_pad('c_nationkey', 5)} AS id_codigo_postal, CAST(c_nationkey AS BIGINT) AS id_gestor,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE substr(CAST(c_nationkey AS VARCHAR), -1, 1) END
           AS id_idioma_preferencia,
       {_pad('c_nationkey', 4)} AS id_oficina, c_mktsegment AS id_segm_soec,
       o_orderpriority AS id_segm_valor_estrategico,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 2 ELSE 1 END AS id_tipo_persona,
       CASE WHEN c_acctbal > 8000 THEN 1 ELSE 0 END AS ind_banca_personal,
       CASE WHEN c_acctbal > 9500 THEN 1 ELSE 0 END AS ind_banca_privada,
       CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS ind_banca_virtual,
       o_orderstatus AS id_clasificacion_actividad,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'S' ELSE 'N' END AS ind_cr_electronica,
       CASE WHEN c_acctbal > 0 THEN 'S' ELSE 'N' END AS ind_disp_moviles,
       if(o_orderkey % 7 = 0, 'N', 'S') AS ind_telemarketing,
       if(o_orderkey % 6 = 1, 0, 1) AS ind_correspondencia_internet,
       202401 AS dt
FROM orders JOIN customer ON o_custkey = c_custkey"""

# The month before has every other order's row, extracted 31 days earlier.
VIEWS["customers_daily"] = """
SELECT * EXCLUDE (o_orderkey) FROM customer_rows WHERE id_cliente % 25 <> 7
UNION ALL BY NAME
SELECT * EXCLUDE (o_orderkey) REPLACE (fecha_derivado - 31 AS fecha_derivado, edad_cliente - 1 AS edad_cliente, 202312 AS dt)
FROM customer_rows WHERE o_orderkey % 2 = 0"""

VIEWS["managers"] = f"""
SELECT CAST(n_nationkey AS BIGINT) AS cogsmk, {_pad('n_regionkey', 4)} AS codice,
       substr(n_name, 1, 3) AS cotgmk, if(n_nationkey % 12 = 7, 'HISTORIC', 'LATEST') AS snapshot FROM nation"""

VIEWS["manager_contacts"] = """
SELECT CAST(n_nationkey AS BIGINT) AS cogrmk, lower(n_name) || '@gestores.es' AS coemai, if(n_nationkey % 12 = 8, 'HISTORIC', 'LATEST') AS snapshot
FROM nation WHERE n_regionkey <> 0"""

VIEWS["customer_attrs"] = f"""
SELECT c_custkey AS copemk,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '1' ELSE '0' END AS in94mk,
       CASE WHEN c_acctbal > 7000 THEN 'S' ELSE 'N' END AS inpx06,
       CASE WHEN c_nationkey > 20 THEN '1' ELSE '0' END AS in16mk,
       CASE WHEN c_nationkey < 10 THEN '1' ELSE '0' END AS inlp26,
       CASE WHEN c_acctbal > 3000 THEN '1' ELSE '0' END AS in61mk,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN '1' ELSE '0' END AS in77mk,
       CASE WHEN c_acctbal < 0 THEN '0' ELSE CAST(c_nationkey AS VARCHAR) END AS cogsmk,
       {entity('c_custkey')} AS xcoemp, {held('c_custkey')} AS snapshot
FROM customer"""

VIEWS["value_managers"] = f"""
SELECT o_custkey AS copemk, o_orderkey AS cogsmk,
       CASE WHEN o_orderstatus <> 'O' THEN {SHIFT} END AS ffcpmk, {held('o_orderkey')} AS snapshot
FROM orders WHERE {PRIO} = '2'"""

RUN_DAY = cycle(SHIFT, QUARTER_DAY, QUARTER)
VIEWS["programme"] = f"""
SELECT o_custkey AS copemk, {RUN_DAY} - if(o_orderkey % 7 = 3, {QUARTER}, 0) AS fevaig,
       CASE WHEN o_totalprice > 400000 THEN 'N' ELSE 'S' END AS marin1, if(o_orderkey % 5 = 0, 'N', 'S') AS marin2,
       if(o_orderstatus = 'F' AND o_orderkey % 3 = 0, 'N', 'S') AS marin3,
       if(o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0, 'N', 'S') AS marin5, if(o_orderkey % 13 = 2, 'N', 'S') AS marin6,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'OTRO ' ELSE 'HIBD2 ' END AS clvpro,
       strftime({RUN_DAY} + CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 WHEN o_orderkey % 3 = 2 THEN -1 ELSE 0 END, '%Y%m%d') AS extractiondate
FROM orders"""

VIEWS["catalogue"] = f"""
SELECT l_linenumber AS copser, l_returnflag AS cdfeco, l_linestatus AS cdseco,
       'FAMILIA ' || l_returnflag AS dsfeco, 'SUBFAMILIA ' || l_linestatus AS dsseco,
       CASE WHEN l_linestatus = 'O' THEN 'EN COMERCIALIZACIÓN' ELSE 'FUERA DE COMERCIALIZACIÓN' END AS especo,
       CASE WHEN l_returnflag = 'R' OR l_partkey % 4 = 1 THEN 'B' ELSE 'A' END AS coesin,
       strftime({SHIP_SHIFT}, '%Y%m%d') AS extractiondate
FROM lineitem"""

VIEWS["dictionary_attrs"] = """
SELECT CAST(r_regionkey AS VARCHAR) AS codam1, CASE WHEN r_regionkey <= 2 THEN 750 ELSE 751 END AS codamk,
       'LATEST' AS snapshot FROM region"""

VIEWS["dictionary_values"] = """
SELECT CAST(n_regionkey AS VARCHAR) AS codamk, CAST(n_nationkey AS VARCHAR) AS coocmk,
       n_regionkey AS coocda, n_name AS noocmk, 'LATEST' AS snapshot FROM nation"""

CUSTOMER = "(user_id * 10 + event_id % 10)"
VIEWS["event_stats"] = f"""
SELECT {CUSTOMER} AS customer, event_type, CAST(ts AS DATE) AS day, max(value) AS vmax
FROM events GROUP BY ALL"""

VIEWS["scores_a"] = f"""
SELECT customer AS idpers, {case_map('event_type', MODEL_A)} AS idmode, vmax / 500 AS nupropen,
       strftime(day, '%Y%m%d') AS extractiondate FROM event_stats"""

VIEWS["scores_b"] = f"""
SELECT customer AS co_cliente, {case_map('event_type', MODEL_B)} AS modelid,
       vmax / 400 AS probabilidad, strftime(day, '%Y%m%d') AS sessionid FROM event_stats"""

VIEWS["type_day_avg"] = """
SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS vavg FROM events GROUP BY event_type, CAST(ts AS DATE)"""

VIEWS["model_thresholds"] = f"""
SELECT {case_map('event_type', MODEL_A)} AS idmode, 'MEDICION' AS iduso, vavg * {THRESHOLD_FACTOR / 500!r} AS nupropenmin,
       strftime(day, '%Y%m%d') AS extractiondate, 'LATEST' AS snapshot FROM type_day_avg
UNION ALL
SELECT {case_map('event_type', MODEL_B)}, 'MEDICION', vavg * {THRESHOLD_FACTOR / 400!r},
       strftime(day, '%Y%m%d'), 'LATEST' FROM type_day_avg
UNION ALL
SELECT {case_map('event_type', MODEL_A)}, 'ENTRENAMIENTO', vavg * 0.0,
       strftime(day, '%Y%m%d'), 'LATEST' FROM type_day_avg
UNION ALL
SELECT {case_map('event_type', MODEL_B)}, 'ENTRENAMIENTO', vavg * 0.0,
       strftime(day, '%Y%m%d'), 'LATEST' FROM type_day_avg
UNION ALL
SELECT {case_map('event_type', MODEL_A)}, 'MEDICION', vavg * {THRESHOLD_FACTOR / 250!r},
       strftime(day + 1, '%Y%m%d'), 'HISTORIC' FROM type_day_avg
UNION ALL
SELECT {case_map('event_type', MODEL_B)}, 'MEDICION', vavg * {THRESHOLD_FACTOR / 200!r},
       strftime(day + 1, '%Y%m%d'), 'HISTORIC' FROM type_day_avg"""

VIEWS["web_hits"] = f"""
SELECT {CUSTOMER} AS id_cliente, ts AS hit_ts, event_id AS hit_id,
       if(event_id % 3 = 0, 'WEB', 'APP') AS co_canal,
       CASE WHEN value >= 30 THEN 'Fondos de Inversion' ELSE 'Planes de Pensiones' END AS tl_familia,
       'particulares' AS tl_seccion0_pagename,
       CASE WHEN event_type = 'error' THEN 'empresas' ELSE event_type END AS tl_seccion1_pagename,
       CASE WHEN event_type = 'purchase' THEN 'mis productos' WHEN event_id % 5 = 0 THEN 'cartera' ELSE 'productos' END AS tl_seccion2_pagename,
       if(event_id % 4 = 0, '', props) AS tl_seccion3_pagename, if(event_id % 2 = 0, 'detalle', NULL) AS tl_seccion4_pagename,
       CASE WHEN event_type = 'signup' THEN 'contratacion' WHEN event_type = 'click' THEN ''
            WHEN event_type = 'view' THEN (CASE WHEN value < 60 THEN 'traspaso fondo'
                                                WHEN value < 120 THEN NULL ELSE 'simulacion' END)
            ELSE 'consulta' END AS tl_proceso_post,
       strftime(CAST(ts AS DATE), '%Y%m') AS dt, strftime(CAST(ts AS DATE), '%Y%m%d') AS fe_adobe_extraction_dia
FROM events"""

_BRANDS = {f"Brand#{i + 1}": t for i, t in enumerate(BRAND_TAX_IDS)}
VIEWS["receipts"] = f"""
SELECT if(o_orderkey % 10 = 7, 0, o_custkey) AS cope14, {cycle(SHIFT, RECEIPT_DAY, RECEIPT_CYCLE)} AS qfaope,
       {case_map('p_type', RECEIPT_TEXT_BY_TYPE, repr(RECEIPT_TEXT_DEFAULT))} AS qncnes,
       upper(p_name) AS qncne1, 'ES00001' || {case_map('p_brand', _BRANDS)} AS idprac,
       CASE WHEN o_orderstatus = 'F' THEN 'DEV' ELSE 'PRE' END AS qcacc7,
       CASE WHEN l_linenumber <= 2 THEN '0606' WHEN l_linenumber <= 4 THEN '0406' ELSE '0101' END AS qcspc1,
       if(o_orderkey % 6 = 3, 4, 3) AS qcopc3, l_extendedprice / 1000 AS qmnopd, {held('o_orderkey')} AS snapshot
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

VIEWS["policies"] = f"""
SELECT o_custkey AS copemk, if(o_orderkey % 3 = 1, 1, 2) AS codsi7,
       CASE {PRIO} WHEN '1' THEN 4 WHEN '2' THEN 7 WHEN '3' THEN 8 WHEN '4' THEN 5 ELSE 9 END AS colnng,
       o_totalprice / 1000 AS imd2c0,
       CASE WHEN o_totalprice > 200000 THEN 25 ELSE 26 END AS cosgri,
       if(o_orderkey % 61 <> 30, {cycle(f'CAST({SHIFT} + INTERVAL 12 MONTH AS DATE)', EXPIRY_DAY, EXPIRY_CYCLE)}, NULL) AS feprnz,
       CASE WHEN o_orderstatus = 'F' THEN '0019' WHEN o_orderstatus = 'P' THEN 'C511'
            WHEN o_orderkey % 4 = 1 THEN '0600' ELSE '0500' END AS idcoas,
       CASE {PRIO} WHEN '4' THEN '43530' WHEN '3' THEN '46100' ELSE '10000' END AS copser,
       {_std('o_orderkey', CLOSED_IF_F)}
FROM orders"""

VIEWS["account_domiciliations"] = f"""
SELECT o_custkey AS copemk,
       CASE {PRIO} WHEN '1' THEN '10600' WHEN '2' THEN '11594' WHEN '3' THEN '11229' ELSE '10300' END AS copser,
       CASE WHEN o_orderstatus = 'O' THEN '702' ELSE '701' END AS coddmc,
       CASE WHEN o_orderstatus = 'F' THEN '20231231' ELSE '20240130' END AS extractiondate
FROM orders"""


def _board(process_date: str, factor: str) -> str:
    return f"""
SELECT c_custkey AS co_codpers_mt, c_custkey AS co_cliente, c_acctbal * {factor} AS im_saldfinmestotvolrecur_mt,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '1' ELSE '0' END AS in_tensegurauto_mt,
       if(c_nationkey = 7, '1', '0') AS in_tensegurvehisegurauto_mt,
       CASE WHEN c_acctbal > 6000 THEN '1' ELSE '0' END AS in_tensegursaludindem_mt,
       if(c_nationkey = 9, '1', '0') AS in_tensegursaludreemb_mt,
       CASE WHEN c_nationkey = 5 THEN '1' ELSE '0' END AS in_tensegursaludasistsanit_mt,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '1' ELSE '0' END AS in_tensegurotrsegurdecenoprimunic_mt,
       if(c_nationkey = 11, '1', '0') AS in_tensegurotrsegurdeceprimunic_mt, '{process_date}' AS process_date
FROM customer"""


VIEWS["monthly_board"] = _board("20231231", "0.5") + " UNION ALL " + _board("20240131", "1.0")

VIEWS["monthly_accounts"] = f"""
SELECT o_custkey AS copemk,
       CASE {PRIO} WHEN '1' THEN '105' WHEN '2' THEN '151' WHEN '3' THEN '200' ELSE '135' END AS co1504,
       CASE WHEN o_orderstatus = 'F' THEN '20231231' ELSE '20240131' END AS extractiondate
FROM orders"""

VIEWS["contracting_events"] = f"""
SELECT o_custkey AS co_cliente,
       CASE {PRIO} WHEN '1' THEN '115594' WHEN '2' THEN '11660' WHEN '3' THEN '11660' ELSE '10000' END AS co_producto_ursus,
       if(o_orderkey % 3 = 0, '1', '0') AS co_empresa_cont,
       strftime({RUN_DAY}, '%Y%m%d') AS dt
FROM orders"""

VIEWS["payroll_amounts"] = f"""
SELECT o_custkey AS copemk, CASE WHEN o_orderstatus = 'O' THEN '32000' ELSE '31000' END AS copser,
       o_totalprice / 100 AS imulig, {held('o_orderkey')} AS snapshot
FROM orders WHERE {PRIO} = '5'"""

# CTEs other CTEs depend on.
DEPENDS = {
    "account_balance": ["daily_balance", "accounts", "balance_rows"],
    "contracts": ["accounts"],
    "customers_daily": ["customer_rows"],
    "scores_a": ["event_stats"],
    "scores_b": ["event_stats"],
    "model_thresholds": ["type_day_avg"],
}


def with_standins(names: list[str], body: str, extra_ctes: list[tuple[str, str]] = ()) -> str:
    """``WITH <stand-in CTEs>, <extra CTEs> <body>``.

    With ``RUMBO_ORACLE_MATERIALIZED=1`` the stand-ins are expected as tables
    (benchmark of the oracle on a materialised warehouse) and only the extra
    CTEs are emitted.
    """
    if os.environ.get("RUMBO_ORACLE_MATERIALIZED") == "1":
        ctes = [f"{n} AS ({q})" for n, q in extra_ctes]
        return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
    order: list[str] = []
    for n in names:
        for d in DEPENDS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in order] + [f"{n} AS ({q})" for n, q in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body
