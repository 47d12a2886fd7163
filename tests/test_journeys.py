"""Journey cases on a hand-built bank, expected rows written by hand."""

import datetime as dt
import hashlib

from bank import Bank

from rumbo import params as P
from rumbo.plans import insurance, overdraft
from rumbo.plans.registered import OWN_EXPIRY_AS_OF, REGISTRY

AS_OF = dt.date(2024, 1, 31)
D30, D29 = dt.date(2024, 1, 30), dt.date(2024, 1, 29)
LATER = dt.date(2024, 2, 5)          # extracted after the run date: never read


def bal(cust, idprig, day, amount, copser=10300, **kw):
    snap = "LATEST" if day == D30 else "HISTORIC"
    return dict(copemk=cust, copser=copser, idprig=idprig, fevaig=day, cavt20=amount,
                extractiondate=day.strftime("%Y%m%d"), snapshot=snap, imlimk=0.0, inz120=0, inz121=0, inz122=0, **kw)


def holder(cust, idprig, copser=10300, coprbs="0020", **kw):
    return dict(copemk=cust, copser=copser, idprig=idprig, coprbs=coprbs, fiigco=dt.date(2015, 1, 1), **kw)


def person(cust, cotpmk=1, coh004=62120):
    return dict(copemk=cust, cotpmk=cotpmk, coh004=coh004, fenac9=dt.date(1990, 1, 1), casfpt=0, caedad=30)


def test_overdraft_journey_cases(spark):
    balances = [
        bal(1, "000000000011", D30, -50.0), bal(1, "000000000011", D29, 10.0),   # new overdraft: in
        bal(1, "000000000012", D30, 100.0),                                       # other account covers it
        bal(2, "000000000021", D30, -50.0), bal(2, "000000000021", D29, 0.0),     # day before not > 0: out
        bal(3, "000000000031", D30, -50.0), bal(3, "000000000031", D29, 5.0),     # two new overdrafts:
        bal(3, "000000000032", D30, -200.0), bal(3, "000000000032", D29, 5.0),    #   keep the deepest
        bal(4, "000000000041", D30, -50.0), bal(4, "000000000041", D29, 5.0),     # legal person: out
        bal(5, "000000000051", D30, -50.0), bal(5, "000000000051", D29, 5.0),     # closed contract: out
        bal(6, "000000000061", D30, -50.0), bal(6, "000000000061", D29, 5.0),     # not principal: out
    ]
    contracts = [holder(1, "000000000011"), holder(1, "000000000012"), holder(2, "000000000021"),
                 holder(3, "000000000031"), holder(3, "000000000032"), holder(4, "000000000041"),
                 holder(5, "000000000051", ffigco=dt.date(2024, 1, 1)), holder(6, "000000000061", coprbs="0030")]
    people = [person(1), person(2), person(3), person(4, cotpmk=2), person(5), person(6)]
    cards = [dict(copemk=1, cacv0d=100.0, titar3="C ", porcpa=100.0)]
    loans = [dict(copemk=3, copser=93010, imlppm=1000.0, feclpp=dt.date(2025, 1, 1), inanom=1, coelpp="AC ",
                  coespq="VI ", cdtcls="01 "),
             dict(copemk=3, copser=93010, imlppm=500.0, feclpp=dt.date(2023, 1, 1), inanom=3, coelpp="AC ",
                  coespq="VI ", cdtcls="01 ")]
    scores_a = [dict(idpers=1, idmode="PCONSLPP02", nupropen=0.9, extractiondate="20240130"),
                dict(idpers=3, idmode="PCONSLPP02", nupropen=0.4, extractiondate="20240130")]
    scores_b = [dict(co_cliente=3, modelid="MCOCLFX1", probabilidad=0.7, sessionid="20240130"),
                dict(co_cliente=1, modelid="MCOCLFX1", probabilidad=0.99, sessionid="20240129")]
    thresholds = [dict(idmode="PCONSLPP02", iduso="MEDICION", nupropenmin=0.5, extractiondate="20240130"),
                  dict(idmode="PCONSLPP02", iduso="ENTRENAMIENTO", nupropenmin=0.1, extractiondate="20240130"),
                  dict(idmode="MCOCLFX1", iduso="MEDICION", nupropenmin=0.6, extractiondate="20240130"),
                  dict(idmode="MCOCLFX1", iduso="MEDICION", nupropenmin=0.0, extractiondate="20240129"),
                  dict(idmode="PCONSLPP02", iduso="MEDICION", nupropenmin=0.0, extractiondate="20240205")]
    scores_a.append(dict(idpers=3, idmode="PCONSLPP02", nupropen=0.9, extractiondate="20240205"))
    bank = Bank(spark, account_balance=balances, contracts=contracts, person_board=people, cards=cards,
                loans=loans, scores_a=scores_a, scores_b=scores_b, model_thresholds=thresholds)
    got = sorted(tuple(r) for r in overdraft.overdraft_journey(bank, AS_OF).collect())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    want = sorted([
        (1, "0011", 1, 1, 1, 0, 1, 0, md5("103000000000000011")),
        # customer 3: deepest account, two loan rows as the loans are grouped (one valid, one expired)
        (3, "0032", 0, 1, 0, 1, 1, 1, md5("103000000000000032")),
        (3, "0032", 0, 1, 0, 0, 1, 0, md5("103000000000000032")),
    ])
    assert got == want


def receipt(cust, text1, text2, tax_id, paid=dt.date(2023, 3, 31), amount=50.0, **kw):
    return dict(cope14=cust, qfaope=paid, qncnes=text1, qncne1=text2, idprac="ES00001" + tax_id,
                qcacc7="PRE", qcspc1="0606", qcopc3=3, qmnopd=amount, **kw)


def policy(cust, branch, amount, cosgri=25, codsi7=1):
    return dict(copemk=cust, codsi7=codsi7, colnng=branch, imd2c0=amount, cosgri=cosgri)


def test_home_insurance_cases(spark):
    receipts = [
        receipt(101, "SEGURO HOGAR ", "PISO CENTRO", "A28007748"),        # in
        receipt(102, "HOGAR AUTO ", "PISO CENTRO", "A28007748"),          # car text: out
        receipt(103, "SEGURO HOGAR ", "PISO", "A28007748"),               # 17 characters: out
        receipt(104, "SEGURO HOGAR ", "PISO CENTRO", "A28013050"),        # CASER + own home policy: out
        receipt(105, "SEGURO HOGAR ", "PISO CENTRO", "A28141935"),        # mapped, not allowed: out
        receipt(106, "SEGURO HOGAR ", "PISO CENTRO", "A28007748", paid=dt.date(2023, 3, 30)),  # other day
        receipt(107, "hogar ", "familiar grande", "A60917978"),            # in, with own policies
        receipt(108, "SEGURO HOGAR ", "PISO CENTRO", "A28007748"),        # legal person: out
        receipt(109, "SEGURO HOGAR ", "PISO CENTRO", "A28007748", amount=30.0),  # amount not > 30: out
    ]
    policies = [policy(104, 5, 100.0), policy(107, 4, 250.0), policy(107, 7, 100.0), policy(107, 8, 70.0),
                policy(107, 8, 90.0, cosgri=26)]
    people = [person(c) for c in range(101, 110) if c != 108] + [person(108, cotpmk=2)]
    bank = Bank(spark, receipts=receipts, policies=policies, person_board=people)
    got = sorted(tuple(r) for r in insurance.home_insurance_expiry(bank, AS_OF).collect())
    assert got == [(101, dt.date(2024, 3, 31), 0, 0, 0, 0), (107, dt.date(2024, 3, 31), 1, 1, 0, 1)]


def test_young_retention_cases(spark):
    from rumbo.plans import youth
    born, other = dt.date(1998, 3, 1), dt.date(1998, 3, 2)       # turns 26 on as_of + 30 days, or not
    accounts = [(1, "00000000001A", 11594), (1, "00000000001B", 10300), (2, "000000000002", 11239),
                (3, "000000000003", 11239), (4, "000000000004", 11594), (5, "000000000005", 10600),
                (6, "000000000006", 11594)]
    balances = [bal(c, i, D30, 10.0, copser=p) for c, i, p in accounts] + [bal(1, "00000000001A", D29, 5.0, copser=11594)]
    balances.append(bal(1, "00000000001A", LATER, 5.0, copser=11594))
    contracts = [holder(c, i, copser=p) for c, i, p in accounts]
    people = [dict(person(c, cotpmk=2 if c == 6 else 1), fenac9=other if c == 2 else born,
                   casfpt=123456 if c == 1 else 1000) for c in range(1, 7)]
    prog = lambda c, m1="S", day=dt.date(2024, 1, 20): dict(
        copemk=c, fevaig=day, marin1=m1, marin2="S", marin3="S", marin5="S", marin6="S", clvpro="HIBD2 ",
        extractiondate=day.strftime("%Y%m%d"))
    programme = [prog(1), prog(3, m1="N"), prog(5, day=dt.date(2024, 1, 10)), prog(1, m1="N", day=LATER)]
    digital = dict(telefono_movil_1="600000000", ds_email="SI", ind_cr_electronica="S", ind_disp_moviles="S",
                   ind_telemarketing="S", ind_correspondencia_internet=1, dt=202401)
    customers = [dict(digital, id_cliente=4, fecha_derivado=D30), dict(digital, id_cliente=5, fecha_derivado=D30),
                 dict(digital, id_cliente=1, fecha_derivado=D30, ds_email="NO"),
                 dict(digital, id_cliente=1, fecha_derivado=LATER)]
    payroll = [dict(copemk=1)]
    bank = Bank(spark, account_balance=balances, contracts=contracts, person_board=people, programme=programme,
                customers_daily=customers, payroll_contracts=payroll)
    got = sorted(tuple(r) for r in youth.young_retention(bank, AS_OF).collect())
    assert got == [
        # holder 1: ON + easy account, passing programme row, payroll; not all ON/young
        (1, "JR000002", born, 1234.56, "S", "S", "S", "S", "S", 1, 0, 2, 1, 0, 1, 0),
        # holder 5: only an easy account, so the digital-profile exclusion does not apply
        (5, "JR000002", born, 10.0, None, None, None, None, None, 0, 1, 1, 0, 0, 1, 0),
    ]


def test_young_retention_shared_account_excluded_by_other_holder(spark):
    from rumbo.plans import youth
    born = dt.date(1998, 3, 1)
    balances = [bal(7, "000000000078", D30, 10.0, copser=11594), bal(9, "000000000009", D30, 10.0, copser=11594)]
    contracts = [holder(7, "000000000078", copser=11594), holder(8, "000000000078", copser=11594),
                 holder(9, "000000000009", copser=11594)]
    people = [dict(person(7), fenac9=born), dict(person(8), fenac9=dt.date(1980, 5, 5)), dict(person(9), fenac9=born)]
    programme = [dict(copemk=8, fevaig=dt.date(2024, 1, 20), marin1="N", marin2="S", marin3="S", marin5="S",
                      marin6="S", clvpro="HIBD2 ", extractiondate="20240120")]
    bank = Bank(spark, account_balance=balances, contracts=contracts, person_board=people, programme=programme)
    got = [r.ID_URSUS for r in youth.young_retention(bank, AS_OF).collect()]
    # account 78 is held by 7 (milestone) and 8 (fails a criterion): excluded for both holders
    assert sorted(got) == [9]


def hit(cust, process, s3, day="20240130", s1="particulares", s2="productos", canal="WEB"):
    return dict(id_cliente=cust, co_canal=canal, tl_familia="Fondos de Inversion", tl_seccion0_pagename="home",
                tl_seccion1_pagename=s1, tl_seccion2_pagename=s2, tl_seccion3_pagename=s3,
                tl_proceso_post=process, dt=day[:6], fe_adobe_extraction_dia=day)


def test_fund_interest_cases(spark):
    from rumbo.plans import web_interest
    hits = [
        hit(1, "contratacion", "x"), hit(1, "abc", "y"), hit(1, "", "z"),     # 'abc' sorts first, '' last
        hit(2, "traspaso fondo", "x"), hit(2, None, "x"),                     # excluded process; NULL fails NOT IN
        hit(3, "abc", "x", s1="empresas"),                                    # business section: out
        hit(4, "abc", "x", day="20240129"),                                   # not the newest web day: out
        hit(5, "simulacion", ""), hit(5, "simulacion", "b"),                  # empty section sorts last
        hit(6, "abc", "x"), hit(7, "abc", "x"),                               # legal person / inactive: out
    ]
    people = [person(c) for c in range(1, 6)] + [person(6, cotpmk=2), person(7, coh004=0)]
    funds = [dict(copser=3, idprig="F1", copemk=1), dict(copser=3, idprig="F2", copemk=1),
             dict(copser=3, idprig="F5", copemk=5)]
    contracts = [holder(1, "F1", copser=3), holder(1, "F2", copser=3), holder(5, "F5", copser=3, coprbs="0000")]
    codes = [dict(coprbs="20")]
    scores_a = [dict(idpers=5, idmode="FIAPOR1", nupropen=0.9, extractiondate="20240130")]
    scores_b = [dict(co_cliente=1, modelid="MFOGENU1", probabilidad=0.3, sessionid="20240130")]
    thresholds = [dict(idmode="FIAPOR1", iduso="MEDICION", nupropenmin=0.5, extractiondate="20240130"),
                  dict(idmode="MFOGENU1", iduso="MEDICION", nupropenmin=0.6, extractiondate="20240130")]
    bank = Bank(spark, web_hits=hits, person_board=people, fund_contracts=funds, contracts=contracts,
                holder_codes=codes, scores_a=scores_a, scores_b=scores_b, model_thresholds=thresholds)
    got = sorted(tuple(r) for r in web_interest.fund_interest(bank, AS_OF).collect())
    assert got == [
        (1, 1, 0, "WEB", "particulares", "productos", "y", "abc"),    # two fund accounts: one row each
        (1, 1, 0, "WEB", "particulares", "productos", "y", "abc"),
        (5, 0, 1, "WEB", "particulares", "productos", "b", "simulacion"),   # '0000' is no holder code
    ]


def test_pension_interest_contribution_limit(spark):
    from rumbo.plans import web_interest
    hits = [dict(hit(c, p, "x"), tl_familia="Planes de Pensiones") for c, p in ((1, ""), (2, "abc"), (3, "abc"))]
    people = [person(c) for c in (1, 2, 3)]
    plans = [dict(copser=4, idprig=f"P{c}", copemk=c) for c in (1, 2, 3)]
    contracts = [holder(c, f"P{c}", copser=4) for c in (1, 2, 3)]
    op = lambda acc, amount, kind, paid, opened=None: dict(
        copser=4, idprig=acc, cacv7j=amount, cox1b7=kind, fecaig=paid, feopen=opened or paid)
    ops = [op("P1", 6999.0, 1, dt.date(2024, 1, 10)),                                   # 6,999: under the limit
           op("P2", 5000.0, 1, dt.date(2024, 1, 5)),
           op("P2", 2000.0, 2, dt.date(2023, 12, 1), dt.date(2024, 1, 2)),                # counted by opening year
           op("P2", 100.0, 3, dt.date(2024, 1, 5)),                                     # not a contribution type
           op("P3", 50.0, 1, dt.date(2023, 6, 1))]                                      # previous year only
    bank = Bank(spark, web_hits=hits, person_board=people, plan_contracts=plans, contracts=contracts,
                holder_codes=[dict(coprbs="20")], plan_operations=ops)
    got = sorted(tuple(r) for r in web_interest.pension_interest(bank, AS_OF).collect())
    assert got == [
        (1, 1, 1, 0, "WEB", "particulares", "productos", "x", ""),
        (2, 1, 0, 0, "WEB", "particulares", "productos", "x", "abc"),    # exactly 7,000: not under
        (3, 1, 0, 0, "WEB", "particulares", "productos", "x", "abc"),    # no contribution this year
    ]


def test_contract_core_bounds_and_codes(spark):
    from rumbo.plans import core
    c = lambda cust, code, start, **kw: dict(copemk=cust, copser=1, idprig=f"{cust:012d}", coprbs=code,
                                            fiigco=start, **kw)
    contracts = [c(1, "0020", dt.date(2024, 1, 31)),                        # today: both loads
                 c(2, "20", dt.date(2024, 1, 30)),                          # yesterday: initial only
                 c(3, "000", dt.date(2024, 1, 31)),                         # '000' -> '' is no holder code
                 c(4, "0020", dt.date(2023, 10, 31)),                       # exactly 3 months ago: strict >
                 c(5, "0020", dt.date(2023, 11, 1)),
                 c(6, "0020", dt.date(2024, 1, 31), ffigco=dt.date(2024, 1, 31))]   # closed
    cat = lambda day, fam: dict(copser=1, cdfeco=fam, cdseco="x", dsfeco=f"FAM {fam}", dsseco="SUB x",
                                especo="EN COMERCIALIZACIÓN", coesin="A", extractiondate=day)
    catalogue = [cat("20240125", "A"), cat("20240130", "B"), cat("20240201", "C"),   # future extraction ignored
                 dict(cat("20240131", "D"), coesin="B")]                             # not active
    bank = Bank(spark, contracts=contracts, holder_codes=[dict(coprbs="20")], catalogue=catalogue,
                dictionary_attrs=[dict(codam1="0", codamk=750)],
                dictionary_values=[dict(codamk="0", coocmk="1", coocda=0, noocmk="CUENTA UNO")])
    row = lambda cust, code, start: (1, "CUENTA UNO", code, cust, "B", "x", "FAM B", "SUB x", start)
    initial = sorted(tuple(r) for r in core.contract_initial_load(bank, AS_OF).collect())
    daily = sorted(tuple(r) for r in core.contract_daily_load(bank, AS_OF).collect())
    assert initial == sorted([row(1, "0020", dt.date(2024, 1, 31)), row(2, "20", dt.date(2024, 1, 30)),
                              row(5, "0020", dt.date(2023, 11, 1))])
    assert daily == [row(1, "0020", dt.date(2024, 1, 31))]


def test_customer_core_cases(spark):
    from rumbo.plans import core
    base = dict(dt=202401, entidad=0, id_tipo_persona=1, ds_nombre="n", id_cartera=800)
    cust = lambda c, day, **kw: dict(base, id_cliente=c, fecha_derivado=day, **kw)
    customers = [
        cust(1, dt.date(2024, 1, 10), ds_email="SI", telefono_movil_1="611", id_idioma_preferencia="2",
             prefijo_telefono_movil_1="0034", id_gestor=7),
        cust(1, dt.date(2024, 1, 20), ds_email="", telefono_movil_2="622", id_idioma_preferencia="42",
             id_gestor=7),                                                   # newest row wins
        cust(2, dt.date(2024, 1, 20), id_cartera=700, prefijo_telefono_movil_2="0034", id_gestor=8),
        cust(3, dt.date(2024, 1, 20), fc_fallecimiento_disolucion=dt.date(2023, 5, 1)),   # deceased
        dict(cust(4, dt.date(2024, 1, 20)), id_tipo_persona=2),                         # legal person
        dict(cust(5, dt.date(2024, 1, 20)), entidad=1),                                 # another entity
    ]
    bank = Bank(spark, customers_daily=customers,
                managers=[dict(cogsmk=7, codice="0001", cotgmk="T1"), dict(cogsmk=8, codice="0002", cotgmk="T2")],
                manager_contacts=[dict(cogrmk=7, coemai="g7@x")],                  # manager 8 has no contact
                customer_attrs=[dict(copemk=1, in94mk="1", inpx06="S", in16mk="0")],
                value_managers=[dict(copemk=1, cogsmk=101), dict(copemk=1, cogsmk=102),
                                dict(copemk=2, cogsmk=201, ffcpmk=dt.date(2023, 1, 1))])
    cols = ["idcliente", "prefijo_mv", "tfno_movil", "tfno_fijo", "tenencia_email", "canal_preferido",
            "idioma_preferencia", "indConectaTuExperto", "indbancavirtual", "cod_gestor", "mailgestor",
            "cod_centro", "tipogestor", "Precarterizado", "CodGestor_Valor"]
    got = sorted(tuple(r) for r in core.customer_core(bank, AS_OF).select(*cols).collect())
    assert got == [
        (1, "", "622", "", "NO", 0, "ES", 0, 0, 7, "g7@x", "0001", "T1", "1", 101),   # value managers fan out
        (1, "", "622", "", "NO", 0, "ES", 0, 0, 7, "g7@x", "0001", "T1", "1", 102),
        (2, "34", "", "", "NO", 0, "ES", 1, 0, 0, "0", "0", "0", None, None),
    ]


def test_overdraft_master_days_and_covers(spark):
    from rumbo.plans import overdraft
    d = lambda day: dt.date(2024, 1, day)
    balances = [bal(1, "00000000000A", D30, -50.0), bal(1, "00000000000A", d(27), 10.0),
                bal(1, "00000000000A", d(28), -5.0), bal(1, "00000000000A", d(29), -5.0),   # 3 days overdrawn
                bal(2, "00000000000B", D30, -20.0), bal(2, "00000000000B", d(20), -1.0),
                bal(2, "00000000000B", d(10), 5.0),                                         # outside 15 days: dropped
                bal(3, "00000000000C", D30, -30.0), bal(3, "00000000000C", d(29), 0.0)]     # zero counts: 1 day
    contracts = [holder(c, i) for c, i in ((1, "00000000000A"), (2, "00000000000B"), (3, "00000000000C"))]
    people = [person(c) for c in (1, 2, 3)]
    loans = [dict(copemk=1, copser=93010, imlppm=100.0, feclpp=dt.date(2025, 1, 1), inanom=2, coelpp="AC ",
                  coespq="VI ", cdtcls="01 ")]
    cards = [dict(copemk=3, cacv0d=10.0, titar3="C ", porcpa=100.0)]
    bank = Bank(spark, account_balance=balances, contracts=contracts, person_board=people, loans=loans, cards=cards)
    got = sorted(tuple(r) for r in overdraft.overdraft_master(bank, AS_OF).collect())
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert got == [
        (1, "00000000000A", 3, 1, 0, 1, md5("10300000000000000A"), D30),
        (3, "00000000000C", 1, 0, 1, 0, md5("10300000000000000C"), D30),
    ]


def test_young_retention_draft_cases(spark):
    from rumbo.plans import drafts
    run = dt.date(2024, 2, 1)                  # birthdays on the same day next month, 26 years
    people = [dict(person(1), fenac9=dt.date(1998, 3, 1), in82mk="1", in94mk="0", cogsmk=7),
              dict(person(2), fenac9=dt.date(1998, 3, 2), in82mk="0", in94mk="0", cogsmk=7),   # other day
              dict(person(3), fenac9=dt.date(1997, 12, 1), in82mk="0", in94mk="0", cogsmk=7)]  # December branch
    dom = [dict(copemk=1, copser="10600", coddmc="702", extractiondate="20240130"),
           dict(copemk=1, copser="11229", coddmc="702", extractiondate="20240130"),
           dict(copemk=1, copser="11594", coddmc="702", extractiondate="20231231")]           # older extraction
    board = [dict(co_codpers_mt=1, co_cliente=1, im_saldfinmestotvolrecur_mt=100.0, process_date="20240131"),
             dict(co_codpers_mt=1, co_cliente=1, im_saldfinmestotvolrecur_mt=50.0, process_date="20231231")]
    monthly = [dict(copemk=1, co1504="105", extractiondate="20240131")]
    events = [dict(co_cliente=1, co_producto_ursus="115594", co_empresa_cont="0", dt="20240130")]
    for rows in (dom, monthly):
        rows.append(dict(rows[0], extractiondate="20240205"))
    board.append(dict(board[0], im_saldfinmestotvolrecur_mt=1.0, process_date="20240229"))
    events.append(dict(events[0], dt="20240205"))
    bank = Bank(spark, person_board=people, managers=[dict(cogsmk=7, codice="0001", cotgmk="T")],
                manager_contacts=[dict(cogrmk=7, coemai="g7@x")], account_domiciliations=dom,
                monthly_board=board, monthly_accounts=monthly, contracting_events=events)
    got = sorted(tuple(r) for r in drafts.young_retention_draft(bank, run).collect())
    born = dt.date(1998, 3, 1)
    assert got == sorted([
        (1, "JR000002", born, 1, 0, 100.0, 1, 0, 0, 1, 1, "g7@x"),     # easy account domiciled
        (1, "JR000002", born, 1, 0, 100.0, 0, 0, 1, 1, 1, "g7@x"),     # payroll product domiciled
    ])


def test_home_insurance_draft_cases(spark):
    from rumbo.plans import drafts
    due = dt.date(2024, 3, 27)                 # run date + 56 days
    pol = lambda c, copser="43530", issuer="0500", expiry=due: dict(
        copemk=c, copser=copser, idcoas=issuer, feprnz=expiry, colnng=5, codsi7=1)
    policies = [pol(1), pol(2, issuer="0019"), pol(3, copser="10000"), pol(4, expiry=dt.date(2024, 3, 28))]
    board = [dict(co_cliente=1, co_codpers_mt=1, in_tensegurauto_mt="1", process_date="20240131"),
             dict(co_cliente=1, co_codpers_mt=1, in_tensegurotrsegurdecenoprimunic_mt="1", process_date="20231231")]
    events = [dict(co_cliente=1, co_producto_ursus="11660", co_empresa_cont="0", dt="20240130")]
    scores = [dict(co_cliente=1, modelid="MSGHCHX1", probabilidad=0.4, sessionid="20240101"),
              dict(co_cliente=1, modelid="MSGHCHX1", probabilidad=0.7, sessionid="20240102"),
              dict(co_cliente=1, modelid="MSGHSHX1", probabilidad=0.2, sessionid="20240102")]
    bank = Bank(spark, policies=policies,
                customer_attrs=[dict(copemk=1, cogsmk="7", inlp26="1", in61mk="0", in77mk="0", in16mk="1")],
                managers=[dict(cogsmk=7, codice="0001", cotgmk="T")], manager_contacts=[dict(cogrmk=7, coemai="g7@x")],
                payroll_amounts=[dict(copemk=1, copser="32000", imulig=1500.0)],
                monthly_board=board, contracting_events=events, scores_b=scores)
    got = sorted(tuple(r) for r in drafts.home_insurance_draft(bank, AS_OF).collect())
    head = (1, "JR000001", due, "0500", "43530", 1, 1, 0, 0, 1, 1, 1500.0, 1, 0, 0, 1)
    # one row per propensity model (max score of each), as the draft joins them
    assert got == sorted([head + (0.7, 0.0, "g7@x"), head + (0.0, 0.2, "g7@x")])


def test_month_end_receipts_follow_the_hive_rule(spark):
    from rumbo.operators.insurance import expiring_receipts
    from rumbo.plans.core import add_months_date
    paid = [dt.date(2023, 4, 28), dt.date(2023, 4, 29), dt.date(2023, 4, 30)]
    bank = Bank(spark, receipts=[receipt(i + 1, "SEGURO HOGAR", "", P.INSURER_TAX_IDS_ALLOWED[0], paid=x) for i, x in enumerate(paid)])
    due = lambda day, rule: sorted((r.Persona, r.FECHA_VENCIMIENTO) for r in expiring_receipts(
        bank.receipts, day, rule).collect())
    assert due(dt.date(2024, 2, 29), "last_day") == [(3, dt.date(2024, 4, 30))]
    assert due(dt.date(2024, 2, 29), "clamp") == [(2, dt.date(2024, 4, 29))]
    assert add_months_date(dt.date(2024, 2, 29), -3) == dt.date(2023, 11, 30)
    assert add_months_date(dt.date(2023, 2, 28), -3) == dt.date(2022, 11, 30)
    assert add_months_date(dt.date(2024, 2, 29), -3, "clamp") == dt.date(2023, 11, 29)
    assert add_months_date(dt.date(2024, 5, 31), -3) == dt.date(2024, 2, 29)


def test_own_policy_expiry_has_rows(spark, sf_dir):
    """D38 and D40 have a key of their own that selects rows of the stand-ins."""
    rows = REGISTRY["own_policy_expiry"](spark, sf_dir).collect()
    due = OWN_EXPIRY_AS_OF + dt.timedelta(days=P.DRAFT_HOME_LEAD_DAYS)
    assert rows and {r["feprnz"] for r in rows} == {due} and {r["copser"] for r in rows} <= set(P.DRAFT_HOME_PRODUCTS)
    flags = {f: {r[f] for r in rows} for f in ("TENENCIA_SEGURO_AUTO", "TENENCIA_SEGURO_SALUD", "TENENCIA_SEGURO_DECESOS")}
    assert all(v <= {0, 1, None} for v in flags.values()) and any(v - {None} for v in flags.values()), flags
