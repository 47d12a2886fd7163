"""Business rules as data.

Every journey reads its codes, thresholds, lists and patterns from here, so a
rule change is a data change.  The values in the FIXED VALUES section must
equal the bank's published rules for the journeys to select the same
customers; they are written out plainly and in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source rules; do not edit to make tests pass)
# ---------------------------------------------------------------------------

ENTITY = 0                      # xcoemp / entidad of the bank itself
STATUS_ACTIVE = 10000           # cosiig of a live contract
RELATION_PRINCIPAL = 20         # coprbs of the principal holder
PERSON_NATURAL = 1              # cotpmk / id_tipo_persona of a natural person
PERSON_ACTIVE_CODE = 62120      # coh004 of an active customer
SNAPSHOT_LATEST = "LATEST"
SNAPSHOT_HISTORIC = "HISTORIC"

# Customer core: language code -> label, anything else 'ES'.
LANGUAGE_LABELS = {
    "1": "ES", "2": "GL", "3": "CA", "4": "EU", "5": "VALENCIANO",
    "6": "EN", "7": "DE", "8": "FR", "9": "PT",
}
LANGUAGE_DEFAULT = "ES"
EXPERT_PORTFOLIOS = (700, 701)          # id_cartera -> indConectaTuExperto
MOBILE_PREFIX = "34"

# Contract core.
DICTIONARY_ATTRIBUTE = 750              # igq_dato.codamk of product names
CATALOGUE_ON_SALE = "EN COMERCIALIZACIÓN"
CATALOGUE_ACTIVE = "A"
CATALOGUE_WINDOW_DAYS = 15
INITIAL_LOAD_MONTHS = 3
DAILY_LOAD_DAYS = 1

# Overdraft journeys.
OVERDRAFT_HISTORY_DAYS = 15
LOAN_PRODUCT = 93010
LOAN_STATE = "AC"
LOAN_SUBSTATE = "VI"
LOAN_EXCLUDED_CLASS = "99"
PAYROLL_ADVANCE_CODES = (1, 2)
CARD_TYPE_CREDIT = "C"
CARD_OWNERSHIP_FULL = 100
MODEL_USE = "MEDICION"
OVERDRAFT_MODEL_SCORES_A = "PCONSLPP02"
OVERDRAFT_MODEL_SCORES_B = "MCOCLFX1"

# Web-interest journeys.
WEB_FAMILY_FUNDS = "Fondos de Inversion"
WEB_FAMILY_PENSIONS = "Planes de Pensiones"
WEB_EXCLUDED_SECTION1 = "empresas"
WEB_EXCLUDED_SECTION2 = "mis productos"
WEB_PRIORITY_PROCESS = "contratacion"
FUND_EXCLUDED_PROCESSES = (
    "aportacion nacional fondo", "movilizacion externa fondo",
    "reembolso nacional fondo", "traspaso fondo",
)
FUND_MODELS_A = ("FIAPOR1", "TNFIASE01", "TNFIMRF01", "TRENTFI01", "XSFIGAR01", "XSFIRF01")
FUND_MODELS_B = ("MFOGENU1", "MFOTRAU1", "MFOTRAX1")
PENSION_MODELS_A = ("APORTPP01", "INCRAPOR01", "PPEN01", "TRENTPEN01")
PENSION_MODELS_B = ("MPDPENU1", "MPPGENX1", "MPPTRAX1")
CONTRIBUTION_OPERATION_TYPES = (1, 2)
CONTRIBUTION_LIMIT = 7000

# Young-customer retention.
JOURNEY_YOUNG = "JR000002"
YOUTH_PRODUCT_ON = 11594
YOUTH_PRODUCT_YOUNG = 11239
YOUTH_PRODUCTS_EASY = (10300, 10600)
YOUTH_PRODUCTS = (10300, 10600, 11594, 11239)
MILESTONE_MONTHS = 312          # 26 years
MILESTONE_LEAD_DAYS = 30
PROGRAMME_KEY = "HIBD2"
# Draft variant of the young journey.
DRAFT_DOMICILED_PRODUCTS = ("10600", "11594", "11229")
DRAFT_DOMICILE_OFFICE = "702"
DRAFT_INCOME_CODES = ("105", "151", "154", "135")
DRAFT_ON_CONTRACTING_PRODUCT = "115594"
DRAFT_AGE_YEARS = 26

# Home-insurance expiry.
JOURNEY_HOME = "JR000001"
RECEIPT_PREPAID = "PRE"
RECEIPT_TYPES = ("0606", "0406")
RECEIPT_OPERATION = 3
RECEIPT_MIN_AMOUNT = 30
RECEIPT_AGE_MONTHS = 10
RECEIPT_MAX_AGE_DAYS = 540
POLICY_TERM_MONTHS = 12
RECEIPT_MIN_TEXT = 20
TAX_ID_START, TAX_ID_LEN = 8, 14
HOME_LABEL = "AUTO"             # label given to home receipts (only NOT NULL matters)

# Receipt text rules: a home receipt matches any include and no exclude
# pattern (LIKE, case sensitive).
HOME_INCLUDE_PATTERNS = (
    "%HOGAR%", "%hogar%", "%FAMILIA-HOGAR%", "%MULTIRRIESGO%", "%VIVIENDA%",
    "%CL/%", "%SEGURO.HOG%", "%MULTI RIESGO%",
)
HOME_EXCLUDE_PATTERNS = (
    "%AUTO%", "%MOTO%", "%VEHICULO%", "%RESP. CIVIL OBLIGATORIA Y ASISTENCIA EN%",
    "%SEG.OBL%", "%MAT%", "%Matr%", "%autos%", "%SALUD%", "%DECESOS%", "VIDA",
    "%VIDA%", "%INC. RESP.%", "%ACCIDENTE%", "%EMPRESA%",
)

# Insurer tax id -> insurer name (one entry per id; several ids may share a name).
INSURER_BY_TAX_ID = {
    "A58333261": "VIDACAIXA",
    "A78510138": "BANKINTER VIDA",
    "A85078301": "VERTI",
    "A16029191": "CCM VIDA Y PENSIONES",
    "A78801172": "BANKINTER SEGUROS GENERALES",
    "V28027118": "MUTUA MADRILEÑA",
    "A86007572": "MM HOGAR",
    "A28011864": "SEGURCAIXA ADESLAS",
    "A08168213": "ZURICH",
    "A28007748": "ALLIANZ",
    "A80029150": "FENIX",
    "A78694197": "ALLIANZ VIDA",
    "A28119220": "CATALANA OCCIDENTE ",
    "A30014831": "PLUS ULTRA SEGUROS",
    "A48001648": "SEGUROS BILBAO",
    "A48018204": "PREVISORA BILBAINA",
    "A95431888": "PREVISORA BILBAINA",
    "A28039790": "SANTA LUCIA ",
    "A79381729": "SANTA LUCIA VIDA",
    "A48464606": "AXA AURORA VIDA",
    "A60917978": "AXA",
    "A81357246": "AXA GLOBAL",
    "A28007268": "GENERALI",
    "A46003273": "SANTANDER SEGUROS",
    "A86588068": "SANTANDER SEGUROS",
    "A86588050": "SANTANDER SEGUROS",
    "A48051098": "BBVA SEGUROS",
    "A28013050": "CASER",
    "A58771247": "CASER",
    "A28037042": "SANITAS",
    "A08169294": "ASISA",
    "A87425070": "ASISA",
    "A28016608": "OCASO",
    "A78520293": "REALE",
    "A85877066": "REALE",
    "A48037642": "LIBERTY",
    "G08171407": "FIATC",
    "A80871031": "LINEA DIRECTA",
    "A28141935": "MAPFRE",
    "A85669604": "MM GLOBALIS",
    "A08371908": "BANSABADELL VIDA",
    "A64194590": "BANSABADELL SEGUROS",
    "A08185589": "NORTEHISPANA",
    "A78804390": "UNICORP VIDA",
    "A15009244": "ETERNA ASEGURADORA",
    "A41003864": "HELVETIA",
    "G28031466": "PELAYO",
    "A15003619": "AEGON",
    "A79409058": "GENESIS",
    "A58452905": "REGAL",
    "G28177657": "AMA SEGUROS",
    "A58201740": "RACC SEGUROS",
    "G28202802": "SEGUROS RACE",
    "A87987822": "BALUMBA",
    "V46055810": "DIVINAPASTORA",
    "A08171605": "ASEFA SEGUROS",
    "A85372597": "NECTAR SEGUROS",
    "A28061083": "ALMUDENA SEGUROS",
}
# Receipts are only read for these insurer ids (the map above also names
# A28141935, which this list leaves out).
INSURER_TAX_IDS_ALLOWED = (
    "A28061083", "A85372597", "A08171605", "V46055810", "A87987822", "G28202802",
    "A58201740", "G28177657", "A58452905", "A79409058", "A15003619", "G28031466",
    "A41003864", "A15009244", "A78804390", "A08185589", "A64194590", "A08371908",
    "A85669604", "A58333261", "A78510138", "A85078301", "A16029191", "A78801172",
    "V28027118", "A28011864", "A08168213", "A28007748", "A78694197", "A28119220",
    "A28039790", "A79381729", "A48464606", "A60917978", "A81357246", "A28007268",
    "A28037042", "A86007572", "A80029150", "A30014831", "A48001648", "A48018204",
    "A95431888", "A46003273", "A86588068", "A86588050", "A48051098", "A28013050",
    "A58771247", "A08169294", "A87425070", "A28016608", "A78520293", "A85877066",
    "A48037642", "G08171407", "A80871031",
)
# Customers already insured at home through these insurers are excluded.
HOME_EXCLUSION_INSURERS = ("CASER", "PLUS ULTRA SEGUROS")
POLICY_BRANCH_HOME = 5
POLICY_BRANCH_HEALTH = 4
POLICY_BRANCH_AUTO = 7
POLICY_BRANCH_FUNERAL = 8
POLICY_FUNERAL_GUARANTEE = 25
POLICY_OWN_COMPANY = 1
POLICY_MIN_HEALTH = 200
POLICY_MIN_AUTO = 120
POLICY_MIN_FUNERAL = 60

# Draft of the home journey.
DRAFT_HOME_PRODUCTS = ("43530", "43535", "46100")
DRAFT_HOME_EXCLUDED_ISSUERS = (
    "018", "0019", "0031", "0058", "0063", "0082", "0135", "0281", "0386",
    "0511", "0571", "0635", "0676", "0684", "0703", "0729", "0755", "C511",
    "C747", "0650", "2038",
)
DRAFT_HOME_LEAD_DAYS = 56
DRAFT_PAYROLL_SERVICES = ("32000", "32100")
DRAFT_CONSUMER_LOAN_PRODUCT = "11660"
DRAFT_HOME_MODELS = ("MSGHCHX1", "MSGHSHX1")
