"""Every business assumption in one place.

The values below are fixed: results only agree with published ones when they are
kept as they are.
"""

from __future__ import annotations

# --- fixed values: scope ---------------------------------------------------------
IT_CODE_PREFIXES = ["48", "72", "302", "5031", "5032", "5161", "642"]
MIN_IT_SHARE = 0.5
MIXED_LOT_MIN_CODES = 8
CODES_KEPT = 12
CODES_IN_ROW = 8
PROFILE_CODES = 10
BUYERS_SHOWN = 5

# --- fixed values: company names --------------------------------------------------
LEGAL_FORMS = [
    "gmbh & co. kgaa", "gmbh & co kgaa", "gmbh & co. kg", "gmbh & co kg",
    "ag & co. kg", "ag & co kg", "se & co. kgaa", "se & co kgaa",
    "gesellschaft mit beschraenkter haftung",
    "kommanditgesellschaft", "aktiengesellschaft",
    "ggmbh", "gmbh", "kgaa", "mbh", "ohg", "kg", "ag", "se", "ug",
    "e.k.", "ek", "e.v.", "ev", "partg", "gbr", "ltd", "plc", "bv", "nv",
]
CONSORTIUM_MARKERS = [
    " arge ", "arbeitsgemeinschaft", "bietergemeinschaft", " bg ",
    " consortium", " konsortium",
]
CONSORTIUM_WORDS = ["arge", "arbeitsgemeinschaft", "bietergemeinschaft", "konsortium", "consortium"]
ROLE_WORDS = ["mitglied", "bieter", "los", "teilnehmer", "partner"]
MIN_NAME_LEN = 3
MAX_NAME_LEN = 120
JUNK_EXACT = [
    "auftragnehmer", "auftraggeber", "bieter", "anbieter", "lieferant",
    "firma", "unternehmen", "konsortium", "arge", "bietergemeinschaft",
    "n n", "nn", "entfaellt", "keine", "anonym", "vertraulich",
]
JUNK_PREFIXES = [
    "keine angabe", "keineangabe", "k a", "na", "entfaellt", "entfallen",
    "es wurden", "es wurde", "siehe", "diverse", "verschiedene", "mehrere",
    "nicht vergeben", "aufgehoben", "kein zuschlag", "unbekannt",
]
JUNK_MARKERS = ["bezuschlagt", "gemaess §", "gemaess  §", " vgv", "los 1 und"]

# --- fixed values: exclusion lists, in the order they are asked --------------------
EXCLUSIONS = {
    "public_inhouse": [
        "dataport", "itzbund", "informationstechnikzentrum bund", "akdb",
        "komm.one", "kommone", "regio it", "regioit", "ekom21", "krzn", "citeq",
        "lvr-infokom", "lwl.it", "zit-bb", "dvz", "datenzentrale", "it.niedersachsen",
        "it.nrw", "landesamt fuer digitalisierung", "kdo", "kdrs", "kivbf",
        "zweckverband", "kommunales rechenzentrum", "kommunale datenverarbeitung",
    ],
    "competitor_portal": [
        "cosinex", "administration intelligence", "healy hudson", "dtad",
        "deutsches ausschreibungsblatt", "subreport", "vergabe24", "evergabe",
        "staatsanzeiger", "bi-medien", "tender24", "ausschreibungen-deutschland",
        "vergaberecht", "rechtsanwalt", "rechtsanwaelte", "kanzlei",
        "ausschreibungsberatung", "vergabeberatung",
    ],
    "non_systemhaus": [
        "cyberport", "notebooksbilliger", "alternate", "conrad electronic",
        "hays", "ferchau", "amadeus fire", "brunel", "gulp",
        "sthree", "computer futures", "hueter", "randstad", "adecco",
        "michael page", "robert half", "solcom", "etengo", "questax",
        "sap se", "software ag", "microsoft deutschland", "oracle deutschland",
    ],
}
TOKEN_MATCH_MAX_LEN = 6

# --- fixed values: job titles -------------------------------------------------------
JOB_INCLUDE = [
    "bid manager", "bid-manager", "bidmanager",
    "angebotsmanager", "angebotsmanagement",
    "ausschreibungsmanager", "ausschreibungsmanagement",
    "tender manager", "tendermanagement",
    "vergabemanager", "vergabemanagement",
    "submission", "bietermanagement",
    "referent ausschreibungen", "referent vergabe",
    "public sector sales", "vertrieb oeffentliche auftraggeber",
    "key account manager public", "account manager oeffentlicher",
]
JOB_EXCLUDE = [
    "strategischer einkaeufer", "einkaeufer", "einkauf",
    "procurement", "beschaffung", "vergabestelle", "vergabesachbearbeiter",
    "vergabejurist", "vergaberecht", "rechtsanwalt",
]

# --- fixed values: signals and score --------------------------------------------------
SIGNAL_WEIGHTS = {
    "nachpruefung_vergabekammer": 10,
    "rahmenvertrag_laeuft_aus": 9,
    "angebot_ohne_zuschlag": 8,
    "offene_ausschreibung_im_profil": 8,
    "bid_rolle_ausgeschrieben": 7,
    "zuschlag_gewonnen": 6,
    "leitungswechsel_public": 5,
    "teilnahme_belegt": 5,
    "neue_public_referenz": 4,
}
DEFAULT_SIGNAL_WEIGHT = 1
TIER_FIT = {"A": 1.0, "B": 0.8, "C": 0.6, "D": 0.3}
DEFAULT_TIER_FIT = 0.3
RECENCY_BUCKETS = [(14, 1.0), (28, 0.8), (42, 0.6), (56, 0.4)]
RECENCY_FLOOR = 0.2
STACKING_BONUS = 2.0
SCORE_CAP = 12.0
DAMPEN_FLOOR = 0.40
DEFAULT_CONFIDENCE = 0.5
ENRICH_SCORE = 40
ACTIVE_DAYS = 56
OVERLAP_DAYS = 14
EXPIRY_WINDOW = (180, 270)
DEADLINE_WINDOW = (10, 32)
DEADLINE_LOOKBACK_DAYS = 62

SOURCE_PRIOR = {"vergabe_dovs": 0.75, "ted": 0.72, "ba_jobs": 0.50}
DEFAULT_PRIOR = 0.50
PROCUREMENT_SOURCES = ["vergabe_dovs", "ted"]
JOB_SOURCE = "ba_jobs"
MIN_RESOLUTION_CONFIDENCE = 0.70

# --- fixed values: proof and tier --------------------------------------------------------
PROOF_CONFIDENCE = {
    "P1_zuschlag_24m": 0.95,
    "P1B_bieter_unterlegen": 0.90,
    "P1C_alleinbieter": 0.85,
    "P1D_ausgang_offen": 0.88,
    "P2_zuschlag_48m": 0.85,
    "P3_rahmenvertrag": 0.80,
    "P4_referenz_website": 0.65,
    "P5_schwaches_signal": 0.45,
    "P6_nur_branche": 0.20,
}
TIER_STATUS = {
    "P1_zuschlag_24m": "zuschlag_benannt",
    "P2_zuschlag_48m": "zuschlag_benannt",
    "P1B_bieter_unterlegen": "zuschlag_benannt",
    "P1C_alleinbieter": "zuschlag_erschlossen",
    "P1D_ausgang_offen": "teilnahme_offen",
    "P3_rahmenvertrag": "schwacher_beleg",
    "P4_referenz_website": "schwacher_beleg",
    "P5_schwaches_signal": "schwacher_beleg",
    "P6_nur_branche": "kein_beleg",
}
STRONG_PROOFS = [
    "P1_zuschlag_24m", "P2_zuschlag_48m", "P1B_bieter_unterlegen",
    "P1C_alleinbieter", "P1D_ausgang_offen",
]
WEAK_PROOFS = ["P3_rahmenvertrag", "P4_referenz_website", "P5_schwaches_signal"]
AWARD_FRESH_DAYS = 730
AWARD_OLD_DAYS = 1460
TIER_A_MIN_PROCEDURES = 3
TIER_A_MAX_AGE_DAYS = 180
TIER_ORDER = {"A": 0, "B": 1, "C": 2, "D": 3}

# --- fixed values: web domains ---------------------------------------------------------
FREEMAIL = [
    "gmail.com", "googlemail.com", "t-online.de", "gmx.de", "gmx.net",
    "gmx.at", "gmx.ch", "web.de", "outlook.com", "outlook.de", "hotmail.com",
    "hotmail.de", "yahoo.de", "yahoo.com", "icloud.com", "me.com", "aol.com",
    "freenet.de", "mail.de", "online.de", "posteo.de", "protonmail.com",
    "arcor.de", "1und1.de", "vodafone.de", "unity-mail.de",
]
PLACEHOLDER_HOSTS = [
    "emailaddress.given", "example.com", "example.de", "test.de",
    "keine.de", "nicht.vorhanden", "n.a.", "na.de", "xxx.de",
    "beispiel.de", "musterfirma.de", "muster.de",
]
HOST_PATTERN = r"^(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$"
BUYER_ROLES = [
    "buyer", "processContactPoint", "submissionReceiptBody",
    "reviewBody", "reviewContactPoint", "mediationBody",
]
BIDDER_ROLES = ["supplier", "tenderer"]
MAX_UNRELATED_COMPANIES = 3
FOREIGN_TLDS = {
    "at": "Oesterreich", "ch": "Schweiz", "ro": "Rumaenien", "hu": "Ungarn",
    "pl": "Polen", "cz": "Tschechien", "uk": "UK", "fr": "Frankreich",
    "es": "Spanien", "it": "Italien", "nl": "Niederlande", "se": "Schweden",
    "dk": "Daenemark", "no": "Norwegen", "fi": "Finnland", "in": "Indien",
    "us": "USA", "org": "Non-Profit", "net": "generisch",
}
NEUTRAL_TLDS = ["com", "eu", "io", "tech", "group"]
VERIFY_ACCEPT = 0.60
IMPRINT_STOP_TOKENS = [
    "gmbh", "ag", "kg", "se", "co", "und", "mbh", "ek", "ohg",
    "deutschland", "germany", "group", "gruppe", "holding",
]

# --- fixed values: enrichment --------------------------------------------------------------
MAX_EMPLOYEES = 2000
HOME_COUNTRIES = ["germany", "deutschland", "de"]
FIELD_ALIASES = {
    "company_id": ["company_id", "companyid"],
    "legal_name": ["legal_name", "name", "company", "company_name", "firma"],
    "domain": ["domain", "company_domain", "website", "url", "domain_final"],
    "employees": ["employees", "employee_count", "mitarbeiter", "mitarbeiterzahl",
                  "headcount", "estimated_num_employees", "num_employees", "size"],
    "country": ["country", "land", "hq_country"],
    "city": ["city", "ort", "hq_city"],
    "matched_name": ["apollo_name", "matched_name", "enriched_name"],
    "industry": ["industry", "branche", "apollo_industry"],
    "linkedin": ["linkedin", "linkedin_url", "apollo_linkedin"],
    "domain_source": ["domain_source", "quelle", "source"],
    "domain_confidence": ["domain_confidence", "confidence", "domain_konfidenz"],
}
SOURCE_RANK = {
    "amtlich_bestaetigt": 0.95,
    "amtlich_namensbezug": 0.90,
    "amtlich_unbestaetigt": 0.60,
    "enrichment": 0.70,
    "clay_ai": 0.55,
}
DEFAULT_SOURCE_RANK = 0.70

# --- fixed values: contacts and audits -----------------------------------------------------
PERSONA_CHAMPION = "Champion - Bid/Tender"
PERSONA_BUYER = "Economic Buyer"
PERSONA_USER = "Nutzer / Fuersprecher"
CHAMPION_WORDS = ["bid", "tender", "angebot", "ausschreibung", "submission",
                  "proposal", "vergabemanage"]
BUYER_WORDS = ["geschäftsführ", "geschaeftsfuehr", "managing director",
               "inhaber", "vorstand", "prokurist", "kaufmännisch",
               "head of sales", "vertriebsleit", "niederlassungsleit"]
EMAIL_PATTERN = r"(?i)^[^@\s]+@[^@\s]+\.[a-z]{2,}$"
COPY_FLAGS = [
    "konnte online wenig", "konnte keine", "konnte nichts", "nehme aber an",
    "nehme an", "vermutlich", "ich hoffe", "falls ich richtig",
]
CONTACTS_PER_ACCOUNT = 3
MARKET_LEADS, MARKET_ACCOUNTS = 40, 40
SIGNAL_LEADS, SIGNAL_ACCOUNTS = 20, 20
SHELL_BYTES = [1309]
OK_TYPES = ["application/pdf", "application/xml", "text/xml", "application/json"]
CHALLENGE_HOSTS = ["ted.europa.eu"]
MIN_EVIDENCE_BYTES = 500
AUDIT_GATE = 0.95
MIN_NAME_QUOTA = 0.30
STRATA = {
    "zuschlag_mit_gewinner": 60,
    "alleinbieter": 60,
    "mehrbieter": 40,
    "rahmenvertrag_ablauf": 40,
    "konsortium": 15,
    "rest": 60,
}
SPREAD_WARN = 0.35

# --- fixed values: evidence addresses of the public data services -----------------------------
NOTICE_URL = "https://oeffentlichevergabe.de/api/notices/"
TED_URL = "https://ted.europa.eu/en/notice/-/detail/"
JOB_URL = "https://www.arbeitsagentur.de/jobsuche/jobdetail/"
