"""Fixed schemas.  Every scan names its fields; a misspelled one surfaces as a null column
in tests instead of a silently missing value."""

from __future__ import annotations

ADDRESS = "struct<locality:string,region:string,postalCode:string>"
ORG = f"struct<id:string,name:string,address:{ADDRESS}>"
CODE = "struct<id:string>"
PERIOD = "struct<endDate:string>"

TENDER = (
    "struct<title:string,value:struct<amount:double>,numberOfTenderers:int,"
    f"classification:{CODE},additionalClassifications:array<{CODE}>,"
    f"items:array<struct<classification:{CODE},additionalClassifications:array<{CODE}>>>,"
    f"lots:array<struct<id:string,contractPeriod:{PERIOD}>>,tenderPeriod:{PERIOD},"
    f"tenderers:array<{ORG}>>"
)
AWARD = (
    "struct<id:string,date:string,relatedLots:array<string>,"
    f"contractPeriod:{PERIOD},value:struct<amount:double,currency:string>,suppliers:array<{ORG}>>"
)
PARTY = "struct<name:string,roles:array<string>,contactPoint:struct<url:string,email:string>>"
RELEASE_FIELDS = (
    "id:string,ocid:string,date:string,tag:array<string>,"
    f"buyer:struct<name:string,address:{ADDRESS}>,tender:{TENDER},"
    f"awards:array<{AWARD}>,parties:array<{PARTY}>"
)
RELEASE = f"struct<{RELEASE_FIELDS}>"

TED_FIELDS = [
    "publication-number", "publication-date", "notice-type", "notice-title", "buyer-name",
    "classification-cpv", "total-value", "winner-name", "winner-country", "winner-post-code",
    "winner-size", "contract-duration-end-date-lot",
]

JOB_PLACE = "struct<ort:string,plz:string,region:string>"
JOB = (
    "referenznummer string, refnr string, stellenangebotsTitel string, titel string, "
    "firma string, arbeitgeber string, hauptberuf string, beruf string, "
    f"stellenlokationen array<struct<adresse:{JOB_PLACE}>>, arbeitsort {JOB_PLACE}, "
    "datumErsteVeroeffentlichung string, aktuelleVeroeffentlichungsdatum string, "
    "veroeffentlichungszeitraum struct<von:string>, vertragsdauer string, homeofficemoeglich string"
)

PARTICIPATION = (
    "company_id string, notice_id string, ocid string, d date, role string, outcome string, "
    "legal_name string, buyer string, value double, consortium boolean, mixed_lot boolean, "
    "main_cpv string, cpv array<string>, it_share double, city string, postal_code string, "
    "supplier_id string, bidder_count int, pos int, source string, url string"
)

SIGNAL = (
    "source string, external_id string, signal_type string, event_date date, org_name_raw string, "
    "org_place string, source_url string, title string, notice_id string, buyer string, "
    "contract_end date, deadline date, value double, supplier_id string, is_buyer_side boolean, "
    "cpv array<string>, payload string"
)
SIGNAL_COLUMNS = [part.strip().split(" ")[0] for part in SIGNAL.split(", ")]

RESOLVED_EXTRA = "company_id string, match_confidence double, consortium boolean"

STATE = (
    "signal_id string, " + SIGNAL + ", " + RESOLVED_EXTRA + ", content_hash string, "
    "first_seen_run long, first_seen_at timestamp, last_seen_run long, last_seen_at timestamp, "
    "change_count int"
)
RUN_LOG = (
    "run_id long, source string, started_at timestamp, finished_at timestamp, rows_in long, "
    "rows_new long, rows_changed long, rows_unchanged long, errors string, stream string, batch long"
)

MARKET_COLUMNS = [
    "company_id", "legal_name", "domain", "domain_confidence", "domain_source",
    "city", "postal_code", "employees", "employees_scope",
    "tier", "tier_status", "tier_rationale",
    "proof_type", "proof_confidence", "proof_url", "proof_date",
    "awards_total", "award_rows", "last_award_date",
    "sole_bidder_wins", "bids_lost", "bids_outcome_unknown",
    "last_bid_date", "participations_total", "win_rate",
    "buyers", "buyers_total", "cpv_profile", "main_cpv", "mixed_lot_only",
    "consortium_only", "supplier_ids", "sources", "first_seen",
]
