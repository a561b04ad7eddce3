"""Declared schemas, concept lists and the data-quality registry (data only, no I/O).

Schemas are declared, never inferred: every reader is given a StructType.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published contract for results to match)
# ---------------------------------------------------------------------------
ENVELOPE_VERSION = "1"
SOURCE_SYSTEM = "sec_edgar"
STREAMS = ("filing_index", "company_submissions", "company_concept")
TAXONOMY = "us-gaap"
ARCHIVES_BASE = "https://www.sec.gov/Archives/"
DAILY_INDEX_URL = "https://www.sec.gov/Archives/edgar/daily-index/{year}/QTR{q}/form.{yyyymmdd}.idx"
SUBMISSIONS_URL = "https://data.sec.gov/submissions/CIK{cik}.json"
CONCEPT_URL = "https://data.sec.gov/api/xbrl/companyconcept/CIK{cik}/{taxonomy}/{concept}.json"
CONTRACTS_VERSION = "1.0.0"
FRESHNESS_LIMIT_HOURS = 48
FILED_DATE_FLOOR = "1993-01-01"
RATE_LIMIT_DEFAULT_RPS = 5
RATE_LIMIT_HARD_RPS = 8
MAX_ATTEMPTS = 5
RETRYABLE_STATUSES = (429, 500, 502, 503, 504)

# The 15 us-gaap concepts fetched per company, in contract order.
CONCEPT_SET = (
    "Revenues",
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "NetIncomeLoss",
    "OperatingIncomeLoss",
    "GrossProfit",
    "CostOfRevenue",
    "Assets",
    "AssetsCurrent",
    "Liabilities",
    "LiabilitiesCurrent",
    "StockholdersEquity",
    "CashAndCashEquivalentsAtCarryingValue",
    "NetCashProvidedByUsedInOperatingActivities",
    "EarningsPerShareBasic",
    "EarningsPerShareDiluted",
)

# As-filed concept -> canonical concept; unmapped concepts carry NULL.
CONCEPT_MAP = (
    ("Revenues", "revenue_total"),
    ("RevenueFromContractWithCustomerExcludingAssessedTax", "revenue_total"),
)

# Fixed-width daily index layout: 0-based [start, end) slices, end None = to line end.
INDEX_COLUMNS = (
    ("form_type", 0, 17),
    ("company_name", 17, 79),
    ("cik", 79, 91),
    ("date_filed", 91, 103),
    ("file_name", 103, None),
)
INDEX_HEADER_TOKENS = "Form Type Company Name CIK Date Filed File Name"
INDEX_SEPARATOR_PATTERN = r"^-{10,}\s*$"
INDEX_HEADER_SCAN_LINES = 40
ACCESSION_PATTERN = r"^[0-9]{10}-[0-9]{2}-[0-9]{6}$"
ACCESSION_IN_PATH_PATTERN = r"/(\d{10}-\d{2}-\d{6})\.txt$"
CIK_PADDED_PATTERN = r"^[0-9]{10}$"

# Relative tolerance for restatements and materiality band edges.
RESTATEMENT_REL_TOL = 1e-6
RESTATEMENT_ABS_TOL = 1e-6
BAND_IMMATERIAL_BELOW = 0.01
BAND_NOTABLE_UP_TO = 0.05
VALUE_MAGNITUDE_LIMIT = 1e15

# Data-quality registry: (table, check, severity, good-row expression, prevents).
DQ_CHECKS = (
    ("filing", "filing_accession_format", "reject",
     "accession_number RLIKE '^[0-9]{10}-[0-9]{2}-[0-9]{6}$'",
     "Malformed accession numbers breaking sec.gov links and the join to financial_fact"),
    ("filing", "filing_cik_padded", "reject",
     "cik RLIKE '^[0-9]{10}$'",
     "Unpadded CIKs splitting one company across multiple join keys in every downstream table"),
    ("filing", "filing_form_type_present", "reject",
     "form_type IS NOT NULL AND length(form_type) > 0",
     "Null form types making amendment detection and gold activity counts silently wrong"),
    ("filing", "filing_filed_date_present", "reject",
     "filed_date IS NOT NULL",
     "Null filed dates breaking restatement ordering, which is ordered by filed_date"),
    ("filing", "filing_filed_date_sane", "warn",
     "filed_date >= DATE'1993-01-01' AND filed_date <= {as_of_date}",
     "Obviously wrong filed dates (pre-EDGAR or future) polluting activity trends unnoticed"),
    ("company", "company_cik_padded", "reject",
     "cik RLIKE '^[0-9]{10}$'",
     "Unpadded CIKs splitting one company across multiple join keys in every downstream table"),
    ("company", "company_name_present", "reject",
     "company_name IS NOT NULL AND length(company_name) > 0",
     "Nameless company rows rendering as blanks in the UI search panel"),
    ("company", "company_one_current_per_cik", "reject_batch",
     "sum(CASE WHEN is_current THEN 1 ELSE 0 END) OVER (PARTITION BY cik) = 1",
     "Multiple current SCD-2 versions per cik fanning out every downstream join and doubling gold row counts"),
    ("company", "company_valid_range", "reject_batch",
     "valid_to IS NULL OR valid_to >= valid_from",
     "Negative validity intervals corrupting as-of joins against the dimension"),
    ("financial_fact", "fact_cik_padded", "reject",
     "cik RLIKE '^[0-9]{10}$'",
     "Unpadded CIKs splitting one company across multiple join keys in every downstream table"),
    ("financial_fact", "fact_accession_format", "reject",
     "accession_number RLIKE '^[0-9]{10}-[0-9]{2}-[0-9]{6}$'",
     "Malformed asserting accessions breaking the restatement self-join and sec.gov links"),
    ("financial_fact", "fact_unit_present", "reject",
     "unit IS NOT NULL AND length(unit) > 0",
     "Null units letting restatement detection compare values measured in different units"),
    ("financial_fact", "fact_value_present", "reject",
     "value IS NOT NULL",
     "Null fact values crashing delta computation in gold restatement detection"),
    ("financial_fact", "fact_period_end_present", "reject",
     "period_end IS NOT NULL",
     "Facts without a period end being unassignable to any reporting period in gold"),
    ("financial_fact", "fact_period_order", "reject",
     "period_start IS NULL OR period_end >= period_start",
     "Negative-length duration periods poisoning period-scoped comparisons (instant facts pass by design)"),
    ("financial_fact", "fact_grain_unique", "reject_batch",
     "count(*) OVER (PARTITION BY cik, taxonomy, concept_tag, unit, period_start, period_end, accession_number) = 1",
     "Duplicate rows at the declared grain double-counting facts and fabricating restatement events"),
    ("financial_fact", "fact_value_magnitude", "warn",
     "abs(value) < 1e15",
     "Unit-scale mistakes (dollars misread as millions) flooding gold with absurd values unnoticed"),
)
# ---------------------------------------------------------------------------

FACT_GRAIN = ("cik", "taxonomy", "concept_tag", "unit", "period_start", "period_end", "accession_number")
# Gold scope of one fact: the comparison grain of restatements and the latest view.
FACT_KEY = ("cik", "concept_canonical", "unit", "period_start", "period_end", "period_type")

_T = {
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "double": T.DoubleType(), "decimal": T.DecimalType(38, 6),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(*fields: tuple[str, str, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, _T[t], nullable) for n, t, nullable in fields])


NN, NULL = False, True

ENVELOPE = _schema(
    ("envelope_version", "string", NN), ("source_system", "string", NN), ("stream", "string", NN),
    ("resource_id", "string", NN), ("logical_date", "string", NN), ("batch_id", "string", NN),
    ("fetched_at", "string", NN), ("request_url", "string", NN), ("http_status", "int", NN),
    ("content_sha256", "string", NN), ("payload_json", "string", NN),
)
ENVELOPE_FIELDS = tuple(f.name for f in ENVELOPE.fields)

INDEX_PAYLOAD = _schema(
    ("company_name", "string", NULL), ("form_type", "string", NULL), ("cik", "string", NULL),
    ("date_filed", "string", NULL), ("file_name", "string", NULL), ("accession_number", "string", NULL),
)

FACT_ASSERTION = T.StructType([
    T.StructField("start", T.StringType()), T.StructField("end", T.StringType()),
    T.StructField("val", T.DecimalType(38, 6)), T.StructField("accn", T.StringType()),
    T.StructField("fy", T.IntegerType()), T.StructField("fp", T.StringType()),
    T.StructField("form", T.StringType()), T.StructField("filed", T.StringType()),
    T.StructField("frame", T.StringType()), T.StructField("decimals", T.IntegerType()),
])
CONCEPT_PAYLOAD = T.StructType([
    T.StructField("cik", T.StringType()), T.StructField("taxonomy", T.StringType()),
    T.StructField("tag", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("entityName", T.StringType()),
    T.StructField("units", T.MapType(T.StringType(), T.ArrayType(FACT_ASSERTION))),
])

_RECENT = ("accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "act", "form",
           "fileNumber", "filmNumber", "items", "primaryDocument", "primaryDocDescription")
SUBMISSIONS_PAYLOAD = T.StructType([
    T.StructField("cik", T.StringType()), T.StructField("entityType", T.StringType()),
    T.StructField("sic", T.StringType()), T.StructField("sicDescription", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("ein", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("fiscalYearEnd", T.StringType()),
    T.StructField("stateOfIncorporation", T.StringType()),
    T.StructField("tickers", T.ArrayType(T.StringType())),
    T.StructField("exchanges", T.ArrayType(T.StringType())),
    T.StructField("formerNames", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType())]))),
    T.StructField("filings", T.StructType([
        T.StructField("recent", T.StructType(
            [T.StructField(n, T.ArrayType(T.StringType())) for n in _RECENT]
            + [T.StructField(n, T.ArrayType(T.LongType())) for n in
               ("size", "isXBRL", "isInlineXBRL")])),
        T.StructField("files", T.ArrayType(T.StructType([
            T.StructField("name", T.StringType()), T.StructField("filingCount", T.LongType()),
            T.StructField("filingFrom", T.StringType()), T.StructField("filingTo", T.StringType())]))),
    ])),
])

_BRONZE_META = (
    ("_ingest_batch_id", "string", NN), ("_ingest_ts", "timestamp", NN), ("_source_file", "string", NN),
    ("_source_system", "string", NN), ("_envelope_version", "string", NN), ("_rescued_data", "string", NULL),
)
_BRONZE_HEAD = (("logical_date", "date", NN), ("resource_id", "string", NULL), ("fetched_at", "timestamp", NULL))

TABLES: dict[str, T.StructType] = {
    "bronze.filing_index_raw": _schema(
        *_BRONZE_HEAD, ("form_type", "string", NULL), ("company_name", "string", NULL),
        ("cik", "string", NULL), ("date_filed", "string", NULL), ("accession_number", "string", NULL),
        ("file_name", "string", NULL), *_BRONZE_META),
    "bronze.company_submissions_raw": _schema(
        *_BRONZE_HEAD, ("cik", "string", NULL), ("payload_json", "string", NULL), *_BRONZE_META),
    "bronze.company_concept_raw": _schema(
        *_BRONZE_HEAD, ("cik", "string", NULL), ("taxonomy", "string", NULL), ("tag", "string", NULL),
        ("payload_json", "string", NULL), *_BRONZE_META),
    "silver.filing": _schema(
        ("accession_number", "string", NN), ("cik", "string", NN), ("company_name", "string", NULL),
        ("form_type", "string", NN), ("base_form_type", "string", NN), ("is_amendment", "boolean", NN),
        ("filed_date", "date", NN), ("primary_doc_url", "string", NULL), ("logical_date", "date", NN),
        ("_first_seen_ts", "timestamp", NN), ("_last_seen_ts", "timestamp", NN),
        ("_ingest_batch_id", "string", NN), ("_source_file", "string", NULL)),
    "silver.company": _schema(
        ("cik", "string", NN), ("company_name", "string", NULL), ("sic", "string", NULL),
        ("sic_description", "string", NULL), ("ein", "string", NULL), ("entity_type", "string", NULL),
        ("state_of_incorporation", "string", NULL), ("fiscal_year_end", "string", NULL),
        ("tickers", "array<string>", NULL), ("exchanges", "array<string>", NULL),
        ("former_names", "array<string>", NULL), ("valid_from", "date", NN), ("valid_to", "date", NULL),
        ("is_current", "boolean", NN), ("_hash_diff", "string", NN), ("_first_seen_ts", "timestamp", NN),
        ("_last_seen_ts", "timestamp", NN), ("_ingest_batch_id", "string", NN), ("_source_file", "string", NULL)),
    "silver.financial_fact": _schema(
        ("cik", "string", NN), ("taxonomy", "string", NN), ("concept_tag", "string", NN),
        ("concept_canonical", "string", NULL), ("unit", "string", NN), ("period_start", "date", NULL),
        ("period_end", "date", NN), ("period_type", "string", NN), ("accession_number", "string", NN),
        ("value", "decimal", NULL), ("decimals", "int", NULL), ("fiscal_year", "int", NULL),
        ("fiscal_period", "string", NULL), ("form_type", "string", NULL), ("filed_date", "date", NN),
        ("frame", "string", NULL), ("logical_date", "date", NN), ("_first_seen_ts", "timestamp", NN),
        ("_last_seen_ts", "timestamp", NN), ("_ingest_batch_id", "string", NN), ("_source_file", "string", NULL)),
    "gold.financials_current": _schema(
        ("cik", "string", NN), ("company_name", "string", NULL), ("concept_canonical", "string", NN),
        ("unit", "string", NN), ("period_start", "date", NULL), ("period_end", "date", NN),
        ("period_type", "string", NN), ("value", "decimal", NULL), ("decimals", "int", NULL),
        ("fiscal_year", "int", NULL), ("fiscal_period", "string", NULL), ("accession_number", "string", NN),
        ("form_type", "string", NULL), ("filed_date", "date", NN), ("assertion_count", "int", NN),
        ("was_restated", "boolean", NN), ("_generated_at", "timestamp", NN), ("_run_id", "string", NN)),
    "gold.restatement_event": _schema(
        ("restatement_id", "string", NN), ("cik", "string", NN), ("company_name", "string", NULL),
        ("concept_canonical", "string", NN), ("unit", "string", NN), ("period_start", "date", NULL),
        ("period_end", "date", NN), ("period_type", "string", NN),
        ("original_accession_number", "string", NN), ("original_form_type", "string", NULL),
        ("original_filed_date", "date", NN), ("original_value", "decimal", NN), ("original_decimals", "int", NULL),
        ("restated_accession_number", "string", NN), ("restated_form_type", "string", NULL),
        ("restated_filed_date", "date", NN), ("restated_value", "decimal", NN), ("restated_decimals", "int", NULL),
        ("delta_abs", "decimal", NN), ("delta_pct", "double", NULL), ("materiality_band", "string", NN),
        ("days_to_restatement", "int", NN), ("_generated_at", "timestamp", NN), ("_run_id", "string", NN)),
    "gold.filing_activity_daily": _schema(
        ("filed_date", "date", NN), ("base_form_type", "string", NN), ("filing_count", "int", NN),
        ("amendment_count", "int", NN), ("distinct_cik_count", "int", NN),
        ("_generated_at", "timestamp", NN), ("_run_id", "string", NN)),
    "gold.company_profile": _schema(
        ("cik", "string", NN), ("company_name", "string", NULL), ("sic", "string", NULL),
        ("sic_description", "string", NULL), ("entity_type", "string", NULL),
        ("state_of_incorporation", "string", NULL), ("fiscal_year_end", "string", NULL),
        ("tickers", "array<string>", NULL), ("exchanges", "array<string>", NULL),
        ("filing_count", "int", NN), ("first_filed_date", "date", NULL), ("last_filed_date", "date", NULL),
        ("restatement_count", "int", NN), ("_generated_at", "timestamp", NN), ("_run_id", "string", NN)),
}
QUARANTINE = _schema(
    ("_dq_record_id", "string", NN), ("_dq_run_id", "string", NN), ("_dq_check_name", "string", NN),
    ("_dq_failure_reason", "string", NN), ("_quarantined_at", "timestamp", NN), ("_source_table", "string", NN),
    ("_source_file", "string", NULL), ("_ingest_batch_id", "string", NULL), ("record_json", "string", NN),
)
for _t in ("filing", "company", "financial_fact"):
    TABLES[f"silver.{_t}_quarantine"] = QUARANTINE

GOLD_TABLES = ("financials_current", "restatement_event", "filing_activity_daily", "company_profile")
