"""DuckDB twins of the bindings, used to build the independent oracle SQL.

Each constant is one CTE body over the driver's pre-registered views.
"""

from __future__ import annotations

from factlake import contracts as C


def pad(expr: str) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) < 10 THEN lpad({s}, 10, '0') ELSE {s} END)"


CONCEPT_LIST = "[" + ", ".join(f"'{c}'" for c in C.CONCEPT_SET) + "]"

GENERATED_AT = "TIMESTAMP '2026-01-01 00:00:00'"
RUN_ID = "'run-00000000'"
META = f"{GENERATED_AT} AS _generated_at, {RUN_ID} AS _run_id"

FACTS = f"""
  SELECT {pad('l_orderkey')} AS cik,
         'us-gaap' AS taxonomy,
         'L' || CAST(l_linenumber AS VARCHAR) AS concept_tag,
         CAST(NULL AS VARCHAR) AS concept_canonical,
         'USD' AS unit,
         CASE WHEN l_linenumber % 2 = 1 THEN CAST(NULL AS DATE) ELSE DATE '1995-01-01' END AS period_start,
         DATE '2001-12-31' AS period_end,
         CASE WHEN l_linenumber % 2 = 1 THEN 'instant' ELSE 'duration' END AS period_type,
         printf('%010d-%02d-%06d', l_partkey, year(l_shipdate) % 100, l_suppkey) AS accession_number,
         CAST(l_extendedprice AS DECIMAL(38,6)) AS value,
         CAST(NULL AS INTEGER) AS decimals,
         year(l_shipdate) AS fiscal_year,
         'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS fiscal_period,
         CASE WHEN l_returnflag = 'R' THEN '10-K/A' ELSE '10-K' END AS form_type,
         CAST(l_shipdate AS DATE) AS filed_date,
         CAST(NULL AS VARCHAR) AS frame,
         CAST(l_shipdate AS DATE) AS logical_date
  FROM lineitem"""

DEFECT_FACTS = FACTS.replace(
    f"SELECT {pad('l_orderkey')} AS cik,",
    f"SELECT CASE WHEN l_quantity = 1 THEN CAST(l_orderkey AS VARCHAR) ELSE {pad('l_orderkey')} END AS cik,"
).replace(
    "printf('%010d-%02d-%06d', l_partkey, year(l_shipdate) % 100, l_suppkey) AS accession_number",
    "CASE WHEN l_discount >= 0.095 THEN replace(printf('%010d-%02d-%06d', l_partkey, year(l_shipdate) % 100, "
    "l_suppkey), '-', '') ELSE printf('%010d-%02d-%06d', l_partkey, year(l_shipdate) % 100, l_suppkey) "
    "END AS accession_number"
).replace(
    "'USD' AS unit", "CASE WHEN l_tax = 0 THEN '' ELSE 'USD' END AS unit"
).replace(
    "CAST(l_extendedprice AS DECIMAL(38,6)) AS value",
    "CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(38,6)) END AS value"
).replace(
    "DATE '2001-12-31' AS period_end",
    "CASE WHEN l_quantity = 50 THEN DATE '1994-12-31' ELSE DATE '2001-12-31' END AS period_end")

# Row checks on silver.financial_fact in registry order: (name, good-row condition).
FACT_ROW_CHECKS = (
    ("fact_cik_padded", "regexp_matches(cik, '^[0-9]{10}$')", "reject"),
    ("fact_accession_format", "regexp_matches(accession_number, '^[0-9]{10}-[0-9]{2}-[0-9]{6}$')", "reject"),
    ("fact_unit_present", "unit IS NOT NULL AND length(unit) > 0", "reject"),
    ("fact_value_present", "value IS NOT NULL", "reject"),
    ("fact_period_end_present", "period_end IS NOT NULL", "reject"),
    ("fact_period_order", "period_start IS NULL OR period_end >= period_start", "reject"),
    ("fact_value_magnitude", "abs(value) < 1e15", "warn"),
)

SNAPSHOTS = f"""
  SELECT cik, logical_date, 'Company ' || cik AS company_name, o_orderstatus AS sic,
         o_orderpriority AS state_of_incorporation
  FROM (SELECT {pad('o_custkey')} AS cik, CAST(o_orderdate AS DATE) AS logical_date, o_orderstatus, o_orderpriority,
               row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1"""

# SCD-2 versions of the snapshots: (cik, tracked..., _hash_diff, valid_from, valid_to, is_current, seen).
SCD2_CTES = dict(
    snap=SNAPSHOTS,
    hashed="""SELECT *, sha256(concat_ws('|', coalesce(company_name, ''), coalesce(sic, ''),
                 coalesce(state_of_incorporation, ''))) AS _hash_diff FROM snap""",
    marked="""SELECT *, lag(_hash_diff) OVER w AS p, lead(_hash_diff) OVER w AS n FROM hashed
              WINDOW w AS (PARTITION BY cik ORDER BY logical_date)""",
    kept="""SELECT *, p IS DISTINCT FROM _hash_diff AS is_start, n IS DISTINCT FROM _hash_diff AS is_end
            FROM marked WHERE p IS DISTINCT FROM _hash_diff OR n IS DISTINCT FROM _hash_diff""",
    spans="""SELECT *, CASE WHEN is_end THEN logical_date
                 ELSE lead(logical_date) OVER (PARTITION BY cik ORDER BY logical_date) END AS last_seen FROM kept""",
    versions="""SELECT cik, company_name, sic, state_of_incorporation, _hash_diff, logical_date AS valid_from,
                  lead(logical_date) OVER (PARTITION BY cik ORDER BY logical_date) AS valid_to, last_seen
                FROM spans WHERE is_start""",
)

COMPANIES = f"SELECT {pad('c_custkey')} AS cik, c_name AS company_name FROM customer"

# Facts in gold scope with the previous assertion of the same fact attached.  Consecutive rows of one
# accession collapse to the first (preferred tag: map order, then unmapped; then lowest value).
FACT_SEQUENCE = """
  SELECT *,
         lag(accession_number) OVER w AS prev_accession_number,
         lag(filed_date) OVER w AS prev_filed_date,
         lag(value) OVER w AS prev_value,
         lag(decimals) OVER w AS prev_decimals,
         lag(form_type) OVER w AS prev_form_type
  FROM (SELECT * FROM (
          SELECT *, lag(accession_number) OVER o AS same_acc
          FROM (SELECT cik, coalesce(concept_canonical, concept_tag) AS concept_canonical, unit, period_start,
                       period_end, period_type, accession_number, filed_date, value, decimals, form_type, fiscal_year,
                       fiscal_period,
                       CASE concept_tag WHEN 'Revenues' THEN 0
                            WHEN 'RevenueFromContractWithCustomerExcludingAssessedTax' THEN 1 ELSE 2 END AS tag_pref
                FROM facts WHERE value IS NOT NULL)
          WINDOW o AS (PARTITION BY cik, concept_canonical, unit, period_start, period_end, period_type
                       ORDER BY filed_date, accession_number, tag_pref, value))
        WHERE same_acc IS DISTINCT FROM accession_number)
  WINDOW w AS (PARTITION BY cik, concept_canonical, unit, period_start, period_end, period_type
               ORDER BY filed_date, accession_number, tag_pref, value)"""

IS_EVENT = """(prev_value IS NOT NULL
   AND abs(value - prev_value) > greatest(abs(prev_value) * 1e-6, 1e-6)
   AND NOT coalesce(least(decimals, prev_decimals) IS NOT NULL
       AND round(CAST(value AS DOUBLE) * pow(10.0, least(decimals, prev_decimals)))
         = round(CAST(prev_value AS DOUBLE) * pow(10.0, least(decimals, prev_decimals))), false))"""

INDEX_ROWS = f"""
  SELECT printf('Filer %d', user_id) AS company_name,
         upper(event_type) || CASE WHEN event_id % 7 = 0 THEN '/A' ELSE '' END AS form_type,
         CAST(user_id AS VARCHAR) AS cik,
         strftime(ts, '%Y%m%d') AS date_filed,
         printf('edgar/data/%d/%s.txt', user_id,
                printf('%010d-%02d-%06d', event_id, year(ts) % 100, user_id % 1000000)) AS file_name,
         printf('%010d-%02d-%06d', event_id, year(ts) % 100, user_id % 1000000) AS accession_number,
         CAST(ts AS DATE) AS logical_date
  FROM events"""

SILVER_FILING = f"""
  SELECT accession_number, {pad('cik')} AS cik, company_name, form_type,
         regexp_replace(upper(form_type), '/A$', '') AS base_form_type,
         ends_with(form_type, '/A') AS is_amendment,
         CAST(strptime(date_filed, '%Y%m%d') AS DATE) AS filed_date,
         'https://www.sec.gov/Archives/' || file_name AS primary_doc_url,
         logical_date
  FROM index_rows"""


def with_ctes(final_select: str, /, **ctes: str) -> str:
    parts = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes.items())
    return f"WITH {parts}\n{final_select}"
