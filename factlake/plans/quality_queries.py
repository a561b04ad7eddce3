"""Data-quality queries: evaluate, quarantine, metrics, batch gates, freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.operators import dq, silver
from factlake.operators.merge import scd2_history
from factlake.plans import bindings as B
from factlake.plans import oracle as O
from factlake.plans.registry import register
from factlake.plans.silver_queries import silver_filing

FACT_COLS = ["cik", "taxonomy", "concept_tag", "concept_canonical", "unit", "period_start", "period_end",
             "period_type", "accession_number", "value", "decimals", "fiscal_year", "fiscal_period",
             "form_type", "filed_date", "frame", "logical_date"]


def defect_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.facts_with_defects(B.table(spark, sf_dir, "lineitem"))


def _bad(cond: str) -> str:
    return f"NOT coalesce({cond}, false)"


FAILED_LIST = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {_bad(c)} THEN '{n}' END" for n, c, _ in O.FACT_ROW_CHECKS) + ")"
ANY_REJECT = " OR ".join(_bad(c) for n, c, s in O.FACT_ROW_CHECKS if s == "reject")
ANY_WARN = " OR ".join(_bad(c) for n, c, s in O.FACT_ROW_CHECKS if s == "warn")

EVALUATE_SQL = O.with_ctes(
    f"""SELECT cik, concept_tag, accession_number, unit, CAST(value AS DOUBLE) AS value, period_start, period_end,
              filed_date, {FAILED_LIST} AS dq_failed,
              CASE WHEN {ANY_REJECT} THEN 'reject' WHEN {ANY_WARN} THEN 'warn' ELSE 'pass' END AS dq_status
       FROM facts""",
    facts=O.DEFECT_FACTS)


@register("dq_evaluate", EVALUATE_SQL)
def dq_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fact row checks in one projection: failed names and worst severity per row."""
    ev = dq.evaluate(defect_facts(spark, sf_dir), "financial_fact")
    return ev.select("cik", "concept_tag", "accession_number", "unit", "value", "period_start", "period_end",
                     "filed_date", "dq_failed", "dq_status")


_REASONS = {name: prevents for t, name, sev, e, prevents in C.DQ_CHECKS}
QUARANTINE_SQL = O.with_ctes(
    "\nUNION ALL\n".join(
        f"""SELECT sha256(record_json) AS _dq_record_id, {O.RUN_ID} AS _dq_run_id, '{n}' AS _dq_check_name,
                  '{_REASONS[n]}' AS _dq_failure_reason, {O.GENERATED_AT} AS _quarantined_at,
                  'silver.financial_fact' AS _source_table, CAST(NULL AS VARCHAR) AS _source_file,
                  CAST(NULL AS VARCHAR) AS _ingest_batch_id, record_json
           FROM rec WHERE {_bad(c)}"""
        for n, c, s in O.FACT_ROW_CHECKS if s == "reject"),
    facts=O.DEFECT_FACTS,
    rejected=f"SELECT * FROM facts WHERE {ANY_REJECT}",
    rec="SELECT *, CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in FACT_COLS)
        + "}) AS VARCHAR) AS record_json FROM rejected")


@register("dq_quarantine", QUARANTINE_SQL)
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected facts, one row per (record, failed check), generic record_json shape."""
    ev = dq.evaluate(defect_facts(spark, sf_dir), "financial_fact")
    return dq.quarantine(ev, "financial_fact", record_cols=FACT_COLS)


METRICS_SQL = O.with_ctes(
    "\nUNION ALL\n".join(
        f"""SELECT 'silver.financial_fact' AS table_name, '{n}' AS check_name, '{s}' AS severity,
                  count(*) AS evaluated_count, count(*) FILTER (WHERE {_bad(c)}) AS failed_count,
                  {O.RUN_ID} AS run_id FROM facts"""
        for n, c, s in O.FACT_ROW_CHECKS),
    facts=O.DEFECT_FACTS)


@register("dq_metrics", METRICS_SQL)
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluated/failed counts for every row check in one pass, zeros included."""
    return dq.metrics(defect_facts(spark, sf_dir), "financial_fact")


FILING_CHECKS = (
    ("filing_accession_format", "regexp_matches(accession_number, '^[0-9]{10}-[0-9]{2}-[0-9]{6}$')", "reject"),
    ("filing_cik_padded", "regexp_matches(cik, '^[0-9]{10}$')", "reject"),
    ("filing_form_type_present", "length(form_type) > 0", "reject"),
    ("filing_filed_date_present", "filed_date IS NOT NULL", "reject"),
    ("filing_filed_date_sane", "filed_date BETWEEN DATE '1993-01-01' AND DATE '2026-07-30'", "warn"),
)
COMPANY_CHECKS = (
    ("company_cik_padded", "regexp_matches(cik, '^[0-9]{10}$')", "reject"),
    ("company_name_present", "length(company_name) > 0", "reject"),
)


def _verdict(checks) -> str:
    """dq_failed and dq_status of ``checks`` in SQL."""
    of = lambda s: " OR ".join([_bad(c) for _, c, sev in checks if sev == s] or ["false"])
    return ("concat_ws(',', " + ", ".join(f"CASE WHEN {_bad(c)} THEN '{n}' END" for n, c, _ in checks) + ") AS dq_failed, "
            f"CASE WHEN {of('reject')} THEN 'reject' WHEN {of('warn')} THEN 'warn' ELSE 'pass' END AS dq_status")


DEFECT_FILINGS = dict(
    index_rows=O.INDEX_ROWS.replace("\n  FROM events", ", event_type, value, props\n  FROM events"),
    raw="""SELECT CASE WHEN event_type = 'error' THEN replace(accession_number, '-', '') ELSE accession_number END AS accession_number,
              CASE WHEN value > 300 THEN cik || '00000000000' ELSE cik END AS cik,
              CASE WHEN event_type = 'view' AND value < 5 THEN '' ELSE form_type END AS form_type,
              CASE WHEN event_type = 'signup' AND value < 5 THEN NULL WHEN event_type = 'click' AND value > 100 THEN DATE '1992-12-31'
                   ELSE CAST(strptime(date_filed, '%Y%m%d') AS DATE) END AS filed_date,
              event_type FROM index_rows""",
    filings=f"SELECT accession_number, {O.pad('cik')} AS cik, form_type, filed_date, event_type FROM raw")


def _typed_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.type_filings(B.index_rows_with_defects(B.table(spark, sf_dir, "events")))


@register("dq_filing_checks", O.with_ctes(
    f"SELECT accession_number, cik, form_type, filed_date, {_verdict(FILING_CHECKS)} FROM filings", **DEFECT_FILINGS))
def dq_filing_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All filing row checks: failed names and worst severity per row."""
    ev = dq.evaluate(_typed_filings(spark, sf_dir), "filing")
    return ev.select("accession_number", "cik", "form_type", "filed_date", "dq_failed", "dq_status")


@register("dq_filing_metrics", O.with_ctes(
    "\nUNION ALL\n".join(
        f"""SELECT 'silver.filing' AS table_name, '{n}' AS check_name, '{s}' AS severity, count(*) AS evaluated_count,
                  count(*) FILTER (WHERE {_bad(c)}) AS failed_count, {O.RUN_ID} AS run_id FROM filings"""
        for n, c, s in (*FILING_CHECKS, ("filing_rescued_data", "event_type <> 'purchase'", "warn"))), **DEFECT_FILINGS))
def dq_filing_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluated and failed counts of the filing checks and of rows with undeclared payload keys."""
    return dq.metrics(_typed_filings(spark, sf_dir), "filing",
                      extra={"filing_rescued_data": ("warn", F.col("_rescued_data").isNotNull())})


@register("company_typing", O.with_ctes(
    f"SELECT *, {_verdict(COMPANY_CHECKS)} FROM companies",
    companies=f"""SELECT CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS VARCHAR) || '00000000000' ELSE {O.pad('c_custkey')} END AS cik,
          CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS company_name, CAST(c_nationkey AS VARCHAR) AS sic,
          c_mktsegment AS sic_description, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ein, 'operating' AS entity_type,
          'A,T' || CAST(c_custkey AS VARCHAR) AS tickers, 'NASDAQ,NYSE' AS exchanges,
          'Old ' || CAST(c_custkey AS VARCHAR) AS former_names
       FROM customer"""))
def company_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions documents typed to company rows (arrays sorted), with both company row checks."""
    c = silver.company_from_submissions(B.submissions_from_customer(B.table(spark, sf_dir, "customer")))
    return dq.evaluate(c, "company").drop("logical_date", "state_of_incorporation", "fiscal_year_end")


GRAIN = list(C.FACT_GRAIN)
GRAIN_SQL = O.with_ctes(
    """SELECT count(*) AS grain_groups, CAST(sum(n) AS BIGINT) AS row_count,
              count(*) FILTER (WHERE n > 1) AS duplicate_groups,
              CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows,
              count(*) FILTER (WHERE n > 1) = 0 AS passed
       FROM g""",
    facts=O.FACTS, g=f"SELECT {', '.join(GRAIN)}, count(*) AS n FROM facts GROUP BY ALL")


@register("dq_grain_unique", GRAIN_SQL)
def dq_grain_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact grain gate (reject_batch): groups, rows, duplicates and the verdict."""
    return dq.grain_summary(B.facts_from_lineitem(B.table(spark, sf_dir, "lineitem")), GRAIN)


ONE_CURRENT_SQL = O.with_ctes(
    """SELECT cik, count(*) FILTER (WHERE valid_to IS NULL) AS current_count,
              count(*) FILTER (WHERE NOT coalesce(valid_to IS NULL OR valid_to >= valid_from, false)) AS bad_range_count,
              count(*) FILTER (WHERE valid_to IS NULL) = 1
                AND count(*) FILTER (WHERE NOT coalesce(valid_to IS NULL OR valid_to >= valid_from, false)) = 0
                AS passed
       FROM versions GROUP BY cik""",
    **O.SCD2_CTES)


@register("dq_one_current", ONE_CURRENT_SQL)
def dq_one_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per company: current versions (must be 1) and negative validity intervals (must be 0)."""
    v = scd2_history(B.company_snapshots_from_orders(B.table(spark, sf_dir, "orders")), "cik",
                     ["company_name", "sic", "state_of_incorporation"])
    s = v.groupBy("cik").agg(
        F.count_if(F.col("is_current")).alias("current_count"),
        F.count_if(~F.coalesce(F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("valid_from")),
                               F.lit(False))).alias("bad_range_count"))
    return s.withColumn("passed", (F.col("current_count") == 1) & (F.col("bad_range_count") == 0))


FRESH_NOW = "2024-02-01 00:00:00"
FRESHNESS_SQL = O.with_ctes(
    f"""SELECT max(filed_date) AS gold_max_filed_date,
              date_diff('hour', CAST(max(filed_date) AS TIMESTAMP), TIMESTAMP '{FRESH_NOW}') AS age_hours,
              date_diff('hour', CAST(max(filed_date) AS TIMESTAMP), TIMESTAMP '{FRESH_NOW}') > 48 AS is_stale
       FROM filings""",
    index_rows=O.INDEX_ROWS, typed=O.SILVER_FILING, filings="SELECT * FROM typed")


@register("freshness", FRESHNESS_SQL)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving health: hours since the newest filed date, stale beyond 48 h."""
    return dq.freshness(silver_filing(spark, sf_dir), FRESH_NOW)
