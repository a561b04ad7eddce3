"""Gold queries over the driver's tables (restatements, latest facts, activity, profile)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.operators import gold, silver
from factlake.plans import bindings as B
from factlake.plans import oracle as O
from factlake.plans.registry import register
from factlake.session import scratch_dir


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.facts_from_lineitem(B.table(spark, sf_dir, "lineitem"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.companies_from_customer(B.table(spark, sf_dir, "customer"))


def silver_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = B.index_rows_from_events(B.table(spark, sf_dir, "events"))
    return silver.dedupe_filings(silver.type_filings(rows))


RESTATEMENT_COLS = """restatement_id, s.cik, c.company_name, concept_canonical, unit, period_start, period_end,
  period_type, original_accession_number, original_form_type, original_filed_date,
  CAST(original_value AS DOUBLE) AS original_value, CAST(original_decimals AS BIGINT) AS original_decimals,
  restated_accession_number, restated_form_type, restated_filed_date,
  CAST(restated_value AS DOUBLE) AS restated_value, CAST(restated_decimals AS BIGINT) AS restated_decimals,
  CAST(delta_abs AS DOUBLE) AS delta_abs, delta_pct,
  CASE WHEN delta_pct IS NULL THEN 'material' WHEN abs(delta_pct) < 0.01 THEN 'immaterial'
       WHEN abs(delta_pct) <= 0.05 THEN 'notable' ELSE 'material' END AS materiality_band,
  CAST(days_to_restatement AS BIGINT) AS days_to_restatement"""

EVENTS_SQL = """
  SELECT sha256(concat_ws('|', cik, concept_canonical, unit, coalesce(CAST(period_start AS VARCHAR), ''),
                CAST(period_end AS VARCHAR), period_type, prev_accession_number, accession_number)) AS restatement_id,
         cik, concept_canonical, unit, period_start, period_end, period_type,
         prev_accession_number AS original_accession_number, prev_form_type AS original_form_type,
         prev_filed_date AS original_filed_date, prev_value AS original_value, prev_decimals AS original_decimals,
         accession_number AS restated_accession_number, form_type AS restated_form_type,
         filed_date AS restated_filed_date, value AS restated_value, decimals AS restated_decimals,
         value - prev_value AS delta_abs,
         CASE WHEN prev_value = 0 THEN NULL
              ELSE CAST(value - prev_value AS DOUBLE) / CAST(prev_value AS DOUBLE) END AS delta_pct,
         date_diff('day', prev_filed_date, filed_date) AS days_to_restatement
  FROM seq WHERE """ + O.IS_EVENT

RESTATEMENT_SQL = O.with_ctes(
    f"SELECT {RESTATEMENT_COLS}, {O.META} FROM ev s LEFT JOIN companies c ON s.cik = c.cik",
    facts=O.FACTS, companies=O.COMPANIES, seq=O.FACT_SEQUENCE, ev=EVENTS_SQL)


@register("restatement_event", RESTATEMENT_SQL)
def restatement_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive assertions of one fact whose values differ beyond tolerance."""
    return gold.restatement_events(facts(spark, sf_dir), companies(spark, sf_dir))


FINANCIALS_SQL = O.with_ctes(
    f"""SELECT l.cik, c.company_name, l.concept_canonical, l.unit, l.period_start, l.period_end, l.period_type,
         CAST(l.value AS DOUBLE) AS value, CAST(l.decimals AS BIGINT) AS decimals,
         CAST(l.fiscal_year AS BIGINT) AS fiscal_year, l.fiscal_period, l.accession_number, l.form_type,
         l.filed_date, l.assertion_count, l.was_restated, {O.META}
       FROM latest l LEFT JOIN companies c ON l.cik = c.cik WHERE l.rn = 1""",
    facts=O.FACTS, companies=O.COMPANIES, seq=O.FACT_SEQUENCE,
    latest=f"""SELECT *, row_number() OVER k AS rn, count(*) OVER k AS assertion_count,
                  bool_or({O.IS_EVENT}) OVER k AS was_restated
               FROM seq WINDOW k AS (PARTITION BY cik, concept_canonical, unit, period_start, period_end,
                  period_type ORDER BY filed_date DESC, accession_number DESC, tag_pref DESC, value DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")


@register("financials_current", FINANCIALS_SQL)
def financials_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest assertion per fact key with assertion_count and was_restated."""
    return gold.financials_current(facts(spark, sf_dir), companies(spark, sf_dir))


ACTIVITY_SQL = O.with_ctes(
    f"""SELECT filed_date, base_form_type, count(*) AS filing_count,
           count(*) FILTER (WHERE is_amendment) AS amendment_count,
           count(DISTINCT cik) AS distinct_cik_count, {O.META}
        FROM filings GROUP BY filed_date, base_form_type""",
    index_rows=O.INDEX_ROWS, typed=O.SILVER_FILING,
    filings="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number
                 ORDER BY cik, logical_date, form_type) AS rn FROM typed) WHERE rn = 1""")


@register("filing_activity_daily", ACTIVITY_SQL)
def filing_activity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings, amendments and distinct filers per (filed_date, base_form_type)."""
    return gold.filing_activity_daily(silver_filings(spark, sf_dir))


SPAN_SQL = O.with_ctes(
    """SELECT CAST(date_trunc('month', filed_date) AS DATE) AS month, base_form_type, count(*) AS filing_count,
              count(*) FILTER (WHERE is_amendment) AS amendment_count, count(DISTINCT cik) AS distinct_cik_count,
              true AS estimate_within_bound
       FROM filings GROUP BY 1, 2""",
    index_rows=O.INDEX_ROWS, typed=O.SILVER_FILING,
    filings="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number
                 ORDER BY cik, logical_date, form_type) AS rn FROM typed) WHERE rn = 1""")


@register("activity_span", SPAN_SQL)
def activity_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly activity from stored daily sketches, its estimated filers held against the exact count."""
    filings, path = silver_filings(spark, sf_dir), scratch_dir(spark, "activity-sketches")
    gold.activity_sketches(filings).write.parquet(path)
    month = F.trunc("filed_date", "month").alias("month")
    span = gold.activity_of_span(spark.read.parquet(path), month, "base_form_type")
    exact = filings.groupBy(month, "base_form_type").agg(F.countDistinct("cik").alias("distinct_cik_count"))
    off = F.abs(F.col("distinct_cik_estimate") - F.col("distinct_cik_count"))
    return span.join(exact, ["month", "base_form_type"]).select(
        "month", "base_form_type", "filing_count", "amendment_count", "distinct_cik_count",
        (off <= gold.SKETCH_BOUND * F.col("distinct_cik_count")).alias("estimate_within_bound"))


PROFILE_SQL = O.with_ctes(
    f"""SELECT d.cik, d.company_name, d.sic, d.sic_description, d.entity_type, d.state_of_incorporation,
           d.fiscal_year_end, CAST(NULL AS VARCHAR) AS tickers, CAST(NULL AS VARCHAR) AS exchanges,
           coalesce(f.filing_count, 0) AS filing_count, f.first_filed_date, f.last_filed_date,
           coalesce(r.restatement_count, 0) AS restatement_count, {O.META}
        FROM dim d LEFT JOIN fa f ON d.cik = f.cik LEFT JOIN ra r ON d.cik = r.cik""",
    dim=f"""SELECT {O.pad('c_custkey')} AS cik, c_name AS company_name, CAST(c_nationkey AS VARCHAR) AS sic,
              c_mktsegment AS sic_description, 'operating' AS entity_type,
              CAST(NULL AS VARCHAR) AS state_of_incorporation, '1231' AS fiscal_year_end FROM customer""",
    index_rows=O.INDEX_ROWS, typed=O.SILVER_FILING,
    filings="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number
                 ORDER BY cik, logical_date, form_type) AS rn FROM typed) WHERE rn = 1""",
    fa="""SELECT cik, count(*) AS filing_count, min(filed_date) AS first_filed_date,
             max(filed_date) AS last_filed_date FROM filings GROUP BY cik""",
    facts=O.FACTS, seq=O.FACT_SEQUENCE,
    ra=f"SELECT cik, count(*) AS restatement_count FROM seq WHERE {O.IS_EVENT} GROUP BY cik")


@register("company_profile", PROFILE_SQL)
def company_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per company: filing span/count and restatement count, zero-filled."""
    dim = B.company_dimension_from_customer(B.table(spark, sf_dir, "customer"))
    ev = gold.restatement_events(facts(spark, sf_dir))
    return gold.company_profile(dim, silver_filings(spark, sf_dir), ev)
