"""Work-list queries: universe, request plan, resume, coverage and fetch audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.plans import bindings as B
from factlake.plans import landed_inputs
from factlake.plans import oracle as O
from factlake.plans import requests as R
from factlake.plans.registry import register
from factlake.session import scratch_dir
from factlake.sources.landing import read_completed_pairs
from factlake.sources.universe import read_universe


def _universe(spark, sf_dir):
    return R.universe(B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cik")))


def _plan(spark, sf_dir):
    return R.request_plan(_universe(spark, sf_dir), B.completed_from_orders(B.table(spark, sf_dir, "orders")))


UNIVERSE = f"SELECT DISTINCT {O.pad('c_custkey')} AS cik FROM customer"
COMPLETED = f"""SELECT DISTINCT {O.pad('o_custkey')} AS cik, 'Revenues' AS concept,
                  CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE 'env:' || {O.pad('o_custkey')} || '/Revenues' END AS envelope
                FROM orders WHERE o_orderstatus = 'F'"""
CONCEPTS = f"SELECT unnest({O.CONCEPT_LIST}) AS concept"
PLAN = """SELECT u.cik, c.concept, u.cik || '/' || c.concept AS resource_id,
                 printf('https://data.sec.gov/api/xbrl/companyconcept/CIK%s/us-gaap/%s.json', u.cik, c.concept)
                   AS request_url
          FROM universe u, concepts c
          WHERE NOT EXISTS (SELECT 1 FROM completed d WHERE d.cik = u.cik AND d.concept = c.concept)"""


@register("universe", O.with_ctes("SELECT cik FROM universe", universe=UNIVERSE))
def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, distinct company keys (the bounded universe)."""
    return _universe(spark, sf_dir)


@register("universe_files", O.with_ctes("SELECT cik FROM universe", universe=UNIVERSE))
def universe_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The universe read from JSON list files of objects, numbers and padded strings, with repeats."""
    return read_universe(spark, landed_inputs.write_universe_files(spark, sf_dir))


@register("universe_first", O.with_ctes("SELECT cik FROM universe ORDER BY cik LIMIT 100", universe=UNIVERSE))
def universe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 companies of the universe files, in key order (the limit of a run is the feature)."""
    return read_universe(spark, landed_inputs.write_universe_files(spark, sf_dir), limit=100)


@register("universe_semi", O.with_ctes(
    """SELECT cik, concept_tag, accession_number, filed_date, CAST(value AS DOUBLE) AS value
       FROM facts WHERE cik IN (SELECT cik FROM universe)""", universe=UNIVERSE, facts=O.FACTS))
def universe_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts restricted to companies in the universe (semi join)."""
    f = B.facts_from_lineitem(B.table(spark, sf_dir, "lineitem"))
    return f.join(_universe(spark, sf_dir), "cik", "left_semi").select(
        "cik", "concept_tag", "accession_number", "filed_date", "value")


@register("request_plan", O.with_ctes(
    "SELECT * FROM plan", universe=UNIVERSE, completed=COMPLETED, concepts=CONCEPTS, plan=PLAN))
def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """universe x 15 concepts minus pairs completed by an interrupted run."""
    return _plan(spark, sf_dir)


@register("request_plan_summary", O.with_ctes(
    """SELECT (SELECT count(*) FROM universe) AS universe_size, CAST(15 AS BIGINT) AS concept_count,
              (SELECT count(*) FROM universe) * 15 AS planned,
              (SELECT count(*) FROM (SELECT DISTINCT cik, concept FROM completed
                 WHERE cik IN (SELECT cik FROM universe))) AS completed,
              (SELECT count(*) FROM plan) AS pending""",
    universe=UNIVERSE, completed=COMPLETED, concepts=CONCEPTS, plan=PLAN))
def request_plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned, completed and pending request counts."""
    return R.plan_summary(_universe(spark, sf_dir), B.completed_from_orders(B.table(spark, sf_dir, "orders")))


@register("completed_pairs", O.with_ctes(
    "SELECT cik, concept, envelope IS NOT NULL AS has_envelope FROM completed", completed=COMPLETED))
def completed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed-work file round trip: blank and truncated lines are skipped."""
    done = B.completed_from_orders(B.table(spark, sf_dir, "orders"))
    cust = B.table(spark, sf_dir, "customer")
    good = done.select(F.to_json(F.struct("cik", "concept", "envelope"), {"ignoreNullFields": "false"})
                       .alias("value"))
    truncated = cust.where(F.col("c_acctbal") < 0).select(
        F.format_string('{"cik": "%010d", "concept": "NetInc', F.col("c_custkey")).alias("value"))
    blank = cust.where(F.col("c_acctbal") < 0).select(F.lit("").alias("value"))
    path = scratch_dir(spark, "completed")
    good.unionByName(truncated).unionByName(blank).write.mode("overwrite").text(path)
    pairs = read_completed_pairs(spark, path)
    return pairs.select("cik", "concept", F.col("envelope").isNotNull().alias("has_envelope"))


FETCHED = """SELECT p.cik, p.concept, CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'env:' || p.resource_id END AS envelope
             FROM plan p LEFT JOIN cust c ON p.cik = c.cik"""
CUST = f"SELECT {O.pad('c_custkey')} AS cik, c_acctbal FROM customer"


@register("resume_union", O.with_ctes(
    """SELECT cik, concept, envelope, 'resumed' AS origin FROM completed WHERE envelope IS NOT NULL
       UNION ALL SELECT cik, concept, envelope, 'fetched' AS origin FROM fetched WHERE envelope IS NOT NULL""",
    universe=UNIVERSE, completed=COMPLETED, concepts=CONCEPTS, plan=PLAN, cust=CUST, fetched=FETCHED))
def resume_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resumed pairs plus newly fetched ones; not-reported (null envelope) pairs land nothing."""
    done = B.completed_from_orders(B.table(spark, sf_dir, "orders"))
    fetched = B.fetched_for_plan(_plan(spark, sf_dir), B.table(spark, sf_dir, "customer"))
    return R.resume_union(done, fetched)


COVERAGE_COLS = ", ".join(f"max(CASE WHEN concept = '{c}' THEN is_reported END) AS \"{c}\"" for c in C.CONCEPT_SET)


@register("concept_coverage", O.with_ctes(
    f"SELECT cik, {COVERAGE_COLS} FROM allpairs GROUP BY cik",
    universe=UNIVERSE, completed=COMPLETED, concepts=CONCEPTS, plan=PLAN, cust=CUST, fetched=FETCHED,
    allpairs="""SELECT cik, concept, envelope IS NOT NULL AS is_reported FROM completed
                UNION ALL SELECT cik, concept, envelope IS NOT NULL FROM fetched"""))
def concept_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company x concept matrix of reported (True) / not reported (False)."""
    done = B.completed_from_orders(B.table(spark, sf_dir, "orders"))
    fetched = B.fetched_for_plan(_plan(spark, sf_dir), B.table(spark, sf_dir, "customer"))
    pairs = done.unionByName(fetched).select("cik", "concept", F.col("envelope").isNotNull().alias("is_reported"))
    return R.coverage(pairs)


LOG = f"""SELECT event_id AS request_id, ts AS requested_at, {O.pad('user_id')} AS resource_cik,
            printf('https://data.sec.gov/submissions/CIK%s.json', {O.pad('user_id')}) AS url,
            ['filing_index', 'company_submissions', 'company_concept'][user_id % 3 + 1] AS stream,
            CASE WHEN event_type = 'view' AND value > 150 THEN NULL WHEN event_type = 'signup' THEN 404 WHEN event_type = 'error' THEN 503
                 WHEN event_type = 'purchase' THEN 429 ELSE 200 END
              AS http_status
          FROM events"""


def _log(spark, sf_dir):
    return B.request_log_from_events(B.table(spark, sf_dir, "events"))


@register("fetch_outcomes", O.with_ctes(
    """SELECT request_id, stream, CAST(http_status AS BIGINT) AS http_status,
         CASE WHEN http_status = 200 THEN 'ok'
              WHEN http_status = 404 AND stream = 'filing_index' THEN 'no_filings'
              WHEN http_status = 404 AND stream = 'company_concept' THEN 'not_reported'
              WHEN http_status = 404 THEN 'failed'
              WHEN http_status = 403 THEN 'forbidden_or_missing'
              WHEN http_status IS NULL OR http_status IN (429, 500, 502, 503, 504) THEN 'retryable'
              ELSE 'unexpected' END AS outcome,
         http_status IS NULL OR http_status IN (429, 500, 502, 503, 504) AS retryable FROM log""", log=LOG))
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request: outcome class by (stream, status) and whether it is retryable."""
    return R.fetch_outcomes(_log(spark, sf_dir))


@register("rate_audit", O.with_ctes(
    """SELECT date_trunc('hour', s) AS bucket_start, CAST(sum(n) AS BIGINT) AS requests, max(n) AS peak_rps,
              count(*) FILTER (WHERE n > 5) AS seconds_over_cap, max(n) > 5 AS throttled
       FROM (SELECT date_trunc('second', requested_at) AS s, count(*) AS n FROM log GROUP BY 1) GROUP BY 1""",
    log=LOG))
def rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly request counts, peak per-second rate and seconds above the 5 rps cap."""
    return R.rate_audit(_log(spark, sf_dir))


@register("retry_accounting", O.with_ctes(
    """SELECT url, attempts, first_attempt_at, last_attempt_at, CAST(http_status AS BIGINT) AS final_status,
              coalesce(http_status = 200, false) AS succeeded,
              attempts >= 5 AND (http_status IS NULL OR http_status IN (429, 500, 502, 503, 504)) AS gave_up
       FROM ranked WHERE newest = 1""", log=LOG,
    ranked="""SELECT *, row_number() OVER (PARTITION BY url ORDER BY requested_at DESC, request_id DESC) AS newest, count(*) OVER (PARTITION BY url) AS attempts,
                min(requested_at) OVER (PARTITION BY url) AS first_attempt_at, max(requested_at) OVER (PARTITION BY url) AS last_attempt_at FROM log"""))
def retry_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per URL: attempts, final status, success and whether retries were exhausted."""
    return R.retry_accounting(_log(spark, sf_dir))


@register("missing_resources", O.with_ctes(
    """SELECT u.cik, coalesce(r.requests, 0) AS requests, coalesce(r.landed, 0) AS landed,
              CASE WHEN r.requests IS NULL THEN 'not_requested' WHEN r.landed > 0 THEN 'landed'
                   ELSE 'missing' END AS status
       FROM universe u LEFT JOIN (SELECT resource_cik AS cik, count(*) AS requests,
                                         count(*) FILTER (WHERE http_status = 200) AS landed
                                  FROM log GROUP BY 1) r ON u.cik = r.cik""",
    universe=UNIVERSE, log=LOG))
def missing_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe members requested vs landed vs missing."""
    return R.missing_resources(_universe(spark, sf_dir), _log(spark, sf_dir))
