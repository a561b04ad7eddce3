"""Silver typing and identity-expression queries (filings, keys, hashes, envelopes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.functions import keys as K
from factlake.operators import silver
from factlake.plans import bindings as B
from factlake.plans import oracle as O
from factlake.plans.registry import register
from factlake.sources import landing


def _events(spark, sf_dir):
    return B.table(spark, sf_dir, "events")


SILVER_FILING_SQL = O.with_ctes(
    """SELECT accession_number, cik, company_name, form_type, base_form_type, is_amendment, filed_date,
              primary_doc_url, logical_date
       FROM (SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY cik, logical_date, form_type) rn
             FROM typed) WHERE rn = 1""",
    index_rows=O.INDEX_ROWS, typed=O.SILVER_FILING)


@register("silver_filing", SILVER_FILING_SQL)
def silver_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed filings: padded cik, base form, amendment flag, filed date, document URL."""
    return silver.dedupe_filings(silver.type_filings(B.index_rows_from_events(_events(spark, sf_dir))))


CANONICAL_SQL = O.with_ctes(
    """SELECT p_partkey, concept_tag,
              CASE WHEN concept_tag IN ('Revenues', 'RevenueFromContractWithCustomerExcludingAssessedTax')
                   THEN 'revenue_total' END AS concept_canonical,
              coalesce(CASE WHEN concept_tag IN ('Revenues', 'RevenueFromContractWithCustomerExcludingAssessedTax')
                   THEN 'revenue_total' END, concept_tag) AS gold_concept
       FROM tags""",
    tags="SELECT p_partkey, " + O.CONCEPT_LIST + "[p_partkey % 15 + 1] AS concept_tag FROM part")


@register("concept_canonical", CANONICAL_SQL)
def concept_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical mapping of as-filed concepts (NULL when unmapped, as-filed tag kept)."""
    tags = F.array(*[F.lit(c) for c in C.CONCEPT_SET])
    p = B.table(spark, sf_dir, "part").select(
        "p_partkey", F.element_at(tags, (F.col("p_partkey") % 15 + 1).cast("int")).alias("concept_tag"))
    canon = B.concept_canonical(F.col("concept_tag"))
    return p.select("p_partkey", "concept_tag", canon.alias("concept_canonical"),
                    F.coalesce(canon, F.col("concept_tag")).alias("gold_concept"))


PAD_SQL = f"""SELECT c_custkey, {O.pad('c_custkey')} AS cik,
                     {O.pad('c_custkey * 100000000')} AS cik_wide,
                     regexp_matches({O.pad('c_custkey * 100000000')}, '^[0-9]{{10}}$') AS wide_is_valid
              FROM customer"""


@register("pad_key", PAD_SQL)
def pad_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded CIKs; values already 10+ digits are never truncated."""
    c = B.table(spark, sf_dir, "customer")
    wide = K.pad_cik(F.col("c_custkey") * 100000000)
    return c.select("c_custkey", K.pad_cik("c_custkey").alias("cik"), wide.alias("cik_wide"),
                    wide.rlike(C.CIK_PADDED_PATTERN).alias("wide_is_valid"))


URLS_SQL = f"""SELECT event_id,
    printf('https://www.sec.gov/Archives/edgar/daily-index/%d/QTR%d/form.%s.idx',
           year(ts), quarter(ts), strftime(ts, '%Y%m%d')) AS daily_index_url,
    printf('https://data.sec.gov/submissions/CIK%s.json', {O.pad('user_id')}) AS submissions_url,
    printf('https://data.sec.gov/api/xbrl/companyconcept/CIK%s/us-gaap/%s.json', {O.pad('user_id')},
           {O.CONCEPT_LIST}[user_id % 15 + 1]) AS concept_url
  FROM events"""


@register("source_urls", URLS_SQL)
def source_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source URLs: daily index (quarter from month), submissions, company concept."""
    tags = F.array(*[F.lit(c) for c in C.CONCEPT_SET])
    e = _events(spark, sf_dir)
    return e.select("event_id", K.daily_index_url("ts").alias("daily_index_url"),
                    K.submissions_url("user_id").alias("submissions_url"),
                    K.concept_url("user_id", F.element_at(tags, (F.col("user_id") % 15 + 1).cast("int")))
                    .alias("concept_url"))


BATCH_SQL = O.with_ctes(
    """SELECT stream, logical_date,
              stream || '-' || strftime(logical_date, '%Y%m%d') || '-'
                || substr(sha256(stream || '|' || CAST(logical_date AS VARCHAR)), 1, 12) AS batch_id,
              's3://raw-bucket/edgar/' || stream || '/logical_date=' || CAST(logical_date AS VARCHAR) || '/'
                || stream || '-' || strftime(logical_date, '%Y%m%d') || '-'
                || substr(sha256(stream || '|' || CAST(logical_date AS VARCHAR)), 1, 12) || '.json.gz' AS landing_path,
              '/edgar/' || stream || '/logical_date=' || CAST(logical_date AS VARCHAR) || '/'
                || stream || '-' || strftime(logical_date, '%Y%m%d') || '-'
                || substr(sha256(stream || '|' || CAST(logical_date AS VARCHAR)), 1, 12) || '.json.gz' AS relative_path
       FROM days, (SELECT unnest(['filing_index', 'company_submissions', 'company_concept']) AS stream)""",
    days="SELECT DISTINCT CAST(ts AS DATE) AS logical_date FROM events")


@register("batch_id", BATCH_SQL)
def batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic batch ids and landing paths per (stream, logical date), re-rooted."""
    days = _events(spark, sf_dir).select(F.to_date("ts").alias("logical_date")).distinct()
    d = days.select("logical_date", F.explode(F.array(*[F.lit(s) for s in C.STREAMS])).alias("stream"))
    path = K.landing_path(F.lit("s3://raw-bucket"), F.col("stream"), F.col("logical_date"))
    return d.select("stream", "logical_date", K.batch_id("stream", "logical_date").alias("batch_id"),
                    path.alias("landing_path"), K.reroot(path, "s3://raw-bucket").alias("relative_path"))


@register("content_hash", "SELECT doc_id, sha256(text) AS content_sha256, length(text) AS n_chars FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sha256 of each whole document text."""
    d = B.table(spark, sf_dir, "documents")
    return d.select("doc_id", K.content_hash("text").alias("content_sha256"),
                    F.length("text").cast("bigint").alias("n_chars"))


CANON_JSON_SQL = O.with_ctes(
    "SELECT event_id, payload_json, sha256(payload_json) AS content_sha256, props_canonical FROM p",
    p=f"""SELECT event_id, CAST(to_json({{'event_id': event_id, 'event_type': event_type,
             'ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'), 'user_id': user_id, 'value': value}}) AS VARCHAR)
             AS payload_json, CAST(json(props) AS VARCHAR) AS props_canonical FROM events""")


@register("canonical_json", CANON_JSON_SQL)
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON payloads (sorted keys, tight separators, nulls kept) and their hash."""
    e = _events(spark, sf_dir)
    payload = K.canonical_json(K.sorted_struct(
        event_id=F.col("event_id"), event_type=F.col("event_type"),
        ts=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), user_id=F.col("user_id"),
        value=F.col("value")))
    return e.select("event_id", payload.alias("payload_json"), K.content_hash(payload).alias("content_sha256"),
                    K.canonicalize_document("props").alias("props_canonical"))


ENVELOPE_SQL = O.with_ctes(
    f"""SELECT '1' AS envelope_version, 'sec_edgar' AS source_system, 'filing_index' AS stream,
              accession_number AS resource_id, CAST(logical_date AS VARCHAR) AS logical_date,
              'filing_index-' || strftime(logical_date, '%Y%m%d') || '-'
                || substr(sha256('filing_index|' || CAST(logical_date AS VARCHAR)), 1, 12) AS batch_id,
              fetched_at,
              printf('https://www.sec.gov/Archives/edgar/daily-index/%d/QTR%d/form.%s.idx',
                     year(logical_date), quarter(logical_date), strftime(logical_date, '%Y%m%d')) AS request_url,
              CAST(200 AS BIGINT) AS http_status, sha256(payload_json) AS content_sha256, payload_json
       FROM p""",
    index_rows=O.INDEX_ROWS.replace("FROM events", ", ts FROM events"),
    p=f"""SELECT *, CAST(to_json({{'accession_number': accession_number, 'cik': cik, 'company_name': company_name,
             'date_filed': date_filed, 'file_name': file_name, 'form_type': form_type}}) AS VARCHAR) AS payload_json,
             strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS fetched_at FROM index_rows""")


@register("build_envelope", ENVELOPE_SQL)
def build_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing envelopes around canonical index-row payloads (payload kept verbatim)."""
    return landing.index_envelopes(_events(spark, sf_dir))
