"""Landing and bronze queries: envelopes written from the driver's tables to the
shared checkpoint folder, read back, validated, unwrapped and de-duplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.functions import keys as K
from factlake.operators import bronze, setops, silver
from factlake.plans import landed_inputs as L
from factlake.plans import oracle as O
from factlake.plans.registry import register
from factlake.session import scratch_dir
from factlake.sinks import landing as sink
from factlake.sources import landing as src

ENV_FIELDS = list(C.ENVELOPE_FIELDS)
BATCH = ("'filing_index-' || strftime(logical_date, '%Y%m%d') || '-' || "
         "substr(sha256('filing_index|' || CAST(logical_date AS VARCHAR)), 1, 12)")
IDX_FIELDS = ("'accession_number': accession_number, 'cik': cik, 'company_name': company_name, "
              "'date_filed': date_filed, 'file_name': file_name, 'form_type': form_type")
INDEX_ENV = dict(
    index_rows=O.INDEX_ROWS.replace("\n  FROM events", ", ts, event_type, props, value\n  FROM events"),
    payloads=f"""SELECT *, CAST(CASE WHEN event_type = 'error'
                   THEN to_json({{{IDX_FIELDS}, 'props': json(props), 'severity': 'high'}})
                   ELSE to_json({{{IDX_FIELDS}}}) END AS VARCHAR) AS payload_json FROM index_rows""",
    env=f"""SELECT '1' AS envelope_version, 'sec_edgar' AS source_system, 'filing_index' AS stream,
               accession_number AS resource_id, CAST(logical_date AS VARCHAR) AS logical_date, {BATCH} AS batch_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS fetched_at,
               printf('https://www.sec.gov/Archives/edgar/daily-index/%d/QTR%d/form.%s.idx',
                      year(logical_date), quarter(logical_date), strftime(logical_date, '%Y%m%d')) AS request_url,
               CAST(200 AS BIGINT) AS http_status, sha256(payload_json) AS content_sha256, payload_json,
               event_type, value, props, form_type, company_name, cik, date_filed, accession_number, file_name
            FROM payloads""")
ENV_COLS = ", ".join(ENV_FIELDS)


def _landed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.read_landing(spark, L.land_index(spark, sf_dir), "filing_index")


@register("landing_scan", O.with_ctes(f"SELECT {ENV_COLS} FROM env", **INDEX_ENV))
def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes written under logical_date= partitions and scanned back with the declared schema."""
    return _landed_index(spark, sf_dir).select(*ENV_FIELDS)


@register("envelope_validate", O.with_ctes(
    """SELECT CASE WHEN event_type = 'purchase' AND value > 400 THEN NULL ELSE resource_id END AS resource_id,
              event_type NOT IN ('error', 'signup') AND NOT (event_type = 'purchase' AND value > 400)
                AND NOT (event_type = 'click' AND value > 450) AS is_valid,
              CASE WHEN event_type = 'purchase' AND value > 400 THEN 'unparseable'
                   WHEN event_type = 'error' THEN 'missing:payload_json'
                   WHEN event_type = 'signup' THEN 'private_key:_ingest_ts'
                   WHEN event_type = 'click' AND value > 450 THEN 'http_status_not_int' END AS invalid_reason
       FROM env""", **INDEX_ENV))
def envelope_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw envelope lines checked against the contract (fields, types, no private keys)."""
    checked = src.validate_lines(spark.read.text(L.write_envelope_lines(spark, sf_dir)))
    return checked.select(F.get_json_object("value", "$.resource_id").alias("resource_id"), "is_valid",
                          "invalid_reason")


def _line(*left_out: str, first: str = "") -> str:
    """A landed line of the envelope (logical_date is in its path), as DuckDB SQL."""
    keys = [f for f in ENV_FIELDS if f not in ("logical_date", *left_out)]
    return "CAST(to_json({" + first + ", ".join(f"'{k}': {k}" for k in keys) + "}) AS VARCHAR)"


@register("landing_bad_lines", O.with_ctes(
    f"""SELECT CAST(logical_date AS DATE) AS logical_date,
              CASE WHEN event_type = 'purchase' THEN 'unparseable' WHEN event_type = 'error' THEN 'missing:payload_json'
                   WHEN event_type = 'signup' THEN 'private_key:_ingest_ts' ELSE 'http_status_not_int' END AS invalid_reason,
              CASE WHEN event_type = 'purchase' THEN substr({_line()}, 1, 40) WHEN event_type = 'error' THEN {_line("payload_json")}
                   WHEN event_type = 'signup' THEN {_line(first="'_ingest_ts': '2024-01-01T00:00:00Z', ")}
                   ELSE replace({_line()}, '"http_status":200', '"http_status":"200"') END AS line
       FROM env WHERE event_type IN ('error', 'signup') OR event_type IN ('purchase', 'click') AND value > 100""", **INDEX_ENV))
def landing_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines that break the envelope contract, with their text and the reason."""
    _, bad = src.read_checked(spark, L.land_faulty_lines(spark, sf_dir), "filing_index")
    return bad.drop("_source_file")


@register("bronze_concept", f"""
  SELECT d AS logical_date, {O.pad('o_custkey')} || '/' || tag AS resource_id, {O.pad('o_custkey')} AS cik, 'us-gaap' AS taxonomy, tag,
         'sec_edgar' AS _source_system, tag AS payload_tag,
         'company_concept-' || strftime(d, '%Y%m%d') || '-'
           || substr(sha256('company_concept|' || CAST(d AS VARCHAR)), 1, 12) AS _ingest_batch_id
  FROM (SELECT *, CAST(date_trunc('year', o_orderdate) AS DATE) AS d, {O.CONCEPT_LIST}[o_orderkey % 15 + 1] AS tag
        FROM orders WHERE o_orderstatus <> 'P')""")
def bronze_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed concept documents as bronze rows, key parts from the resource id."""
    good, _ = src.read_checked(spark, L.land_concepts(spark, sf_dir), "company_concept")
    b = bronze.company_concept_raw(good)
    return b.select("logical_date", "resource_id", "cik", "taxonomy", "tag", "_source_system",
                    F.get_json_object("payload_json", "$.tag").alias("payload_tag"), "_ingest_batch_id")


@register("landing_write_roundtrip", O.with_ctes(
    f"""SELECT CAST(logical_date AS DATE) AS logical_date, count(*) AS records, CAST(sum(strlen(line)) AS BIGINT) AS bytes,
              count(DISTINCT line) > 1 AS many_files,
              true AS identical_rerun
       FROM (SELECT logical_date, CAST(to_json({{'envelope_version': envelope_version, 'source_system': source_system,
                 'stream': stream, 'resource_id': resource_id, 'batch_id': batch_id, 'fetched_at': fetched_at,
                 'request_url': request_url, 'http_status': http_status, 'content_sha256': content_sha256,
                 'payload_json': payload_json}}) AS VARCHAR) AS line FROM env)
       GROUP BY logical_date""", **INDEX_ENV))
def landing_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write once, and write twice into another root: identical lines, and no date in one file."""
    once = L.land_index(spark, sf_dir)
    twice = L.land_index(spark, sf_dir)
    L.land_index(spark, sf_dir, root=twice)

    def lines(root):
        t = spark.read.text(sink.stream_root(root, "filing_index"))
        return t.select(F.col("logical_date").cast("string").alias("logical_date"), F.col("value").alias("line"),
                        F.col("_metadata.file_path").alias("file"))

    a, b = lines(once), lines(twice)
    diff = setops.replay_diff(a.select("logical_date", "line"), b.select("logical_date", "line"), "logical_date")
    per = b.groupBy("logical_date").agg(F.count(F.lit(1)).alias("records"),
                                        F.sum(F.octet_length("line")).alias("bytes"),
                                        (F.countDistinct("file") > 1).alias("many_files"))
    return per.join(diff.select("logical_date", "equivalent"), "logical_date", "left").select(
        F.to_date("logical_date").alias("logical_date"), "records", "bytes", "many_files",
        F.coalesce(F.col("equivalent"), F.lit(False)).alias("identical_rerun"))


@register("fanout_summary", O.with_ctes(
    """SELECT stream, CAST(logical_date AS DATE) AS logical_date, batch_id, count(*) AS records,
              CAST(sum(strlen(payload_json)) AS BIGINT) AS bytes, CAST(2 AS BIGINT) AS sinks_written, CAST(1 AS BIGINT) AS push_failed
       FROM env GROUP BY ALL""", **INDEX_ENV))
def fanout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered fan-out to a system of record, a copy and an unreachable copy."""
    env = L.index_envelopes_with_extras(spark, sf_dir)
    roots = [scratch_dir(spark, "primary"), scratch_dir(spark, "copy"), "unreachable-scheme://landing/copy"]
    res = sink.fan_out(env, roots, streams=("filing_index",))
    back = src.read_landing(spark, roots[0], "filing_index")
    return (back.groupBy("stream", F.to_date("logical_date").alias("logical_date"), "batch_id")
            .agg(F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("payload_json")).alias("bytes"))
            .select("*", F.lit(len(res.targets)).cast("bigint").alias("sinks_written"),
                    F.lit(len(res.failed)).cast("bigint").alias("push_failed")))


@register("dry_run_manifest", O.with_ctes(
    """SELECT stream, CAST(logical_date AS DATE) AS logical_date, batch_id, count(*) AS records,
              CAST(sum(strlen(payload_json)) AS BIGINT) AS bytes, CAST(1 AS BIGINT) AS requests,
              's3://raw-bucket/edgar/' || stream || '/logical_date=' || logical_date || '/' || batch_id || '.json.gz'
                AS target_s3,
              '/Volumes/edgar/landing/edgar/' || stream || '/logical_date=' || logical_date || '/' || batch_id
                || '.json.gz' AS target_volume,
              (SELECT count(*) FROM env) AS total_records,
              (SELECT CAST(sum(strlen(payload_json)) AS BIGINT) FROM env) AS total_bytes
       FROM env GROUP BY ALL""", **INDEX_ENV))
def dry_run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run would land, per batch, without writing (noop sink + observed totals)."""
    env = L.index_envelopes_with_extras(spark, sf_dir)
    totals = sink.dry_run(env)
    d = F.to_date("logical_date")
    return (env.groupBy("stream", d.alias("logical_date"), "batch_id")
            .agg(F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("payload_json")).alias("bytes"))
            .select("*", F.lit(1).cast("bigint").alias("requests"),
                    K.landing_path(F.lit("s3://raw-bucket"), "stream", "logical_date").alias("target_s3"),
                    K.landing_path(F.lit("/Volumes/edgar/landing"), "stream", "logical_date").alias("target_volume"),
                    F.lit(totals["records"]).cast("bigint").alias("total_records"),
                    F.lit(totals["bytes"]).cast("bigint").alias("total_bytes")))


BRONZE_INDEX_SQL = O.with_ctes(
    f"""SELECT CAST(logical_date AS DATE) AS logical_date, resource_id,
              CAST(strptime(fetched_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS TIMESTAMP) AS fetched_at,
              form_type, company_name, cik, date_filed, accession_number, file_name, batch_id AS _ingest_batch_id,
              {O.GENERATED_AT} AS _ingest_ts, 'logical_date=' || logical_date AS _source_partition,
              source_system AS _source_system, envelope_version AS _envelope_version,
              CASE WHEN event_type = 'error'
                   THEN CAST(to_json({{'props': json(props), 'severity': 'high'}}) AS VARCHAR) END AS _rescued_data
       FROM env""", **INDEX_ENV)


def _partition_of(path_col: str):
    return F.regexp_extract(F.col(path_col), r"(logical_date=[^/]+)", 1)


@register("bronze_filing_index", BRONZE_INDEX_SQL)
def bronze_filing_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.filing_index_raw from landed envelopes: payload fields as strings, rescue column."""
    b = bronze.filing_index_raw(_landed_index(spark, sf_dir))
    return b.withColumn("_source_partition", _partition_of("_source_file")).drop("_source_file")


@register("rescued_data", O.with_ctes(
    """SELECT resource_id, CASE WHEN event_type = 'error'
                   THEN CAST(to_json({'props': json(props), 'severity': 'high'}) AS VARCHAR) END AS _rescued_data
       FROM env""", **INDEX_ENV))
def rescued_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared payload keys rescued as JSON (NULL when none)."""
    b = bronze.filing_index_raw(_landed_index(spark, sf_dir))
    return b.select("resource_id", "_rescued_data")


@register("json_extract_preview", O.with_ctes(
    """SELECT resource_id, json_extract_string(payload_json, '$.form_type') AS form_type,
              json_extract_string(payload_json, '$.company_name') AS company_name,
              json_extract_string(payload_json, '$.cik') AS cik, count(*) OVER () AS total_rows
       FROM env ORDER BY resource_id LIMIT 10""", **INDEX_ENV))
def json_extract_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 10 landed rows by resource id with fields extracted from the payload and the total count."""
    env = _landed_index(spark, sf_dir)
    total = env.agg(F.count(F.lit(1))).scalar()
    top = env.orderBy("resource_id").limit(10)
    return top.select("resource_id", F.get_json_object("payload_json", "$.form_type").alias("form_type"),
                      F.get_json_object("payload_json", "$.company_name").alias("company_name"),
                      F.get_json_object("payload_json", "$.cik").alias("cik"), total.alias("total_rows"))


DOC_PAYLOAD = ("CAST(to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'text': "
               "CASE WHEN capture = 1 AND lang = 'de' THEN text || ' [rev]' ELSE text END}) AS VARCHAR)")
DOCS = dict(
    caps=f"""SELECT d.*, c.capture, c.day FROM documents d,
               (SELECT 0 AS capture, DATE '{L.CAPTURE_DATES[0]}' AS day
                UNION ALL SELECT 1, DATE '{L.CAPTURE_DATES[1]}') c""",
    docs=f"""SELECT {O.pad('doc_id')} AS resource_id, day AS logical_date, {DOC_PAYLOAD} AS payload_json,
                    capture FROM caps""")


def _bronze_docs(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    root = root or L.land_documents(spark, sf_dir)
    return bronze.company_submissions_raw(src.read_landing(spark, root, "company_submissions")) \
        .withColumn("content_sha256", F.sha2("payload_json", 256))


@register("bronze_documents", O.with_ctes(
    f"""SELECT logical_date, resource_id,
              CAST(CAST(logical_date AS VARCHAR) || ' 06:00:00' AS TIMESTAMP) AS fetched_at, resource_id AS cik,
              payload_json, 'company_submissions-' || strftime(logical_date, '%Y%m%d') || '-'
                || substr(sha256('company_submissions|' || CAST(logical_date AS VARCHAR)), 1, 12) AS _ingest_batch_id,
              'sec_edgar' AS _source_system, '1' AS _envelope_version
       FROM docs""", **DOCS))
def bronze_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze.company_submissions_raw: whole documents kept verbatim as payload strings, two captures."""
    b = _bronze_docs(spark, sf_dir)
    return b.select("logical_date", "resource_id", "fetched_at", "cik", "payload_json", "_ingest_batch_id",
                    "_source_system", "_envelope_version")


@register("bronze_idempotent", O.with_ctes(
    "SELECT resource_id, logical_date, sha256(payload_json) AS content_sha256 FROM docs", **DOCS))
def bronze_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Idempotent bronze: run 1 ingests day 1, run 2 adds day 2, run 3 finds nothing new, and run 4 finds
    day 1 landed once more (other files, same content), which adds nothing."""
    root = L.land_documents(spark, sf_dir, captures=(0,))
    table = scratch_dir(spark, "bronze")
    for landed in ((), (1,), (), (0,)):
        if landed:
            L.land_documents(spark, sf_dir, root=root, captures=landed)
        bronze.refresh_dates(_bronze_docs(spark, sf_dir, root), src.landed_files(spark, root, "company_submissions"), table)
    return spark.read.parquet(table).select("resource_id", "logical_date", "content_sha256")


@register("bronze_dedupe", O.with_ctes(
    """SELECT resource_id, sha256(payload_json) AS content_sha256, min(logical_date) AS logical_date,
              count(*) AS captures FROM docs GROUP BY 1, 2""", **DOCS))
def bronze_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identical re-landings collapse; revised contents of a resource stay separate rows."""
    d = bronze.dedupe_captures(_bronze_docs(spark, sf_dir))
    return d.select("resource_id", "content_sha256", "logical_date", "captures")


@register("content_change", O.with_ctes(
    """SELECT resource_id, logical_date, h AS content_sha256, p AS previous_sha256,
              p IS NOT NULL AND p <> h AS changed
       FROM (SELECT resource_id, logical_date, sha256(payload_json) AS h,
                    lag(sha256(payload_json)) OVER (PARTITION BY resource_id ORDER BY logical_date) AS p FROM docs)""",
    **DOCS))
def content_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per resource and capture: previous content hash and whether the content changed."""
    return bronze.content_changes(_bronze_docs(spark, sf_dir))


CONCEPT_ROWS = f"""
  SELECT {O.pad('o_custkey')} AS cik, 'us-gaap' AS taxonomy, tag AS concept_tag,
         CASE WHEN tag IN ('Revenues', 'RevenueFromContractWithCustomerExcludingAssessedTax')
              THEN 'revenue_total' END AS concept_canonical,
         u.unit, CASE WHEN u.unit = 'USD' AND o_orderstatus = 'F' THEN d - 364 END AS period_start, d AS period_end,
         CASE WHEN u.unit = 'USD' AND o_orderstatus = 'F' THEN 'duration' ELSE 'instant' END AS period_type,
         printf('%010d-%02d-%06d', o_custkey, year(d) % 100, o_orderkey % 1000000) AS accession_number,
         CASE WHEN u.unit = 'USD' THEN CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS DOUBLE)
              ELSE CAST(o_orderkey AS DOUBLE) END AS value,
         CAST(NULL AS BIGINT) AS decimals, CAST(year(d) AS BIGINT) AS fiscal_year,
         CASE WHEN u.unit = 'USD' THEN 'FY' ELSE 'Q4' END AS fiscal_period,
         CASE WHEN u.unit = 'USD' THEN '10-K' ELSE '10-Q' END AS form_type,
         CASE WHEN u.unit = 'USD' THEN d + 30 ELSE d + 45 END AS filed_date,
         CASE WHEN u.unit = 'USD' AND o_orderstatus = 'F' THEN 'CY' || CAST(year(d) AS VARCHAR) END AS frame
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, {O.CONCEPT_LIST}[o_orderkey % 15 + 1] AS tag
        FROM orders WHERE o_orderstatus <> 'P') o,
       (SELECT 'USD' AS unit UNION ALL SELECT 'shares') u"""


@register("concept_facts", CONCEPT_ROWS)
def concept_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept documents exploded to one row per assertion (units map, then array)."""
    f = silver.facts_from_concepts(L.concept_documents(spark, sf_dir))
    return f.drop("logical_date")


SUBMISSION_ROWS = f"""
  SELECT o_orderkey, {O.pad('o_custkey')} AS cik, 'Company ' || CAST(o_custkey AS VARCHAR) AS company_name,
         o_orderstatus AS sic, o_orderpriority AS sic_description,
         array_to_string(list_sort(['T' || o_orderstatus, 'A', 'Z']), ',') AS tickers, 'NASDAQ,NYSE' AS exchanges,
         'Old ' || CAST(o_custkey AS VARCHAR) AS former_names,
         printf('%010d-%02d-%06d', o_custkey, (year(d) + k) % 100, o_orderkey % 1000000) AS accession_number,
         CAST(d + k AS VARCHAR) AS filing_date, CASE WHEN k = 0 THEN '10-K' ELSE '10-K/A' END AS form_type,
         CASE WHEN k = 0 THEN printf('d%d.htm', o_orderkey) END AS primary_document
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders), (SELECT 0 AS k UNION ALL SELECT 1)"""


@register("submissions_flatten", SUBMISSION_ROWS)
def submissions_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submissions documents: company attributes (arrays sorted) and recent filings from parallel arrays."""
    return silver.flatten_submissions(L.submissions_documents(spark, sf_dir), keep=("o_orderkey",))
