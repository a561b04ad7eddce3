"""Streaming queries: incremental bronze ingest and micro-batch silver merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.plans import landed_inputs as L
from factlake.plans import oracle as O
from factlake.plans.landing_queries import BRONZE_INDEX_SQL, INDEX_ENV, _partition_of
from factlake.plans.request_queries import LOG, _log
from factlake.plans.registry import register
from factlake.plans.silver_queries import SILVER_FILING_SQL
from factlake.session import scratch_dir
from factlake.streaming import audit, ingest

SPLIT = "2024-01-16"


@register("stream_bronze", BRONZE_INDEX_SQL)
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files ingested incrementally: first half of the dates, then the rest,
    then an unchanged root (adds nothing); every file exactly once."""
    root = L.land_index(spark, sf_dir, dates=(None, SPLIT))
    table, ckpt = scratch_dir(spark, "bronze-stream"), scratch_dir(spark, "ckpt")
    ingest.bronze_stream(spark, root, table, ckpt, max_files=100)
    L.land_index(spark, sf_dir, root=root, dates=(SPLIT, None))
    ingest.bronze_stream(spark, root, table, ckpt, max_files=100)
    ingest.bronze_stream(spark, root, table, ckpt, max_files=100)
    b = spark.read.parquet(table)
    return b.withColumn("_source_partition", _partition_of("_source_file")).drop("_source_file")


@register("stream_merge", SILVER_FILING_SQL)
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches (100 files each, two landing waves) merged by accession into the bucketed silver table."""
    root = L.land_index(spark, sf_dir, dates=(None, SPLIT))
    table, ckpt = scratch_dir(spark, "silver"), scratch_dir(spark, "ckpt")
    ingest.silver_merge_stream(spark, root, table, ckpt, max_files=100, n_buckets=16)
    L.land_index(spark, sf_dir, root=root, dates=(SPLIT, None))
    s = ingest.silver_merge_stream(spark, root, table, ckpt, max_files=100, n_buckets=16).read()
    return s.select("accession_number", "cik", "company_name", "form_type", "base_form_type", "is_amendment",
                    "filed_date", "primary_doc_url", F.col("logical_date"))


@register("stream_dedupe", O.with_ctes(
    """SELECT resource_id, content_sha256, CAST(min(logical_date) AS DATE) AS logical_date, CAST(1 AS BIGINT) AS copies
       FROM env GROUP BY resource_id, content_sha256""", **INDEX_ENV))
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed envelopes deduplicated by content as they stream in.  The later half of the dates lands first,
    then the earlier half (older than everything seen, yet new), then the later half again."""
    root = L.land_index(spark, sf_dir, dates=(SPLIT, None))
    table, ckpt = scratch_dir(spark, "bronze-dedupe"), scratch_dir(spark, "ckpt")
    ingest.bronze_stream(spark, root, table, ckpt, max_files=100, dedupe=True)
    for dates in ((None, SPLIT), (SPLIT, None)):
        L.land_index(spark, sf_dir, root=root, dates=dates)
        ingest.bronze_stream(spark, root, table, ckpt, dedupe=True)
    b = spark.read.parquet(table)
    return b.groupBy("resource_id", "content_sha256").agg(F.min("logical_date").alias("logical_date"), F.count("*").alias("copies"))


@register("stream_rate_audit", O.with_ctes(
    """SELECT date_trunc('second', requested_at) AS second, count(*) AS requests, count(*) > 5 AS over_cap
       FROM log GROUP BY ALL""", log=LOG))
def stream_rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per second from a streamed log whose later half arrives first: late requests and the last
    seconds all count."""
    log = _log(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType) for f in audit.LOG_SCHEMA.fields])
    src_dir, out, ckpt = scratch_dir(spark, "log"), scratch_dir(spark, "audit"), scratch_dir(spark, "ckpt")
    late = F.to_date("requested_at") < F.lit(SPLIT).cast("date")
    for part in (~late, late):
        log.where(part).write.mode("append").parquet(src_dir)
        audit.rate_audit_stream(spark, src_dir, out, ckpt)
    return audit.rate_audit_table(spark, out)
