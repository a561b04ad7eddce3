"""Fetch-work planning and audit over tables: what to request, what is done,
what is missing, how requests fared, and whether the rate cap held.

The concept fan-out is a generator over a fixed 15-element literal (no join);
"already done" is an anti join on (cik, concept).  Audits are aggregations with
partial combine, so a hot resource or a burst second cannot skew them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.functions import keys as K


def universe(ciks: DataFrame, limit: int | None = None) -> DataFrame:
    """Padded, distinct CIKs in ascending order; ``limit`` keeps the first N (``--cik-limit``)."""
    u = ciks.select(K.pad_cik("cik").alias("cik")).where(F.col("cik").isNotNull()).distinct()
    return u.orderBy("cik").limit(limit) if limit is not None else u


def request_plan(universe_df: DataFrame, completed: DataFrame | None = None,
                 concepts: tuple[str, ...] = C.CONCEPT_SET) -> DataFrame:
    """universe x concept set, minus completed pairs, with the URL to fetch."""
    plan = universe_df.select("cik", F.explode(F.array(*[F.lit(c) for c in concepts])).alias("concept"))
    if completed is not None:
        plan = plan.join(completed.select("cik", "concept"), ["cik", "concept"], "left_anti")
    return plan.select("cik", "concept", F.concat_ws("/", "cik", "concept").alias("resource_id"),
                       K.concept_url("cik", "concept").alias("request_url"))


def plan_summary(universe_df: DataFrame, completed: DataFrame,
                 concepts: tuple[str, ...] = C.CONCEPT_SET) -> DataFrame:
    """planned = |universe| x |concepts|; completed pairs inside the plan; pending = the rest."""
    n = len(concepts)
    done = (completed.where(F.col("concept").isin(*concepts)).select("cik", "concept").distinct()
            .groupBy("cik").agg(F.count(F.lit(1)).alias("_done")))
    s = universe_df.select("cik").join(done, "cik", "left").agg(
        F.count(F.lit(1)).alias("universe_size"), F.coalesce(F.sum("_done"), F.lit(0)).alias("completed"))
    return s.select("universe_size", F.lit(n).cast("bigint").alias("concept_count"),
                    (F.col("universe_size") * n).alias("planned"), F.col("completed").cast("bigint").alias("completed"),
                    (F.col("universe_size") * n - F.col("completed")).cast("bigint").alias("pending"))


def resume_union(completed: DataFrame, fetched: DataFrame) -> DataFrame:
    """Completed pairs from an interrupted run plus the newly fetched ones; pairs whose
    envelope is null (not reported) are done but land nothing."""
    a = completed.select("cik", "concept", "envelope", F.lit("resumed").alias("origin"))
    b = fetched.select("cik", "concept", "envelope", F.lit("fetched").alias("origin"))
    return a.unionByName(b).where(F.col("envelope").isNotNull())


def coverage(reported: DataFrame, concepts: tuple[str, ...] = C.CONCEPT_SET) -> DataFrame:
    """Company x concept matrix: True reported, False requested but not reported (404)."""
    return (reported.groupBy("cik").pivot("concept", list(concepts))
            .agg(F.max(F.col("is_reported"))))


def classify_outcome(stream: Column, status: Column) -> Column:
    """HTTP status -> fetch outcome, per stream (404 means different things per stream).

    No status is a transport error, which is retried like a busy server."""
    retryable = is_retryable(status)
    return (F.when(status == 200, F.lit("ok"))
            .when((status == 404) & (stream == "filing_index"), F.lit("no_filings"))
            .when((status == 404) & (stream == "company_concept"), F.lit("not_reported"))
            .when(status == 404, F.lit("failed"))
            .when(status == 403, F.lit("forbidden_or_missing"))
            .when(retryable, F.lit("retryable"))
            .otherwise(F.lit("unexpected")))


def is_retryable(status: Column) -> Column:
    return status.isNull() | status.isin(*C.RETRYABLE_STATUSES)


def fetch_outcomes(log: DataFrame) -> DataFrame:
    return log.select(
        "request_id", "stream", "http_status",
        classify_outcome(F.col("stream"), F.col("http_status")).alias("outcome"),
        is_retryable(F.col("http_status")).alias("retryable"))


def rate_audit(log: DataFrame, cap_rps: int = C.RATE_LIMIT_DEFAULT_RPS, bucket: str = "1 hour") -> DataFrame:
    """Per bucket: requests, peak requests in any one second, and whether the cap was exceeded."""
    per_sec = log.groupBy(F.window("requested_at", "1 second").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    per_sec = per_sec.select(F.col("w.start").alias("second"), "n")
    return (per_sec.groupBy(F.window("second", bucket).alias("b"))
            .agg(F.sum("n").alias("requests"), F.max("n").alias("peak_rps"),
                 F.count_if(F.col("n") > cap_rps).alias("seconds_over_cap"))
            .select(F.col("b.start").alias("bucket_start"), "requests", "peak_rps", "seconds_over_cap",
                    (F.col("peak_rps") > cap_rps).alias("throttled")))


def retry_accounting(log: DataFrame, max_attempts: int = C.MAX_ATTEMPTS) -> DataFrame:
    """Per URL: attempts, first/last attempt, final status, success, gave_up (limit hit while retryable).

    A final transport error (no status) is a failure that may be retried."""
    g = log.groupBy("url").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min("requested_at").alias("first_attempt_at"),
        F.max("requested_at").alias("last_attempt_at"),
        F.max_by("http_status", F.struct("requested_at", "request_id")).alias("final_status"))
    return g.select("*", F.col("final_status").eqNullSafe(F.lit(200)).alias("succeeded"),
                    ((F.col("attempts") >= max_attempts) & is_retryable(F.col("final_status"))).alias("gave_up"))


def missing_resources(universe_df: DataFrame, log: DataFrame) -> DataFrame:
    """Per universe member: requested at all, landed (a 200), and the resulting status."""
    r = log.groupBy(F.col("resource_cik").alias("cik")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("http_status") == 200).alias("landed"))
    j = universe_df.select("cik").join(r, "cik", "left")
    return j.select("cik", F.coalesce("requests", F.lit(0)).alias("requests"),
                    F.coalesce("landed", F.lit(0)).alias("landed"),
                    F.when(F.col("requests").isNull(), F.lit("not_requested"))
                    .when(F.col("landed") > 0, F.lit("landed")).otherwise(F.lit("missing")).alias("status"))


def fetch_accounting(fetched: DataFrame) -> DataFrame:
    """Run counters over the pairs fetched in this run: requests made, records landed,
    and concepts not reported (404: a null envelope, done but landing nothing)."""
    return fetched.agg(F.count(F.lit(1)).alias("requests"),
                       F.count_if(F.col("envelope").isNotNull()).alias("records"),
                       F.count_if(F.col("envelope").isNull()).alias("not_reported"))
