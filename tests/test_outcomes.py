"""Freshness to the second and outcomes of transport errors."""

import pytest

from factlake.operators import dq
from factlake.plans import requests


@pytest.mark.parametrize("now, stale", [("2026-01-03 00:00:00", False), ("2026-01-03 00:30:00", True), ("2026-01-02 23:59:59", False)])
def test_freshness_counts_seconds(spark, now, stale):
    filings = spark.sql("SELECT DATE'2026-01-01' AS filed_date")
    assert dq.freshness(filings, now).first().is_stale is stale


def test_empty_table_is_stale(spark):
    assert dq.freshness(spark.sql("SELECT DATE'2026-01-01' AS filed_date").limit(0), "2026-01-03 00:00:00").first().is_stale is True


def test_transport_error_is_retryable(spark):
    log = spark.createDataFrame([(1, "filing_index", None), (2, "filing_index", 503), (3, "filing_index", 200)],
                                "request_id long, stream string, http_status int")
    got = {r.request_id: (r.outcome, r.retryable) for r in requests.fetch_outcomes(log).collect()}
    assert got == {1: ("retryable", True), 2: ("retryable", True), 3: ("ok", False)}


def test_a_final_transport_error_is_a_failure(spark):
    log = spark.sql("""SELECT 1L request_id, timestamp'2026-01-01 00:00:00' requested_at, 'u' url, CAST(NULL AS INT) http_status
                       UNION ALL SELECT 2L, timestamp'2026-01-01 00:00:01', 'v', 200""")
    got = {r.url: (r.final_status, r.succeeded, r.gave_up) for r in requests.retry_accounting(log, max_attempts=1).collect()}
    assert got == {"u": (None, False, True), "v": (200, True, False)}
