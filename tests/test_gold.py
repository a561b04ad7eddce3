"""Gold marts: restatement semantics, latest view, hot-key equivalence, golden values."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from factlake.operators import gold, silver
from factlake.plans import bindings as B
from tests.conftest import SF_SMALL

# An invented company: one instant fact asserted by four reports, one of them a restatement.
ORIGINAL, RESTATED = 8_000_000, 7_200_000
ASSETS_DOC = {
    "cik": 4200017, "taxonomy": "us-gaap", "tag": "Assets", "label": "Assets", "description": "", "entityName": "E",
    "units": {"USD": [
        {"end": "2014-06-30", "val": ORIGINAL, "accn": "0000900001-14-000101", "fy": 2014, "fp": "FY",
         "form": "10-K", "filed": "2014-09-10"},
        {"end": "2014-06-30", "val": RESTATED, "accn": "0000900001-14-000155", "fy": 2014, "fp": "FY",
         "form": "10-K/A", "filed": "2014-11-24"},
        {"end": "2014-06-30", "val": RESTATED, "accn": "0000900001-15-000093", "fy": 2015, "fp": "FY",
         "form": "10-K", "filed": "2015-09-14", "frame": "CY2014Q2I"},
        {"end": "2014-06-30", "val": RESTATED + 1e-7, "accn": "0000900001-15-000041", "fy": 2015, "fp": "Q2",
         "form": "10-Q", "filed": "2015-02-09"},
        {"end": "2015-06-30", "val": 9_100_000, "accn": "0000900001-15-000093", "fy": 2015, "fp": "FY",
         "form": "10-K", "filed": "2015-09-14"},
    ]},
}


def _facts(spark, doc):
    docs = spark.createDataFrame([(json.dumps(doc), 200)], "payload_json string, http_status int")
    return silver.facts_from_concepts(docs)


def test_single_material_restatement(spark):
    ev = gold.restatement_events(_facts(spark, ASSETS_DOC)).collect()
    assert len(ev) == 1
    e = ev[0]
    assert e.original_accession_number == "0000900001-14-000101"
    assert e.restated_accession_number == "0000900001-14-000155"
    assert e.delta_abs == RESTATED - ORIGINAL
    assert e.days_to_restatement == 75
    assert round(e.delta_pct, 9) == (RESTATED - ORIGINAL) / ORIGINAL
    assert e.materiality_band == "material"
    assert e.cik == "0004200017" and e.period_type == "instant" and e.period_start is None


def test_latest_view(spark):
    fc = {r.period_end.isoformat(): r for r in gold.financials_current(_facts(spark, ASSETS_DOC)).collect()}
    r = fc["2014-06-30"]
    assert r.accession_number == "0000900001-15-000093"
    assert r.assertion_count == 4
    assert r.was_restated is True
    assert fc["2015-06-30"].assertion_count == 1 and fc["2015-06-30"].was_restated is False


def test_delta_pct_null_when_original_zero_is_material(spark):
    doc = json.loads(json.dumps(ASSETS_DOC))
    doc["units"]["USD"] = [
        {"end": "2020-01-01", "val": 0, "accn": "0000000001-20-000001", "filed": "2020-02-01"},
        {"end": "2020-01-01", "val": 5, "accn": "0000000001-20-000002", "filed": "2020-03-01"}]
    e = gold.restatement_events(_facts(spark, doc)).first()
    assert e.delta_pct is None and e.materiality_band == "material"


def test_band_edges(spark):
    c = F.col("p")
    df = spark.createDataFrame([(0.0099,), (0.01,), (0.05,), (0.0501,), (-0.2,)], "p double")
    got = [r.b for r in df.select(gold.materiality_band(c).alias("b")).collect()]
    assert got == ["immaterial", "notable", "notable", "material", "material"]


def _sorted(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_hot_keys_give_identical_gold(spark):
    facts = B.facts_from_lineitem(B.table(spark, SF_SMALL, "lineitem"))
    base_ev = _sorted(gold.restatement_events(facts), ["restatement_id", "delta_abs"])
    base_fc = _sorted(gold.financials_current(facts), ["cik", "concept_canonical", "period_start", "accession_number",
                                                       "assertion_count", "was_restated"])
    spark.conf.set("factlake.skew.hotKeyRows", "2")
    spark.conf.set("factlake.skew.sampleFraction", "1.0")
    try:
        ev = _sorted(gold.restatement_events(facts), ["restatement_id", "delta_abs"])
        fc = _sorted(gold.financials_current(facts), ["cik", "concept_canonical", "period_start", "accession_number",
                                                      "assertion_count", "was_restated"])
    finally:
        spark.conf.unset("factlake.skew.hotKeyRows")
        spark.conf.unset("factlake.skew.sampleFraction")
    assert ev == base_ev
    assert fc == base_fc


def test_profile_is_zero_filled(spark):
    comps = spark.createDataFrame([("0000000001", "A"), ("0000000002", "B")], "cik string, company_name string")
    comps = comps.select("*", *[F.lit(None).cast(t).alias(c) for c, t in [
        ("sic", "string"), ("sic_description", "string"), ("entity_type", "string"),
        ("state_of_incorporation", "string"), ("fiscal_year_end", "string"), ("tickers", "array<string>"),
        ("exchanges", "array<string>")]])
    filings = spark.createDataFrame([("0000000001", "2024-01-02")], "cik string, d string") \
        .select("cik", F.to_date("d").alias("filed_date"))
    events = spark.createDataFrame([], "cik string")
    p = {r.cik: r for r in gold.company_profile(comps, filings, events).collect()}
    assert p["0000000002"].filing_count == 0 and p["0000000002"].restatement_count == 0
    assert p["0000000001"].filing_count == 1


def test_tag_switch_inside_one_filing_is_not_a_restatement(spark):
    def fact(tag, val, accn, filed):
        return {"end": "2020-12-31", "start": "2020-01-01", "val": val, "accn": accn, "filed": filed, "form": "10-K"}
    rev = dict(ASSETS_DOC, tag="Revenues", units={"USD": [
        fact("Revenues", 100, "0000000001-21-000001", "2021-02-01"),
        fact("Revenues", 120, "0000000001-21-000002", "2021-05-01")]})
    rfc = dict(ASSETS_DOC, tag="RevenueFromContractWithCustomerExcludingAssessedTax", units={"USD": [
        fact("x", 90, "0000000001-21-000001", "2021-02-01"),
        fact("x", 120, "0000000001-21-000003", "2021-08-01")]})
    docs = spark.createDataFrame([(json.dumps(rev), 200), (json.dumps(rfc), 200)], "payload_json string, http_status int")
    facts = silver.facts_from_concepts(docs)
    ev = gold.restatement_events(facts).collect()
    # 100 (Revenues preferred in filing 1) -> 120 is the only change; 90 in filing 1 is dropped.
    assert [(e.original_value, e.restated_value) for e in ev] == [(Decimal("100.000000"), Decimal("120.000000"))]
    fc = gold.financials_current(facts).collect()
    assert len(fc) == 1 and fc[0].concept_canonical == "revenue_total" and fc[0].assertion_count == 3


def test_activity_counts_co_registrants_behind_a_switch(spark):
    rows = spark.createDataFrame(
        [("0000900002-26-088252", "0000001001", "10-K", "2026-07-29"),
         ("0000900002-26-088252", "0000001002", "10-K", "2026-07-29"),
         ("0000900002-26-000001", "0000001003", "10-K/A", "2026-07-29")],
        "accession_number string, cik string, form_type string, d string").select(
        "accession_number", "cik", "form_type", F.regexp_replace(F.upper("form_type"), "/A$", "").alias("base_form_type"),
        F.col("form_type").endswith("/A").alias("is_amendment"), F.to_date("d").alias("filed_date"),
        F.to_date("d").alias("logical_date"))
    deduped = silver.dedupe_filings(rows)
    a = gold.filing_activity_daily(deduped).first()
    b = gold.filing_activity_daily(deduped, all_filers=rows).first()
    assert (a.filing_count, a.amendment_count, a.distinct_cik_count) == (2, 1, 2)
    assert (b.filing_count, b.distinct_cik_count) == (2, 3)


def test_sketches_of_days_unite_over_any_span(spark):
    from pyspark.sql import functions as F

    from factlake.operators import gold
    filings = spark.sql("""SELECT concat('c', id % 30000) AS cik, date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) AS filed_date,
                                  IF(id % 3 = 0, '10-K', '8-K') AS base_form_type, id % 5 = 0 AS is_amendment FROM range(200000)""")
    days = gold.activity_sketches(filings)
    assert days.count() == 40
    for by in (["base_form_type"], [F.lit(1).alias("all")]):
        got = gold.activity_of_span(days, *by).collect()
        exact = {r[0]: r.n for r in filings.groupBy(*by).agg(F.countDistinct("cik").alias("n")).collect()}
        assert sum(r.filing_count for r in got) == 200000 and sum(r.amendment_count for r in got) == 40000
        assert all(abs(r.distinct_cik_estimate - exact[r[0]]) <= gold.SKETCH_BOUND * exact[r[0]] for r in got)


def test_latest_rows_are_marked_in_the_pass_of_the_sequence(spark, tmp_root):
    """Marking them adds no shuffle or sort, and the latest view of the written sequence needs no window."""
    facts = B.facts_from_lineitem(B.table(spark, SF_SMALL, "lineitem"))
    seq = gold.with_standing(gold.fact_sequence(facts))
    plan = seq._jdf.queryExecution().sparkPlan().toString()
    physical = seq._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 3 and physical.count("Exchange hashpartitioning") == 1 and physical.count("Sort [") == 1
    seq.write.parquet(tmp_root)
    latest = gold.financials_current(facts, sequence=spark.read.parquet(tmp_root))
    physical = latest._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in physical
    plain = gold.financials_current(facts)
    assert latest.exceptAll(plain).isEmpty() and plain.exceptAll(latest).isEmpty() and plain.count() > 0
