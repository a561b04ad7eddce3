"""Operator outputs carry the contract's columns and types (schema drift, U4)."""

import pytest

from factlake import contracts as C
from factlake.operators import bronze, gold, silver
from factlake.operators.setops import schema_drift
from factlake.plans import bindings as B
from factlake.plans import landed_inputs as L
from factlake.sources import landing as src
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def outputs(spark):
    facts = B.facts_from_lineitem(B.table(spark, SF_SMALL, "lineitem"))
    comps = B.companies_from_customer(B.table(spark, SF_SMALL, "customer"))
    filings = silver.dedupe_filings(silver.type_filings(B.index_rows_from_events(B.table(spark, SF_SMALL, "events"))))
    ev = gold.restatement_events(facts, comps)
    dim = B.company_dimension_from_customer(B.table(spark, SF_SMALL, "customer"))
    root = L.land_index(spark, SF_SMALL)
    env = src.read_landing(spark, root, "filing_index")
    return {
        "gold.restatement_event": ev,
        "gold.financials_current": gold.financials_current(facts, comps),
        "gold.filing_activity_daily": gold.filing_activity_daily(filings),
        "gold.company_profile": gold.company_profile(dim, filings, ev),
        "bronze.filing_index_raw": bronze.filing_index_raw(env),
        "bronze.company_submissions_raw": bronze.company_submissions_raw(env),
        "bronze.company_concept_raw": bronze.company_concept_raw(env),
    }


@pytest.mark.parametrize("table", ["gold.restatement_event", "gold.financials_current", "gold.filing_activity_daily",
                                   "gold.company_profile", "bronze.filing_index_raw",
                                   "bronze.company_submissions_raw", "bronze.company_concept_raw"])
def test_output_matches_contract(outputs, table):
    assert schema_drift(outputs[table].schema, C.TABLES[table]) == []


def test_drift_is_reported(spark):
    df = spark.createDataFrame([(1, "x")], "cik int, extra string")
    issues = {d["column"]: d["issue"] for d in schema_drift(df.schema, C.TABLES["gold.filing_activity_daily"])}
    assert issues["extra"] == "undeclared" and issues["filed_date"] == "missing"
