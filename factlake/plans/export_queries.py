"""Export, contract-difference and replay-equivalence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.operators import gold, setops
from factlake.plans import export as X
from factlake.plans import gold_queries as G
from factlake.plans import landed_inputs as L
from factlake.plans import oracle as O
from factlake.plans.landing_queries import INDEX_ENV
from factlake.plans.registry import register
from factlake.session import scratch_dir
from factlake.sinks.landing import write_stream
from factlake.sources import landing as src

GEN = "2026-01-01T00:00:00Z"
COUNTS = dict(
    facts=O.FACTS, seq=O.FACT_SEQUENCE,
    index_rows=O.INDEX_ROWS, typed=O.SILVER_FILING,
    filings="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number
                 ORDER BY cik, logical_date, form_type) AS rn FROM typed) WHERE rn = 1""",
    n_fc="""SELECT count(*) AS n FROM (SELECT DISTINCT cik, concept_canonical, unit, period_start, period_end,
              period_type FROM seq)""",
    n_re=f"SELECT count(*) AS n FROM seq WHERE {O.IS_EVENT}",
    n_fa="SELECT count(*) AS n FROM (SELECT DISTINCT filed_date, base_form_type FROM filings)",
    n_cp="SELECT count(*) AS n FROM customer",
    mx="SELECT CAST(max(filed_date) AS VARCHAR) AS d FROM filings")

EXPORT_SQL = O.with_ctes(
    f"""SELECT '{GEN}' AS generated_at, '{C.CONTRACTS_VERSION}' AS contracts_version, mx.d AS gold_max_filed_date,
              n_cp.n AS company_profile_rows, n_fa.n AS filing_activity_daily_rows,
              n_fc.n AS financials_current_rows, n_re.n AS restatement_event_rows,
              CAST(to_json({{'generated_at': '{GEN}', 'contracts_version': '{C.CONTRACTS_VERSION}',
                 'gold_max_filed_date': mx.d,
                 'row_counts': MAP {{'company_profile': n_cp.n, 'filing_activity_daily': n_fa.n,
                                    'financials_current': n_fc.n, 'restatement_event': n_re.n}}}}) AS VARCHAR)
                AS manifest_json
       FROM mx, n_cp, n_fa, n_fc, n_re""", **COUNTS)


@register("export_manifest", EXPORT_SQL)
def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tables exported to v1/{table}/ and the manifest (row counts, max filed date, invariant checked)."""
    facts, comps = G.facts(spark, sf_dir), G.companies(spark, sf_dir)
    root = scratch_dir(spark, "serving")
    # silver.filing feeds three marts and the manifest: written once, read back.
    G.silver_filings(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/silver/filing")
    filings = spark.read.parquet(f"{root}/silver/filing")
    # One ordered pass over the facts feeds two marts, the latest rows marked in it: written once, read back.
    gold.with_standing(gold.fact_sequence(facts)).write.parquet(f"{root}/gold/sequence")
    seq = spark.read.parquet(f"{root}/gold/sequence")
    gold.restatement_events(facts, comps, sequence=seq).write.parquet(f"{root}/gold/events")
    events = spark.read.parquet(f"{root}/gold/events")
    dim = G.B.company_dimension_from_customer(G.B.table(spark, sf_dir, "customer"))
    tables = {"restatement_event": events, "financials_current": gold.financials_current(facts, comps, sequence=seq),
              "filing_activity_daily": gold.filing_activity_daily(filings), "company_profile": gold.company_profile(dim, filings, events)}
    m = X.publish(spark, tables, root, GEN, filings.agg(F.max("filed_date")).first()[0])
    rc = F.col("row_counts")
    return m.select("generated_at", "contracts_version", "gold_max_filed_date",
                    *[F.element_at(rc, n).alias(f"{n}_rows") for n in sorted(tables)], "manifest_json")


_FIELDS = list(C.ENVELOPE_FIELDS)
_KEYS_SQL = ("CASE WHEN event_type = 'purchase' AND value > 400 THEN CAST([] AS VARCHAR[]) "
             f"WHEN event_type = 'error' THEN {[f for f in _FIELDS if f != 'payload_json']} "
             f"WHEN event_type = 'signup' THEN {['_ingest_ts'] + _FIELDS} "
             f"ELSE {_FIELDS} END")
CONTRACT_SQL = O.with_ctes(
    f"""SELECT key, key IN {tuple(_FIELDS)} AS declared, CAST(sum(n) AS BIGINT) AS lines_with_key,
              (SELECT count(*) FROM env WHERE NOT (event_type = 'purchase' AND value > 400)) AS total_lines,
              CASE WHEN key NOT IN {tuple(_FIELDS)} THEN 'undeclared'
                   WHEN sum(n) < (SELECT count(*) FROM env WHERE NOT (event_type = 'purchase' AND value > 400))
                   THEN 'missing_in_some' ELSE 'ok' END AS status
       FROM (SELECT unnest({_KEYS_SQL}) AS key, CAST(1 AS BIGINT) AS n FROM env
             UNION ALL SELECT unnest({_FIELDS}) AS key, CAST(0 AS BIGINT) AS n)
       GROUP BY key""", **INDEX_ENV)


@register("contract_diff", CONTRACT_SQL)
def contract_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys written in landed envelope lines minus the declared envelope fields (and the reverse)."""
    return setops.key_diff(spark.read.text(L.write_envelope_lines(spark, sf_dir)), C.ENVELOPE_FIELDS)


REPLAY_SPLIT = "2024-01-16"
ADDED, LOST = "event_type = 'signup' AND value > 250", f"event_type = 'purchase' AND value > 250 AND logical_date >= '{REPLAY_SPLIT}'"
CHANGED, TWICE = "event_type = 'click' AND value > 250", "event_type = 'view' AND value > 250"
_SAME = [f for f in C.ENVELOPE_FIELDS if f not in ("fetched_at", "content_sha256", "payload_json")]
_B = f"""SELECT {', '.join(_SAME)}, CASE WHEN {CHANGED} THEN payload_json || ' ' ELSE payload_json END AS payload_json, event_type, value
         FROM env WHERE NOT ({LOST})"""
REPLAY_SQL = O.with_ctes(
    """SELECT logical_date, CAST(sum(na) AS BIGINT) AS rows_a, CAST(sum(nb) AS BIGINT) AS rows_b, CAST(sum(greatest(na - nb, 0)) AS BIGINT) AS only_a,
              CAST(sum(greatest(nb - na, 0)) AS BIGINT) AS only_b, sum(abs(na - nb)) = 0 AS equivalent FROM g GROUP BY logical_date""",
    **INDEX_ENV, b=_B,
    sides=f"""SELECT {', '.join(_SAME)}, payload_json, 1 AS in_a, 0 AS in_b FROM env WHERE NOT ({ADDED})
             UNION ALL SELECT {', '.join(_SAME)}, payload_json, 0, 1 FROM b
             UNION ALL SELECT {', '.join(_SAME)}, payload_json, 0, 1 FROM b WHERE {TWICE}""",
    g=f"SELECT {', '.join(_SAME)}, payload_json, sum(in_a) AS na, sum(in_b) AS nb FROM sides GROUP BY ALL")


@register("replay_diff", REPLAY_SQL)
def replay_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run and its replay in two waves, ignoring fetched_at: the replay lost purchases of the second wave, holds signups the
    run lacked, changed clicks and repeated views; dates without any of these are equal."""
    env = L.index_envelopes_with_extras(spark, sf_dir, keep=("event_type", "value"))
    run, again = scratch_dir(spark, "landing"), scratch_dir(spark, "landing")
    write_stream(env.where(f"NOT ({ADDED})"), run, "filing_index")
    payload = F.when(F.expr(CHANGED), F.concat("payload_json", F.lit(" "))).otherwise(F.col("payload_json"))
    other = env.where(f"NOT ({LOST})").withColumn("payload_json", payload).withColumn("content_sha256", F.sha2("payload_json", 256))
    other = other.unionByName(other.where(TWICE))
    for wave in (F.col("logical_date") < REPLAY_SPLIT, F.col("logical_date") >= REPLAY_SPLIT):
        write_stream(other.where(wave), again, "filing_index")
    a, b = (src.read_landing(spark, root, "filing_index").select(*C.ENVELOPE_FIELDS) for root in (run, again))
    return setops.replay_tree(a, b, "logical_date", ignore=("fetched_at",)).drop("leaves_compared")


_NAMES = ", ".join(f"'{f.name}'" for f in C.INDEX_PAYLOAD.fields)
DRIFT_SQL = O.with_ctes(
    """SELECT logical_date, path, declared_type, seen_type, n AS payloads, total, status FROM counted JOIN totals USING (logical_date) WHERE n > 0""",
    **INDEX_ENV,
    line="SELECT logical_date, event_type AS e, value > 100 AS high, e = 'signup' AND value > 200 AS cut FROM env",
    totals="SELECT logical_date, count(*) AS total FROM line GROUP BY 1",
    field=f"SELECT unnest([{_NAMES}]) AS path",
    shown="""SELECT logical_date, path, 'string' AS declared_type,
               CASE WHEN path = 'cik' AND e = 'click' AND high THEN 'BIGINT' WHEN path = 'company_name' AND e = 'purchase' AND high THEN 'VOID'
                    WHEN path = 'file_name' AND e = 'view' AND high THEN NULL ELSE 'STRING' END AS seen_type
             FROM line, field WHERE NOT cut
             UNION ALL SELECT logical_date, x.path, NULL, x.t FROM line,
               (VALUES ('props', 'OBJECT'), ('props.k', 'BIGINT'), ('severity', 'STRING')) AS x(path, t) WHERE e = 'error'
             UNION ALL SELECT logical_date, '$', NULL, 'UNPARSED' FROM line WHERE cut""",
    counted="""SELECT logical_date, path, declared_type, seen_type, count(*) AS n,
                 CASE WHEN path = '$' THEN 'unparsed' WHEN seen_type IS NULL THEN 'absent' WHEN declared_type IS NULL THEN 'undeclared'
                      WHEN seen_type = 'VOID' THEN 'null' WHEN seen_type = 'STRING' THEN 'ok' ELSE 'type' END AS status
               FROM shown GROUP BY ALL""")


@register("schema_drift", DRIFT_SQL)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths and types of landed payloads per date, against the declared payload struct: wrong types, absences, nulls, nested extras."""
    landed = spark.read.schema("logical_date string, payload_json string").json(L.write_drifting_payloads(spark, sf_dir))
    return setops.payload_drift(landed, C.INDEX_PAYLOAD, "logical_date")
