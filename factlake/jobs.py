"""End-to-end jobs over landed files: landing -> bronze -> silver -> gold -> export.

Each job reads what the previous one wrote (tables in shared storage), so any
job can be re-run alone, and a lost executor only re-runs its own job's tasks.
Silver and gold are written as new snapshots (``v=<run_id>``) and never
overwrite a path that is being read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.operators import bronze, dq, gold, silver
from factlake.operators.merge import merge_upsert, scd2_history
from factlake.plans import export as X
from factlake.session import scratch_dir
from factlake.sources.landing import landed_files, read_checked
from factlake.streaming.ingest import latest_snapshot

BRONZE_TABLES = {
    "filing_index": ("filing_index_raw", bronze.filing_index_raw),
    "company_submissions": ("company_submissions_raw", bronze.company_submissions_raw),
    "company_concept": ("company_concept_raw", bronze.company_concept_raw),
}
COMPANY_TRACKED = ["company_name", "sic", "sic_description", "state_of_incorporation", "fiscal_year_end",
                   "tickers", "exchanges"]
COMPANY_ARRAYS = ("tickers", "exchanges")
COMPANY_CARRIED = ("ein", "entity_type", "former_names", *silver.PROVENANCE)


def _attributes(table: str, key: tuple[str, ...]) -> list[str]:
    """The contract's columns that a merge takes from the batch."""
    own = (*key, "logical_date", "_first_seen_ts", "_last_seen_ts")
    return [f.name for f in C.TABLES[table].fields if f.name not in own]


def bronze_job(spark: SparkSession, landing_root: str, bronze_root: str,
               streams: tuple[str, ...] = C.STREAMS) -> dict[str, int]:
    """Bring each stream's bronze table up to the landed files; returns the rows each gained.

    Lines that break the envelope contract go to ``_bad_lines/{stream}`` with text, file and reason."""
    added = {}
    for stream in streams:
        if not bronze.path_exists(spark, f"{landing_root.rstrip('/')}/edgar/{stream}"):
            added[stream] = 0
            continue
        table, unwrap = BRONZE_TABLES[stream]
        path = f"{bronze_root.rstrip('/')}/{table}"
        good, bad = read_checked(spark, landing_root, stream)
        new = unwrap(good)
        new = new.withColumn("content_sha256", F.sha2(F.coalesce("payload_json", F.lit("")), 256)) \
            if "payload_json" in new.columns else new
        added[stream] = bronze.refresh_dates(
            new, landed_files(spark, landing_root, stream), path, beside={f"{bronze_root.rstrip('/')}/_bad_lines/{stream}": bad})
    return added


@dataclass
class SilverResult:
    tables: dict[str, str] = field(default_factory=dict)
    metrics: DataFrame | None = None


def silver_job(spark: SparkSession, bronze_root: str, silver_root: str, run_id: str, run_ts: str,
               as_of_date: str) -> SilverResult:
    """Typed, checked silver tables; rejected rows go to quarantine, batch checks gate the run."""
    b = bronze_root.rstrip("/")
    s = silver_root.rstrip("/")
    res = SilverResult()
    metrics = []

    def checked(rows: DataFrame, table: str) -> DataFrame:
        """Typed rows with their check results, written once; quarantine and metrics follow from them."""
        path = scratch_dir(spark, f"checked-{table}")
        dq.evaluate(rows, table, as_of_date).write.parquet(path)
        ev = spark.read.parquet(path)
        dq.quarantine(ev, table, run_id=run_id).write.mode("overwrite").parquet(f"{s}/{table}_quarantine/v={run_id}")
        metrics.append(dq.metrics(ev, table, as_of_date, run_id, extra={
            f"{table}_rescued_data": ("warn", F.col("_rescued_data").isNotNull())}))
        return dq.split(ev)[0]

    def save(df: DataFrame, table: str) -> None:
        res.tables[table] = f"{s}/{table}/v={run_id}"
        silver.conform(df, f"silver.{table}").write.mode("overwrite").parquet(res.tables[table])

    # filing: typed, checked, merged on accession into a new snapshot
    good = checked(silver.type_filings(spark.read.parquet(f"{b}/filing_index_raw")), "filing")
    target = latest_snapshot(spark, f"{s}/filing", exclude=run_id)
    save(merge_upsert(target, silver.dedupe_filings(good.drop("dq_failed", "dq_status", "_rescued_data")), ["accession_number"],
                      _attributes("silver.filing", ("accession_number",)), run_ts), "filing")

    # company: SCD-2 versions from every captured submissions document
    good = checked(silver.company_from_submissions(spark.read.parquet(f"{b}/company_submissions_raw")), "company")
    versions = scd2_history(good, "cik", COMPANY_TRACKED, arrays=COMPANY_ARRAYS, within_day=("fetched_at",), carry=COMPANY_CARRIED)
    dq.gate(dq.current_version_violations(versions), "company_one_current_per_cik")
    save(versions, "company")

    # financial_fact: concept documents exploded, checked, grain-gated per capture (each daily document
    # repeats earlier assertions), then merged on the grain
    good = checked(silver.facts_from_concepts(spark.read.parquet(f"{b}/company_concept_raw")), "financial_fact")
    dq.gate(dq.grain_violations(good, [*C.FACT_GRAIN, "logical_date"]), "fact_grain_unique")
    known = latest_snapshot(spark, f"{s}/financial_fact", exclude=run_id)
    save(merge_upsert(known, good, list(C.FACT_GRAIN), _attributes("silver.financial_fact", C.FACT_GRAIN), run_ts,
                      nullable_keys=("period_start",)), "financial_fact")

    m = metrics[0]
    for x in metrics[1:]:
        m = m.unionByName(x)
    m.write.mode("overwrite").parquet(f"{s}/_dq_metrics/v={run_id}")
    res.metrics = spark.read.parquet(f"{s}/_dq_metrics/v={run_id}")
    return res


def gold_job(spark: SparkSession, silver_tables: dict[str, str], gold_root: str, run_id: str) -> dict[str, str]:
    """The four marts from one silver snapshot; the fact sequence is computed once per run."""
    g = gold_root.rstrip("/")
    facts = spark.read.parquet(silver_tables["financial_fact"])
    filings = spark.read.parquet(silver_tables["filing"])
    versions = spark.read.parquet(silver_tables["company"])
    current = versions.where("is_current")
    names = current.select("cik", "company_name")
    out = {n: f"{g}/{n}/v={run_id}" for n in C.GOLD_TABLES}
    seq = gold.fact_sequence(facts)
    seq.write.mode("overwrite").parquet(f"{g}/_sequence/v={run_id}")  # cut lineage: read by two marts
    seq = spark.read.parquet(f"{g}/_sequence/v={run_id}")
    gold.restatement_events(facts, names, sequence=seq, run_id=run_id).write.mode("overwrite") \
        .parquet(out["restatement_event"])
    gold.financials_current(facts, names, sequence=seq, run_id=run_id).write.mode("overwrite") \
        .parquet(out["financials_current"])
    gold.filing_activity_daily(filings, run_id=run_id).write.mode("overwrite").parquet(out["filing_activity_daily"])
    dim = current.select("cik", "company_name", "sic", "sic_description", "entity_type", "state_of_incorporation",
                         "fiscal_year_end", "tickers", "exchanges")
    events = spark.read.parquet(out["restatement_event"])
    gold.company_profile(dim, filings, events, run_id=run_id).write.mode("overwrite").parquet(out["company_profile"])
    return out


def export_job(spark: SparkSession, gold_tables: dict[str, str], silver_filing: str, serving_root: str,
               generated_at: str) -> DataFrame:
    """Serving copy ``v1/{table}/`` plus ``v1/_manifest``, published only if the manifest invariant holds."""
    filings = spark.read.parquet(silver_filing)
    tables = {n: spark.read.parquet(p) for n, p in gold_tables.items()}
    return X.publish(spark, tables, serving_root, generated_at, filings.agg(F.max("filed_date")).first()[0])
