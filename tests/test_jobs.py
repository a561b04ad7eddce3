"""End to end: landed envelopes of all three streams through bronze, silver, gold and export."""

import gzip
import json

from pyspark.sql import functions as F

from factlake import contracts as C
from factlake import jobs
from factlake.functions import keys as K
from factlake.session import scratch_dir
from factlake.sinks import landing as sink
from factlake.sources import landing as src
from tests.test_gold import ASSETS_DOC, ORIGINAL, RESTATED
from tests.test_history import SUBMISSIONS


def land(spark, root, stream, rows):
    """rows: (resource_id, logical_date, payload dict)."""
    df = spark.createDataFrame([(r, d, json.dumps(p, sort_keys=True, separators=(",", ":"))) for r, d, p in rows],
                               "rid string, d string, payload string")
    env = src.build_envelope(df, stream, F.col("d"), F.col("rid"), F.lit("https://example.invalid/x"),
                             F.col("payload"), F.lit("2026-07-30T06:00:00.000000Z"))
    sink.write_stream(env, root, stream)


def index_row(acc, cik, form, date, name="Co"):
    return {"accession_number": acc, "cik": cik, "company_name": name, "date_filed": date.replace("-", ""),
            "file_name": f"edgar/data/{cik}/{acc}.txt", "form_type": form}


def test_landing_to_export(spark):
    landing, bronze_root = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze")
    silver_root, gold_root, serving = scratch_dir(spark, "silver"), scratch_dir(spark, "gold"), scratch_dir(spark, "v")
    land(spark, landing, "filing_index", [
        ("0000900002-26-000321", "2026-07-29", index_row("0000900002-26-000321", "1001", "10-K", "2026-07-29")),
        ("0000900002-26-000321", "2026-07-29", index_row("0000900002-26-000321", "1002", "10-K", "2026-07-29")),
        ("0004200017-26-000010", "2026-07-29", index_row("0004200017-26-000010", "4200017", "10-Q/A", "2026-07-29")),
        ("BAD", "2026-07-30", index_row("BAD", "4200017", "8-K", "2026-07-30")),
        ("0004200017-26-000011", "2026-07-30", index_row("0004200017-26-000011", "4200017", "8-K", "2026-07-30")),
    ])
    renamed = dict(SUBMISSIONS, name="Example Holdings Inc.")
    permuted = dict(SUBMISSIONS, tickers=list(reversed(SUBMISSIONS["tickers"])))
    other = dict(SUBMISSIONS, cik="0004200099", name="Other Corp")
    land(spark, landing, "company_submissions", [
        ("0004200017", "2026-07-28", SUBMISSIONS), ("0004200017", "2026-07-29", permuted),
        ("0004200017", "2026-07-30", renamed), ("0004200099", "2026-07-29", other)])
    land(spark, landing, "company_concept", [("0004200017/Assets", "2026-07-29", ASSETS_DOC)])

    added = jobs.bronze_job(spark, landing, bronze_root)
    assert added == {"filing_index": 5, "company_submissions": 4, "company_concept": 1}
    land(spark, landing, "company_concept", [("0004200017/Assets", "2026-07-29", ASSETS_DOC)])  # landed once more
    assert jobs.bronze_job(spark, landing, bronze_root) == {"filing_index": 0, "company_submissions": 0,
                                                            "company_concept": 0}

    sres = jobs.silver_job(spark, bronze_root, silver_root, "r1", "2026-07-30 07:00:00", "2026-07-30")
    filing = spark.read.parquet(sres.tables["filing"])
    assert filing.count() == 3  # shared accession kept once (lowest cik), bad accession quarantined
    assert filing.where(F.col("accession_number") == "0000900002-26-000321").first().cik == "0000001001"
    q = spark.read.parquet(f"{silver_root}/filing_quarantine").collect()
    assert [r._dq_check_name for r in q] == ["filing_accession_format"]
    for name in ("filing", "company", "financial_fact"):
        assert spark.read.parquet(sres.tables[name]).columns == [f.name for f in C.TABLES[f"silver.{name}"].fields]
    assert filing.where("_source_file is null or _ingest_batch_id is null").isEmpty()
    versions = spark.read.parquet(sres.tables["company"])
    first = versions.where("cik = '0004200017'").orderBy("valid_from").first()
    assert first.ein == "000000017" and first.former_names == ["Sample Goods Inc."] and first.entity_type == "operating"
    got = sorted((r.cik, r.company_name, str(r.valid_from), r.is_current) for r in versions.collect())
    assert got == [("0004200017", "Example Holdings Inc.", "2026-07-30", True),
                   ("0004200017", "Example Inc.", "2026-07-28", False),
                   ("0004200099", "Other Corp", "2026-07-29", True)]
    m = {(r.table_name, r.check_name): r.failed_count for r in sres.metrics.collect()}
    assert m[("silver.filing", "filing_accession_format")] == 1 and m[("silver.financial_fact", "fact_value_present")] == 0

    gres = jobs.gold_job(spark, sres.tables, gold_root, "r1")
    ev = spark.read.parquet(gres["restatement_event"]).collect()
    assert len(ev) == 1 and ev[0].delta_abs == RESTATED - ORIGINAL
    assert ev[0].company_name == "Example Holdings Inc." and ev[0].materiality_band == "material"
    prof = {r.cik: r for r in spark.read.parquet(gres["company_profile"]).collect()}
    assert prof["0004200017"].restatement_count == 1 and prof["0004200017"].filing_count == 2
    assert prof["0004200099"].filing_count == 0

    manifest = jobs.export_job(spark, gres, sres.tables["filing"], serving, "2026-07-30T07:00:00Z").first()
    assert manifest.gold_max_filed_date == "2026-07-30"
    assert manifest.row_counts == {"company_profile": 2, "filing_activity_daily": 3, "financials_current": 2,
                                   "restatement_event": 1}

    # the next day's document repeats every assertion; the same run twice leaves one set of metrics
    land(spark, landing, "company_concept", [("0004200017/Assets", "2026-07-30", ASSETS_DOC)])
    assert jobs.bronze_job(spark, landing, bronze_root)["company_concept"] == 1
    for _ in range(2):
        d2 = jobs.silver_job(spark, bronze_root, silver_root, "d2", "2026-07-30 09:00:00", "2026-07-30")
    f1, f2 = (spark.read.parquet(r.tables["financial_fact"]) for r in (sres, d2))
    assert f1.count() == f2.count() and {str(r[0]) for r in f2.select("logical_date").distinct().collect()} == {"2026-07-30"}
    assert f1.select("_first_seen_ts").distinct().collect() == f2.select("_first_seen_ts").distinct().collect()
    assert d2.metrics.count() == len(m)

    # a second run over the same landing files: same silver rows, first-seen times kept
    s2 = jobs.silver_job(spark, bronze_root, silver_root, "r2", "2026-07-31 07:00:00", "2026-07-31")
    a = spark.read.parquet(sres.tables["filing"]).select("accession_number", "_first_seen_ts")
    b = spark.read.parquet(s2.tables["filing"]).select("accession_number", "_first_seen_ts")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert K is not None


def test_unreadable_lines_are_kept_aside(spark):
    landing, bronze_root = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze")
    land(spark, landing, "filing_index", [
        ("0000900002-26-000001", "2026-07-29", index_row("0000900002-26-000001", "1001", "10-K", "2026-07-29"))])
    good = spark.read.text(f"{landing}/edgar/filing_index").select("value").first()[0]
    broken = [(good[:40],), (good.replace('"http_status":200', '"http_status":"x"'),), ("",)]
    spark.createDataFrame(broken, "value string").write.mode("append").text(f"{landing}/edgar/filing_index/logical_date=2026-07-29")
    assert jobs.bronze_job(spark, landing, bronze_root)["filing_index"] == 1
    bad = spark.read.parquet(f"{bronze_root}/_bad_lines/filing_index").collect()
    assert sorted((r.invalid_reason, r.line) for r in bad) == sorted(
        zip(("unparseable", "http_status_not_int", "unparseable"), [b[0] for b in broken]))
    land(spark, landing, "filing_index", [
        ("0000900002-26-000001", "2026-07-29", index_row("0000900002-26-000001", "1001", "10-K", "2026-07-29"))])
    assert jobs.bronze_job(spark, landing, bronze_root)["filing_index"] == 0
    assert spark.read.parquet(f"{bronze_root}/filing_index_raw").count() == 1
    assert jobs.bronze_job(spark, landing, bronze_root)["filing_index"] == 0


def test_two_captures_of_a_day_give_one_version(spark):
    from factlake.operators.merge import scd2_history
    rows = [("c", "2026-01-01", "09", "A", "e1"), ("c", "2026-01-01", "12", "B", "e2"), ("c", "2026-01-02", "08", "B", "e3")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "cik string, d string, at string, name string, ein string") \
            .withColumn("logical_date", F.to_date("d"))
        got = scd2_history(df, "cik", ["name"], within_day=("at",), carry=("ein",)).collect()
        assert [(r.name, r.ein, str(r.valid_from), r.is_current) for r in got] == [("B", "e2", "2026-01-01", True)]


def test_landed_files_list_names_not_contents(spark, tmp_path):
    folder = tmp_path / "edgar" / "filing_index" / "logical_date=2024-01-02"
    folder.mkdir(parents=True)
    (folder / "part-0.json.gz").write_bytes(gzip.compress(b"{}\n"))
    (folder / "part-1.json.gz").write_bytes(gzip.compress(b""))  # an emptied batch
    files = src.landed_files(spark, str(tmp_path), "filing_index")
    assert [r.path.split("/")[-1] for r in files.orderBy("path").collect()] == ["part-0.json.gz", "part-1.json.gz"]
    assert "content" not in files._jdf.queryExecution().optimizedPlan().output().mkString()
