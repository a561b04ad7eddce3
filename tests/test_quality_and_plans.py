"""DQ split/metrics/gates, request planning, streaming ingest, export invariant."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake.operators import dq
from factlake.operators.setops import payload_drift
from factlake.plans import bindings as B
from factlake.plans import landed_inputs as L
from factlake.plans import requests as R
from factlake.session import scratch_dir
from factlake.sources.landing import read_landing
from factlake.streaming import ingest
from tests.conftest import SF_SMALL


def test_quarantine_loses_no_rows(spark):
    f = B.facts_with_defects(B.table(spark, SF_SMALL, "lineitem"))
    ev = dq.evaluate(f, "financial_fact")
    good, bad = dq.split(ev)
    assert good.count() + bad.count() == f.count()
    q = dq.quarantine(ev, "financial_fact")
    assert q.select("_dq_record_id").distinct().count() == bad.count()
    assert q.where(F.col("_dq_failure_reason").isNull()).count() == 0


def test_metrics_emit_zero_failures(spark):
    f = B.facts_from_lineitem(B.table(spark, SF_SMALL, "lineitem"))
    m = {r.check_name: r for r in dq.metrics(f, "financial_fact").collect()}
    assert len(m) == 7
    assert m["fact_value_magnitude"].failed_count == 0 and m["fact_value_magnitude"].evaluated_count == f.count()


def test_null_counts_as_failure(spark):
    df = spark.createDataFrame([(None, "x"), ("0000000001", "x")], "cik string, accession_number string")
    df = df.select("*", *[F.lit(v).alias(c) for c, v in [("unit", "USD"), ("value", 1), ("period_end", "2020-01-01")]],
                   F.lit(None).cast("date").alias("period_start"))
    got = [r.dq_failed for r in dq.evaluate(df, "financial_fact").orderBy("cik").collect()]
    assert "fact_cik_padded" in got[0]


def test_batch_gate_raises(spark):
    v = spark.createDataFrame([("1", True, None, "2024-01-01"), ("1", True, None, "2024-01-02")],
                              "cik string, is_current boolean, valid_to date, valid_from string")
    with pytest.raises(dq.BatchRejected):
        dq.gate(dq.current_version_violations(v), "company_one_current_per_cik")
    dq.gate(dq.current_version_violations(v.limit(1)), "company_one_current_per_cik")


def test_request_plan_and_resume_equals_straight_run(spark):
    u = R.universe(spark.createDataFrame([("1",), ("2",), ("1",)], "cik string"))
    done = spark.createDataFrame([("0000000001", "Revenues")], "cik string, concept string")
    plan = R.request_plan(u, done)
    assert plan.count() == 2 * 15 - 1
    straight = {(r.cik, r.concept) for r in R.request_plan(u).collect()}
    resumed = {(r.cik, r.concept) for r in plan.collect()} | {("0000000001", "Revenues")}
    assert straight == resumed
    s = R.plan_summary(u, done).first()
    assert (s.planned, s.completed, s.pending) == (30, 1, 29)
    assert [r.cik for r in R.universe(u, limit=1).collect()] == ["0000000001"]


def test_outcome_classes(spark):
    df = spark.createDataFrame([("filing_index", 404), ("company_concept", 404), ("company_submissions", 404),
                                ("x", 403), ("x", 429), ("x", 418), ("x", 200)], "s string, c int")
    got = [r.o for r in df.select(R.classify_outcome(F.col("s"), F.col("c")).alias("o")).collect()]
    assert got == ["no_filings", "not_reported", "failed", "forbidden_or_missing", "retryable", "unexpected", "ok"]


def test_stream_ingest_is_exactly_once_per_file(spark):
    root = L.land_index(spark, SF_SMALL, dates=(None, "2024-01-10"))
    table, ckpt = scratch_dir(spark, "t"), scratch_dir(spark, "c")
    n1 = ingest.bronze_stream(spark, root, table, ckpt)
    n2 = ingest.bronze_stream(spark, root, table, ckpt)
    L.land_index(spark, SF_SMALL, root=root, dates=("2024-01-10", None))
    n3 = ingest.bronze_stream(spark, root, table, ckpt)
    total = B.table(spark, SF_SMALL, "events").count()
    assert n1 > 0 and n2 == 0 and n1 + n3 == total
    assert spark.read.parquet(table).count() == total


def test_manifest_invariant(spark):
    from factlake.plans import export as X
    root = scratch_dir(spark, "serving")
    day = lambda d: spark.createDataFrame([(d,)], "d string").select(F.to_date("d").alias("filed_date"))
    X.export_tables({"filing_activity_daily": day("2024-01-02")}, root)
    m = X.manifest(spark, root, ["filing_activity_daily"], "2026-01-01T00:00:00Z")
    assert m.first().row_counts == {"filing_activity_daily": 1}
    silver = day("2024-01-03").agg(F.max("filed_date")).first()[0]
    with pytest.raises(X.ManifestInvariantError):  # the export is staler than silver
        X.write_manifest(m, root, silver)
    X.export_tables({"filing_activity_daily": day("2024-01-03")}, root)
    X.write_manifest(X.manifest(spark, root, ["filing_activity_daily"], "2026-01-01T00:00:00Z"), root, silver)


def test_a_stale_export_leaves_the_published_one(spark):
    import glob

    from factlake.plans import export as X
    from factlake.session import to_local_path
    root = scratch_dir(spark, "serving")
    day = lambda d: spark.createDataFrame([(d,)], "d string").select(F.to_date("d").alias("filed_date"))
    max_of = lambda d: day(d).agg(F.max("filed_date")).first()[0]
    publish = lambda have, silver, n: X.publish(spark, {"filing_activity_daily": day(have), "t": spark.range(n)}, root, "2026-01-01T00:00:00Z", max_of(silver))
    read = lambda: (spark.read.parquet(f"{root}/v1/t").count(), spark.read.text(f"{root}/v1/_manifest").first()[0])
    m = publish("2024-01-02", "2024-01-02", 3)
    before = read()
    assert before[0] == 3 and before[1] == m.first().manifest_json and m.first().row_counts == {"filing_activity_daily": 1, "t": 3}
    with pytest.raises(X.ManifestInvariantError):
        publish("2024-01-03", "2024-01-04", 9)
    assert read() == before
    publish("2024-01-04", "2024-01-04", 5)
    assert read()[0] == 5 and '"t":5' in read()[1]
    assert not glob.glob(to_local_path(root) + "/_staged-*")


def test_streaming_rate_audit_counts_everything(spark):
    from factlake.streaming.audit import LOG_SCHEMA, rate_audit_stream, rate_audit_table, rate_windows
    log = B.request_log_from_events(B.table(spark, SF_SMALL, "events"))
    log = log.select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA.fields])
    src_dir, out, ckpt = scratch_dir(spark, "log"), scratch_dir(spark, "audit"), scratch_dir(spark, "ck")
    days = sorted(r.d for r in log.select(F.to_date("requested_at").alias("d")).distinct().collect())
    for d in (days[2], days[0], days[1]):  # the latest day arrives first
        log.where(F.to_date("requested_at") == d).write.mode("append").parquet(src_dir)
        rate_audit_stream(spark, src_dir, out, ckpt)
    got, batch = rate_audit_table(spark, out), rate_windows(log.where(F.to_date("requested_at") <= days[2]))
    assert batch.count() > 0
    assert batch.exceptAll(got).count() == 0 and got.exceptAll(batch).count() == 0


def test_stream_dedupes_relanded_envelopes(spark):
    from factlake.sinks import landing as sink
    every = L.index_envelopes_with_extras(spark, SF_SMALL)
    env, old = every.where(F.col("logical_date") == "2024-01-20"), every.where(F.col("logical_date") == "2024-01-02")
    n = env.count()
    root = scratch_dir(spark, "land")
    table, ckpt = scratch_dir(spark, "t"), scratch_dir(spark, "c")
    sink.write_stream(env, root, "filing_index")
    assert ingest.bronze_stream(spark, root, table, ckpt, dedupe=True) == n
    sink.write_stream(env, root, "filing_index")  # the same batch landed again: new files, same content
    ingest.bronze_stream(spark, root, table, ckpt, dedupe=True)
    assert spark.read.parquet(table).count() == n
    sink.write_stream(old, root, "filing_index")  # much older, never seen
    ingest.bronze_stream(spark, root, table, ckpt, dedupe=True)
    assert spark.read.parquet(table).count() == n + old.count()
    # without de-duplication the same sequence appends the re-landed copy
    root2, plain_t, plain_c = scratch_dir(spark, "land"), scratch_dir(spark, "t"), scratch_dir(spark, "c")
    for _ in range(2):
        sink.write_stream(env, root2, "filing_index")
        ingest.bronze_stream(spark, root2, plain_t, plain_c)
    assert spark.read.parquet(plain_t).count() == 2 * n


def test_stream_dedupe_shuffles_its_envelopes_once(spark):
    schema = "resource_id string, content_sha256 string, logical_date string, fetched_at string, _source_file string, _corrupt_record string"
    rows = [("r1", "h1", "2024-01-02", "t", "f2", None), ("r1", "h1", "2024-01-01", "t", "f1", None), ("r2", "h1", "2024-01-01", "t", "f1", None),
            (None, "h1", "2024-01-01", "t", "f1", None), ("", "h1", "2024-01-01", "t", "f1", None), (None, None, "2024-01-01", "t", "f1", "{cut"),
            (None, None, "2024-01-01", "t", "f1", None), (None, None, "2024-01-03", "t", "f1", None)]
    batch = spark.createDataFrame(rows, schema)
    seen = spark.createDataFrame([("r2", "h1"), (None, "h1"), ("r9", "h9")], "resource_id string, content_sha256 string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = ingest.unseen(batch, seen)
        plan = new._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.resource_id or "", r.resource_id is None, r.content_sha256 or "", r.logical_date) for r in new.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2  # the batch once, the keys once
    cut = spark.sql("SELECT sha2('{cut', 256)").first()[0]
    assert got == sorted([("r1", False, "h1", "2024-01-01"), ("", False, "h1", "2024-01-01"), ("", True, cut, "2024-01-01"), ("", True, "", "2024-01-01")])
    assert new.columns == batch.columns


def test_landed_index_rows_are_dealt_before_their_envelopes_are_made(spark, monkeypatch):
    from factlake.sinks import landing as sink
    made = []
    monkeypatch.setattr(sink, "_sorted", lambda env, files, dealt=False, real=sink._sorted: made.append(real(env, files, dealt)) or made[-1])
    root = L.land_index(spark, SF_SMALL, dates=("2024-01-10", "2024-01-12"))
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "sha2" not in plan[plan.index("Exchange"):]
    env = L.index_envelopes_with_extras(spark, SF_SMALL).where("logical_date >= '2024-01-10' AND logical_date < '2024-01-12'")
    got = read_landing(spark, root, "filing_index").select(*env.columns).withColumn("logical_date", F.col("logical_date").cast("string"))
    assert env.count() > 0 and env.exceptAll(got).count() == 0 and got.exceptAll(env).count() == 0


def test_ties_do_not_depend_on_input_order(spark):
    from factlake.operators.merge import merge_upsert, scd2_history
    rows = [("k", "2024-01-01", "a"), ("k", "2024-01-01", "b")]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "k string, logical_date string, v string").coalesce(1)
        assert merge_upsert(None, df, ["k"], ["v"], "2024-01-02 00:00:00").first().v == "b"
        captures = df.withColumn("fetched_at", F.col("v")).withColumn("logical_date", F.to_date("logical_date"))
        versions = scd2_history(captures, "k", ["v"], within_day=("fetched_at",)).collect()
        assert [(x.v, x.is_current) for x in versions] == [("b", True)]


def test_fetch_accounting(spark):
    fetched = spark.createDataFrame([("1", "Assets", "e1"), ("1", "Revenues", None), ("2", "Assets", "e2")],
                                    "cik string, concept string, envelope string")
    r = R.fetch_accounting(fetched).first()
    assert (r.requests, r.records, r.not_reported) == (3, 2, 1)


def test_payload_drift_of_nested_payloads(spark):
    declared = T.StructType().add("id", "long").add("who", T.StructType().add("name", "string").add("age", "double")).add("tags", T.ArrayType(T.StringType()))
    rows = [("d1", '{"id": 1, "who": {"name": "x", "age": 2}, "tags": ["a", "b"]}'), ("d1", '{"id": "1", "who": {"name": "y", "age": 2.5, "z": {"deep": {"er": 1}}}, "tags": [1, "b"]}'),
            ("d1", '{"who": null, "tags": []}'), ("d1", "[1]"), ("d1", "{"), ("d1", None), ("d2", '{"id": 1, "who": {}, "tags": "t"}')]
    got = {(r.day, r.path, r.seen_type, r.payloads, r.total, r.status) for r in payload_drift(spark.createDataFrame(rows, "day string, payload_json string"), declared, "day").collect()}
    assert got == {
        ("d1", "id", "BIGINT", 1, 6, "ok"), ("d1", "id", "STRING", 1, 6, "type"), ("d1", "id", None, 1, 6, "absent"),
        ("d1", "who", "OBJECT", 2, 6, "ok"), ("d1", "who", "VOID", 1, 6, "null"), ("d1", "who.name", "STRING", 2, 6, "ok"),
        ("d1", "who.age", "BIGINT", 1, 6, "ok"), ("d1", "who.age", "DECIMAL", 1, 6, "ok"),
        ("d1", "who.z", "OBJECT", 1, 6, "undeclared"), ("d1", "who.z.deep", "OBJECT", 1, 6, "undeclared"),
        ("d1", "tags", "ARRAY", 3, 6, "ok"), ("d1", "tags[]", "STRING", 2, 6, "ok"), ("d1", "tags[]", "BIGINT", 1, 6, "type"),
        ("d1", "[]", "BIGINT", 1, 6, "undeclared"), ("d1", "$", "ARRAY", 1, 6, "unparsed"), ("d1", "$", "UNPARSED", 2, 6, "unparsed"),
        ("d2", "id", "BIGINT", 1, 1, "ok"), ("d2", "who", "OBJECT", 1, 1, "ok"), ("d2", "who.name", None, 1, 1, "absent"),
        ("d2", "who.age", None, 1, 1, "absent"), ("d2", "tags", "STRING", 1, 1, "type")}
    assert payload_drift(spark.createDataFrame([], "day string, payload_json string"), declared, "day").count() == 0


def test_payload_drift_reads_its_payloads_once_or_twice(spark, tmp_root):
    """One walk a schema, one more for payloads with arrays; the same counts however payloads share schemas."""
    rows = [("d1", f'{{"id": {i}, "who": {{"name": "n{i}"}}}}') for i in range(40)] + [("d1", '{"id": 1, "ARRAY<x": null}'), (None, '{"id": 1}')]
    rows += [("d1", f'{{"id": "{i}", "tags": [{i}, "b"]}}') for i in range(5)]
    declared = T.StructType().add("id", "long").add("who", T.StructType().add("name", "string"))
    spark.createDataFrame(rows, "day string, payload_json string").write.parquet(tmp_root)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    given = spark.read.parquet(tmp_root).mapInArrow(counted, "day string, payload_json string")
    got = {(r.path, r.seen_type, r.payloads, r.total, r.status) for r in payload_drift(given, declared, "day").collect()}
    assert got == {("id", "BIGINT", 41, 46, "ok"), ("id", "STRING", 5, 46, "type"), ("who", "OBJECT", 40, 46, "ok"), ("who", None, 6, 46, "absent"),
                   ("who.name", "STRING", 40, 46, "ok"), ("ARRAY<x", "VOID", 1, 46, "undeclared"), ("tags", "ARRAY", 5, 46, "undeclared"),
                   ("tags[]", "BIGINT", 5, 46, "undeclared"), ("tags[]", "STRING", 5, 46, "undeclared")}
    assert reads.value <= 2 * len(rows)
