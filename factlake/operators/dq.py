"""Data-quality checks from the registry: evaluate, quarantine, metrics, batch gates.

Row checks are evaluated in one projection (an array of failed check names per
row, NULL counted as failure).  Batch checks (grain uniqueness, one current
version) are aggregations with partial combine, not unbounded windows.
Metrics come from one aggregate pass and are emitted for every check, also
when nothing failed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.plans.bindings import AS_OF_DATE, RUN_ID, generated_at

ROW_SEVERITIES = ("reject", "warn")


def checks(table: str, severities=ROW_SEVERITIES) -> list[tuple[str, str, str, str]]:
    return [(name, sev, expr, prevents) for t, name, sev, expr, prevents in C.DQ_CHECKS
            if t == table and sev in severities]


def good_expr(expr: str, as_of_date: str = AS_OF_DATE) -> Column:
    """True when the row passes; NULL (unknown) counts as a failure."""
    return F.coalesce(F.expr(expr.replace("{as_of_date}", f"DATE'{as_of_date}'")), F.lit(False))


def evaluate(df: DataFrame, table: str, as_of_date: str = AS_OF_DATE) -> DataFrame:
    """Add ``dq_failed`` (names of failed row checks, registry order) and ``dq_status``
    (reject > warn > pass)."""
    cs = checks(table)
    bad = {n: ~good_expr(e, as_of_date) for n, _, e, _ in cs}
    # Plain expressions (no lambdas) so the whole check set stays in generated code.
    failed = F.array_compact(F.array(*[F.when(bad[n], F.lit(n)) for n, _, _, _ in cs]))
    any_of = lambda names: reduce(lambda a, b: a | b, [bad[n] for n in names], F.lit(False))
    status = (F.when(any_of([n for n, s, _, _ in cs if s == "reject"]), F.lit("reject"))
              .when(any_of([n for n, s, _, _ in cs if s != "reject"]), F.lit("warn"))
              .otherwise(F.lit("pass")))
    return df.select("*", failed.alias("dq_failed"), status.alias("dq_status"))


def split(evaluated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows); good + rejected = input."""
    return (evaluated.where(F.col("dq_status") != "reject"),
            evaluated.where(F.col("dq_status") == "reject"))


def quarantine(evaluated: DataFrame, table: str, record_cols: list[str] | None = None,
               run_id: str = RUN_ID) -> DataFrame:
    """One quarantine row per (rejected record, failed reject check), generic shape."""
    cs = checks(table, ("reject",))
    reasons = F.create_map(*[x for n, _, _, p in cs for x in (F.lit(n), F.lit(p))])
    cols = record_cols or [c for c in evaluated.columns
                           if c not in ("dq_failed", "dq_status") and not c.startswith("_")]
    rec = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    rej = evaluated.where(F.col("dq_status") == "reject").select(
        rec.alias("record_json"),
        F.col("_source_file") if "_source_file" in evaluated.columns else F.lit(None).cast("string").alias("_source_file"),
        F.col("_ingest_batch_id") if "_ingest_batch_id" in evaluated.columns
        else F.lit(None).cast("string").alias("_ingest_batch_id"),
        F.explode("dq_failed").alias("_dq_check_name"))
    rej = rej.where(F.col("_dq_check_name").isin(*[n for n, _, _, _ in cs]))
    return rej.select(
        F.sha2("record_json", 256).alias("_dq_record_id"),
        F.lit(run_id).alias("_dq_run_id"),
        "_dq_check_name",
        F.try_element_at(reasons, F.col("_dq_check_name")).alias("_dq_failure_reason"),
        generated_at().alias("_quarantined_at"),
        F.lit(f"silver.{table}").alias("_source_table"),
        "_source_file", "_ingest_batch_id", "record_json")


def metrics(df: DataFrame, table: str, as_of_date: str = AS_OF_DATE, run_id: str = RUN_ID,
            extra: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """Evaluated and failed counts per row check in one aggregate pass, zero rows included.

    ``extra`` adds named warn metrics (e.g. non-null ``_rescued_data``) as
    {name: (severity, failure-condition)}.
    """
    cs = [(n, s, ~good_expr(e, as_of_date)) for n, s, e, _ in checks(table)]
    for n, (s, bad) in (extra or {}).items():
        cs.append((n, s, F.coalesce(bad, F.lit(False))))
    aggs = [F.count(F.lit(1)).alias("_evaluated")]
    aggs += [F.count_if(bad).alias(f"_f{i}") for i, (_, _, bad) in enumerate(cs)]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"),
                              F.col(f"_f{i}").alias("failed_count"))
                     for i, (n, s, _) in enumerate(cs)])
    return one.select(F.col("_evaluated").alias("evaluated_count"), F.inline(rows)).select(
        F.lit(f"silver.{table}").alias("table_name"), "check_name", "severity", "evaluated_count",
        "failed_count", F.lit(run_id).alias("run_id"))


def grain_violations(df: DataFrame, grain: list[str]) -> DataFrame:
    """Groups at the declared grain holding more than one row (reject_batch)."""
    return (df.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def grain_summary(df: DataFrame, grain: list[str]) -> DataFrame:
    """One row for the grain gate: groups, rows, duplicate groups and rows, verdict."""
    g = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("grain_groups"), F.sum("n").alias("row_count"),
                 F.count_if(F.col("n") > 1).alias("duplicate_groups"),
                 F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows")) \
        .withColumn("passed", F.col("duplicate_groups") == 0)


def current_version_violations(versions: DataFrame) -> DataFrame:
    """Keys whose number of current SCD-2 versions is not exactly one, and
    negative validity intervals (both reject_batch)."""
    return (versions.groupBy("cik").agg(
        F.count_if(F.col("is_current")).alias("current_count"),
        F.count_if(~F.coalesce(F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("valid_from")),
                               F.lit(False))).alias("bad_range_count"))
        .where((F.col("current_count") != 1) | (F.col("bad_range_count") > 0)))


class BatchRejected(Exception):
    pass


def gate(violations: DataFrame, check_name: str) -> None:
    """Fail the job when a reject_batch check finds any violating group."""
    hit = violations.limit(1).collect()
    if hit:
        raise BatchRejected(f"{check_name}: {hit[0].asDict()}")


def freshness(filings: DataFrame, now_ts: str, limit_hours: int = C.FRESHNESS_LIMIT_HOURS) -> DataFrame:
    """Serving health: stale when now - max(filed_date) exceeds the limit, to the second, or when nothing was filed."""
    mx = filings.agg(F.max("filed_date").alias("gold_max_filed_date"))
    age = F.expr(f"timestampdiff(HOUR, CAST(gold_max_filed_date AS TIMESTAMP), TIMESTAMP'{now_ts}')")
    return mx.select("gold_max_filed_date", age.cast("bigint").alias("age_hours"),
                     F.coalesce(F.expr(f"CAST(gold_max_filed_date AS TIMESTAMP) < TIMESTAMP'{now_ts}' - INTERVAL '{limit_hours}' HOUR"),
                                F.lit(True)).alias("is_stale"))
