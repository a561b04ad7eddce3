"""Bronze: unwrap landed envelopes into append-only raw tables.

Payload fields stay strings (typing is silver's job).  Keys of the payload that
the declared schema does not know are rescued into ``_rescued_data`` as JSON
(types preserved through VARIANT) instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.operators.sequence import ordered_lag
from factlake.plans.bindings import generated_at


def rescued(payload_json: Column, known: tuple[str, ...]) -> Column:
    """JSON object of the payload's undeclared keys; NULL when there are none."""
    m = F.from_json(payload_json, "map<string,variant>")
    extra = F.map_filter(m, lambda k, v: ~k.isin(*known))
    return F.when(F.size(extra) > 0, F.to_json(extra))


def _meta(ingest_ts: Column | None) -> list[Column]:
    return [F.col("batch_id").alias("_ingest_batch_id"),
            (ingest_ts if ingest_ts is not None else generated_at()).alias("_ingest_ts"),
            F.col("_source_file"),
            F.col("source_system").alias("_source_system"),
            F.col("envelope_version").alias("_envelope_version")]


def _head() -> list[Column]:
    return [F.to_date("logical_date").alias("logical_date"), F.col("resource_id"),
            F.to_timestamp("fetched_at").alias("fetched_at")]


def filing_index_raw(envelopes: DataFrame, ingest_ts: Column | None = None, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    known = tuple(f.name for f in C.INDEX_PAYLOAD.fields)
    p = F.from_json("payload_json", C.INDEX_PAYLOAD)
    e = envelopes.withColumn("_p", p)
    return e.select(*_head(), *[F.col(f"_p.{c}").alias(c) for c in
                                ("form_type", "company_name", "cik", "date_filed", "accession_number", "file_name")],
                    *_meta(ingest_ts), rescued(F.col("payload_json"), known).alias("_rescued_data"), *keep)


def company_submissions_raw(envelopes: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    return envelopes.select(*_head(), F.col("resource_id").alias("cik"), "payload_json", *_meta(ingest_ts),
                            F.lit(None).cast("string").alias("_rescued_data"))


def company_concept_raw(envelopes: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    parts = F.split("resource_id", "/")
    return envelopes.select(*_head(), F.element_at(parts, 1).alias("cik"), F.lit(C.TAXONOMY).alias("taxonomy"),
                            F.element_at(parts, 2).alias("tag"), "payload_json", *_meta(ingest_ts),
                            F.lit(None).cast("string").alias("_rescued_data"))


def _file_key(path: Column) -> Column:
    """``logical_date=<date>/<file>`` of a landed file, however its root is spelled."""
    return F.regexp_extract(F.replace(path, F.lit("%3D"), F.lit("=")), "([^/]+/[^/]+)$", 1)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def refresh_dates(incoming: DataFrame, files: DataFrame, table_path: str, beside: dict[str, DataFrame] | None = None) -> int:
    """Bring the bronze table (partitioned by ``logical_date``) up to the landed files; returns rows added.

    A landing date is replaced as a whole, so bronze replaces it too: ``files`` (a ``path`` a landed
    file, see ``landed_files``) is anti-joined with the files of the table, the dates that hold one bronze has
    not seen are read, and just their partitions are overwritten.  The driver gets dates, never file names.  Landing the same batch again therefore adds nothing, changed content replaces the
    old, and an emptied date empties its partition.  Other dates are neither read nor written.
    ``beside`` maps paths to companion tables (bad lines) that are replaced for the same dates.
    """
    spark = incoming.sparkSession
    landed = files.select(_file_key(F.col("path")).alias("file"))
    if path_exists(spark, table_path):  # one name per landed file
        seen = spark.read.schema(incoming.schema).parquet(table_path).select("_source_file").distinct()
        landed = landed.join(seen.select(_file_key(F.col("_source_file")).alias("file")), "file", "left_anti")
    date = F.regexp_extract("file", "^logical_date=([^/]+)/", 1)
    dates = sorted(r[0] for r in landed.select(date).distinct().collect())
    if not dates:
        return 0
    for path, rows in (beside or {}).items():
        _replace_dates(rows, path, dates)
    return _replace_dates(incoming, table_path, dates)


def _replace_dates(rows: DataFrame, path: str, dates: list[str]) -> int:
    """Overwrite the partitions of ``dates`` with the rows of these dates; returns the rows gained."""
    spark = rows.sparkSession
    of_dates = F.col("logical_date").isin(*[F.lit(d).cast("date") for d in dates])
    count = lambda df: {r[0]: r[1] for r in df.where(of_dates).groupBy("logical_date").count().collect()}
    before = count(spark.read.schema(rows.schema).parquet(path)) if path_exists(spark, path) else {}
    (rows.where(of_dates).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("logical_date").parquet(path))
    after = count(rows)
    for d in set(before) - set(after):
        rows.drop("logical_date").limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/logical_date={d}")
    return sum(after.values()) - sum(before.values())


def dedupe_captures(bronze: DataFrame) -> DataFrame:
    """One row per (resource_id, content_sha256): identical re-landings collapse to the
    first capture, ties by file (the count tells how many there were), while different contents of one resource (co-registrants,
    revisions) are all kept.  Aggregation with partial combine, so skew-safe."""
    rest = [c for c in bronze.columns if c not in ("resource_id", "content_sha256")]
    return (bronze.groupBy("resource_id", "content_sha256")
            .agg(F.min_by(F.struct(*rest), F.struct("logical_date", "fetched_at", *[c for c in ("_source_file",) if c in rest])).alias("_r"),
                 F.count(F.lit(1)).alias("captures"))
            .select("resource_id", "content_sha256", "_r.*", "captures"))


def content_changes(captures: DataFrame) -> DataFrame:
    """Per resource and capture date: the previous capture's hash and whether the content changed."""
    c = captures.select("resource_id", "logical_date", "content_sha256")
    s = ordered_lag(c, ["resource_id"], ["logical_date", "content_sha256"], ["content_sha256"])
    return s.select("resource_id", "logical_date", "content_sha256",
                    F.col("prev_content_sha256").alias("previous_sha256"),
                    (F.col("prev_content_sha256").isNotNull()
                     & (F.col("prev_content_sha256") != F.col("content_sha256"))).alias("changed"))
