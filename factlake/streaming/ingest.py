"""Incremental landing ingest with Structured Streaming.

``bronze_stream``: the landing root is a file source with the declared schema;
the checkpoint makes ingestion exactly-once per file path, so an unchanged
root adds nothing and new dates are picked up.  ``trigger(availableNow=True)``
drains what is there in bounded micro-batches and stops (a scheduled job).

``silver_merge_stream``: each micro-batch is merged (SCD-1 upsert) into the
bucketed silver table as version ``<epoch>``.  Only the buckets its keys fall into are
read and rewritten; a replayed epoch replaces itself (idempotent), and buckets that
the newest manifests no longer point at are retired.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factlake.operators import bronze, silver
from factlake.operators.buckets import BUCKETS, BucketTable, keyed_table, merge_buckets
from factlake.sources.landing import envelope_read_schema, CORRUPT


def landing_stream(spark: SparkSession, root: str, stream: str, max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(envelope_read_schema()).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT))
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    df = r.json(f"{root.rstrip('/')}/edgar/{stream}")
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


LANDED = ["resource_id", "content_sha256"]


def _keyed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its ``LANDED`` columns as keys that are never null, and their names; the hash leads, as
    it is told apart by its first bytes when rows are sorted."""
    keys = {f"_{c}": F.coalesce(c, F.lit("")) for c in LANDED[::-1]} | {f"_no_{c}": F.col(c).isNull() for c in LANDED}
    return df.withColumns(keys), list(keys)


def unseen(batch: DataFrame, seen: DataFrame | None) -> DataFrame:
    """One envelope per (resource_id, content hash) of ``batch`` that ``seen`` does not hold.

    However old an envelope is, it is dropped only if the same content is there already.  Of copies
    in one batch the earliest fetch stays (ties by file).  An unreadable line counts by its raw text.
    Window and join share their keys, so the envelopes are shuffled and sorted by them once."""
    batch, keys = _keyed(batch.withColumn("content_sha256", F.coalesce("content_sha256", F.sha2(CORRUPT, 256))))
    w = Window.partitionBy(*keys).orderBy("logical_date", "fetched_at", "_source_file")
    one = batch.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    if seen is not None:
        one = one.join(_keyed(seen)[0].select(*keys), keys, "left_anti")
    return one.drop(*keys)


def bronze_stream(spark: SparkSession, landing_root: str, table_path: str, checkpoint: str,
                  max_files: int | None = None, dedupe: bool = False) -> int:
    """Run once (availableNow) from the landing root into the bronze parquet table; returns rows read.

    With ``dedupe``, re-landed copies of an envelope add nothing: each micro-batch is anti-joined with the
    keys of all earlier ones (kept in ``<table>_landed/epoch=<id>``) and written to
    ``<table>/epoch=<id>``; a replayed epoch overwrites itself and ignores its own keys.
    """
    env = landing_stream(spark, landing_root, "filing_index", max_files)
    if dedupe:
        keys = f"{table_path.rstrip('/')}_landed"

        def append_new(batch: DataFrame, epoch: int) -> None:
            seen = _earlier(spark, keys, epoch)
            new = unseen(batch, seen)
            path = f"{table_path.rstrip('/')}/epoch={epoch}"
            bronze.filing_index_raw(new, keep=LANDED[1:]).write.mode("overwrite").parquet(path)
            spark.read.parquet(path).select(*LANDED).write.mode("overwrite").parquet(f"{keys}/epoch={epoch}")
        writer = env.writeStream.foreachBatch(append_new)
    else:
        writer = bronze.filing_index_raw(env).writeStream.format("parquet").option("path", table_path)
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(int(p.get("numInputRows", 0)) for p in q.recentProgress)


def _earlier(spark: SparkSession, keys: str, epoch: int) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(keys)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    schema = "resource_id string, content_sha256 string, epoch long"
    return spark.read.schema(schema).parquet(keys).where(F.col("epoch") < epoch).select(*LANDED)


KEY = ["accession_number"]
ATTRS = ["cik", "company_name", "form_type", "base_form_type", "is_amendment", "filed_date", "primary_doc_url"]


def latest_snapshot(spark: SparkSession, table_root: str, exclude: str | None = None) -> DataFrame | None:
    """The most recently committed ``v=<id>`` snapshot under ``table_root`` (None when empty),
    without ``exclude``: a run that is repeated must not read what it is about to replace.

    Only snapshots with a ``_SUCCESS`` marker count, so a half-written one is never read.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    done = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        marker = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
        if re.fullmatch(r"v=[^/]+", name) and name != f"v={exclude}" and fs.exists(marker):
            vid = name[2:]
            done.append((fs.getFileStatus(marker).getModificationTime(),
                          int(vid) if vid.isdigit() else -1, name))
    if not done:
        return None
    return spark.read.parquet(f"{table_root.rstrip('/')}/{max(done)[2]}")


def silver_merge_stream(spark: SparkSession, landing_root: str, table_root: str, checkpoint: str,
                        max_files: int | None = None, n_buckets: int = BUCKETS) -> BucketTable:
    """Landing -> typed filings -> bucketed silver table, one version per micro-batch that has rows."""
    src = bronze.filing_index_raw(landing_stream(spark, landing_root, "filing_index", max_files))
    typed = silver.type_filings(src)
    table = keyed_table(spark, table_root, typed, KEY, ATTRS, n_buckets=n_buckets)

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        ts = batch.agg(F.max("logical_date")).first()[0]
        if ts is None:
            return
        merge_buckets(table, batch, ATTRS, f"{ts} 00:00:00", epoch)
        table.retire()

    q = (typed.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table
