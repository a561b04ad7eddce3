"""Serving export: gold tables to ``v1/{table}/`` (overwrite, never append) and a manifest.

Row counts are read back from what was written (parquet footers, no scan);
the manifest is one small row assembled by a single aggregation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C


class ManifestInvariantError(AssertionError):
    pass


def export_tables(tables: dict[str, DataFrame], serving_root: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{serving_root.rstrip('/')}/v1/{name}")


def manifest(spark: SparkSession, serving_root: str, names: list[str], generated_at: str,
             dated: str = "filing_activity_daily") -> DataFrame:
    """Row counts of the exported tables, and the latest filed date that the exported ``dated`` holds."""
    parts = [spark.read.parquet(f"{serving_root.rstrip('/')}/v1/{n}")
             .agg(F.count(F.lit(1)).alias("n"), (F.max("filed_date") if n == dated else F.lit(None).cast("date")).alias("d"))
             .select(F.lit(n).alias("name"), "n", "d")
             for n in names]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    entries = F.array_sort(F.filter(F.collect_list(F.struct("name", "n")), lambda s: s["name"].isNotNull()))
    m = u.agg(F.map_from_entries(entries).alias("row_counts"), F.max("d").alias("gold_max_filed_date"))
    m = m.select(F.lit(generated_at).alias("generated_at"), F.lit(C.CONTRACTS_VERSION).alias("contracts_version"),
                 F.col("gold_max_filed_date").cast("string").alias("gold_max_filed_date"), "row_counts")
    return m.select("*", F.to_json(F.struct("generated_at", "contracts_version", "gold_max_filed_date",
                                            "row_counts")).alias("manifest_json"))


def check_fresh(m: DataFrame, silver_filed_max) -> None:
    """The exported tables must be as fresh as silver."""
    row = m.select("gold_max_filed_date").first()
    if silver_filed_max is not None and row["gold_max_filed_date"] != str(silver_filed_max):
        raise ManifestInvariantError(f"{row['gold_max_filed_date']} != {silver_filed_max}")


def write_manifest(m: DataFrame, serving_root: str, silver_filed_max) -> None:
    """Check that what was exported is as fresh as silver, then write ``v1/_manifest`` (one tiny JSON file)."""
    check_fresh(m, silver_filed_max)
    m.select("manifest_json").coalesce(1).write.mode("overwrite").text(f"{serving_root.rstrip('/')}/v1/_manifest")


def publish(spark: SparkSession, tables: dict[str, DataFrame], serving_root: str, generated_at: str, silver_filed_max) -> DataFrame:
    """Export in two steps: write everything aside, check it there, then move it into place, the manifest last.

    A stale export, or one that fails while it is written, leaves the published tables and manifest as
    they were.  Moving is a rename of each table's folder.  Returns the manifest.
    """
    root = serving_root.rstrip("/")
    aside = f"{root}/_staged-{uuid.uuid4().hex[:12]}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(aside).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        export_tables(tables, aside)
        m = manifest(spark, aside, sorted(tables), generated_at)
        m = spark.createDataFrame([m.first()], m.schema)  # one row: it outlives the staged folder
        check_fresh(m, silver_filed_max)
        fs.mkdirs(path(f"{root}/v1"))
        for name in tables:
            fs.delete(path(f"{root}/v1/{name}"), True)
            if not fs.rename(path(f"{aside}/v1/{name}"), path(f"{root}/v1/{name}")):
                raise OSError(f"{name} could not be moved into place")
    finally:
        fs.delete(path(aside), True)
    write_manifest(m, root, silver_filed_max)
    return m
