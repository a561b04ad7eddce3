"""SCD-2 history kept up to date by batches of captures, late ones included.

A version keeps the days it was sighted on, so captures can be put between them later: a late capture
that differs from the version around it splits it at its own day and at the next sighting, one
that equals a neighbour joins it, and one that repeats a day changes nothing.  Only the keys of a batch are
worked on, in the buckets of a ``BucketTable``; all other buckets keep their files.  The result does not
depend on the order or the cut of the batches and equals ``scd2_history`` over all captures.

A key has at most one capture a day (of several the one with the greatest tracked values counts, in
whatever batch it comes), so a key's sightings are bounded by the days of its life.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType

from factlake.functions import keys as K
from factlake.operators.buckets import BUCKETS, BucketTable


def history_table(spark: SparkSession, root: str, captures: DataFrame, key: str, tracked: list[str], n_buckets: int = BUCKETS) -> BucketTable:
    fields = [StructField(f.name, f.dataType) for f in captures.select(key, *tracked).schema.fields]
    own = [StructField("_hash_diff", StringType()), StructField("valid_from", DateType()), StructField("valid_to", DateType()),
           StructField("sightings", ArrayType(DateType()))]
    return BucketTable(spark, root.rstrip("/"), StructType([*fields, *own]), (key,), n_buckets)


def _by_day(captures: DataFrame, key: str, tracked: list[str], date_col: str) -> DataFrame:
    best = captures.where(F.col(key).isNotNull() & F.col(date_col).isNotNull()).groupBy(key, date_col).agg(F.max(F.struct(*tracked)).alias("t"))
    return best.select(key, date_col, "t.*")


def _versions(days: DataFrame, key: str, tracked: list[str], arrays: tuple[str, ...], date_col: str) -> DataFrame:
    """Runs of days with one hash: a version from its first day until the next version's."""
    w = Window.partitionBy(key).orderBy(date_col)
    s = days.withColumn("_hash_diff", K.hash_diff(*tracked, arrays=arrays))
    s = s.withColumn("_start", ~F.lag("_hash_diff").over(w).eqNullSafe(F.col("_hash_diff")))
    s = s.withColumn("valid_from", F.max(F.when(F.col("_start"), F.col(date_col))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    v = s.groupBy(key, "valid_from").agg(F.min_by(F.struct(*tracked, "_hash_diff"), date_col).alias("t"), F.sort_array(F.collect_list(date_col)).alias("sightings"))
    return v.select(key, "t.*", "valid_from", F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from")).alias("valid_to"), "sightings")


def scd2_apply(table: BucketTable, captures: DataFrame, tracked: list[str], version: int,
               arrays: tuple[str, ...] = (), date_col: str = "logical_date") -> list[int]:
    """Put a batch of captures into the history as ``version``; returns the buckets rewritten."""
    key = table.key[0]
    staged, touched = table.staged(_by_day(captures, key, tracked, date_col))
    pointers = table.pointers(before=version)
    old = table.read(pointers, touched)
    if old is None:
        rows = _versions(staged, key, tracked, arrays, date_col)
    else:
        keys = staged.select(key).distinct()
        past = old.join(keys, key, "left_semi").select(key, F.explode("sightings").alias(date_col), *tracked)
        days = _by_day(past.unionByName(staged), key, tracked, date_col)
        rows = old.join(keys, key, "left_anti").unionByName(_versions(days, key, tracked, arrays, date_col))
    table.commit(rows, touched, version, pointers)
    return touched


def history(table: BucketTable, tracked: list[str]) -> DataFrame | None:
    """The versions in the columns of ``scd2_history``."""
    v = table.read()
    return None if v is None else v.select(
        *table.key, *tracked, "_hash_diff", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
        K.utc_timestamp(F.col("valid_from")).alias("_first_seen_ts"), K.utc_timestamp(F.element_at("sightings", -1)).alias("_last_seen_ts"))
