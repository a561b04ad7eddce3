"""A keyed table in hash buckets whose merges rewrite only what changed.

Parquet has no MERGE, and rewriting a whole snapshot for a small batch costs the table, not the batch.
Here rows live under ``data/v=<version>/key_bucket=<b>`` and a manifest ``manifest/v=<version>`` points
every bucket at the version that last wrote it.  A merge reads and rewrites the buckets its batch
touches, writes them under its own version and then commits a manifest in which only these pointers
moved: all other buckets keep their files, byte for byte and name for name.  Readers follow the
newest committed manifest (versions are numbers; modification times play no part), so a merge that dies before
its manifest changes nothing, and a replayed version starts from the manifest before it and
replaces itself.

What the driver holds is a version for each bucket, bounded by the number of buckets, which is a
parameter to be chosen so that a bucket is a task's worth of rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from factlake.operators.merge import latest_per_key, merge_upsert
from factlake.session import scratch_dir

BUCKETS = 64
BUCKET = "key_bucket"


@dataclass(frozen=True)
class BucketTable:
    """A bucketed table at ``root``; ``key`` decides a row's bucket."""

    spark: SparkSession
    root: str
    schema: StructType
    key: tuple[str, ...]
    n_buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.n_buckets)).cast("int")

    # -- manifests -----------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _numbers(self, folder: str) -> list[int]:
        fs, path = self._fs(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[2:]) for n in names if re.fullmatch(r"v=\d+", n))

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v in self._numbers("manifest") if self._exists(f"manifest/v={v}/_SUCCESS")]

    def _exists(self, name: str) -> bool:
        fs, path = self._fs(f"{self.root}/{name}")
        return fs.exists(path)

    def pointers(self, before: int | None = None) -> dict[int, int]:
        """Bucket -> version that last wrote it, in the newest manifest (older than ``before``)."""
        done = [v for v in self.versions() if before is None or v < before]
        if not done:
            return {}
        rows = self.spark.read.schema("bucket int, version long").parquet(f"{self.root}/manifest/v={done[-1]}").collect()
        return {r.bucket: r.version for r in rows}

    # -- data ----------------------------------------------------------------------------

    def read(self, pointers: dict[int, int] | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The rows of all buckets (of ``only`` these); None if there are none yet."""
        pointers = self.pointers() if pointers is None else pointers
        paths = [f"{self.root}/data/v={v}/{BUCKET}={b}" for b, v in sorted(pointers.items()) if only is None or b in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else None

    def staged(self, batch: DataFrame) -> tuple[DataFrame, list[int]]:
        """``batch`` written once, and the buckets it touches."""
        path = scratch_dir(self.spark, "bucket-batch")
        batch.withColumn(BUCKET, self.bucket()).write.parquet(path)
        held = self.spark.read.parquet(path)
        return held.drop(BUCKET), sorted(r[0] for r in held.select(BUCKET).distinct().collect())

    def commit(self, rows: DataFrame, touched: list[int], version: int, pointers: dict[int, int]) -> None:
        """Write ``rows`` (all rows of the touched buckets) as ``version`` and point these buckets at it."""
        if touched:
            out = rows.select(*self.schema.names).withColumn(BUCKET, self.bucket())
            (out.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(BUCKET).parquet(f"{self.root}/data/v={version}"))
        moved = pointers | dict.fromkeys(touched, version)
        manifest = self.spark.createDataFrame(sorted(moved.items()), "bucket int, version long")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")

    def retire(self, keep: int = 2) -> int:
        """Delete manifests but the newest ``keep``, and the buckets that none of these points at; returns the number of buckets deleted."""
        done = self.versions()
        kept, old = done[-keep:], done[:-keep]
        if not old:
            return 0
        live = {(v, b) for m in kept for b, v in self.pointers(before=m + 1).items()}
        gone = 0
        for v in self._numbers("data"):
            if v > done[-1]:
                continue  # a merge under way
            fs, path = self._fs(f"{self.root}/data/v={v}")
            for s in fs.listStatus(path):
                name = s.getPath().getName()
                if name.startswith(BUCKET + "=") and (v, int(name.split("=")[1])) not in live:
                    fs.delete(s.getPath(), True)
                    gone += 1
        for v in old:
            fs, path = self._fs(f"{self.root}/manifest/v={v}")
            fs.delete(path, True)
        return gone


def keyed_table(spark: SparkSession, root: str, batch: DataFrame, key: list[str], attrs: list[str],
                order_col: str = "logical_date", n_buckets: int = BUCKETS) -> BucketTable:
    """The SCD-1 table that batches like ``batch`` are merged into."""
    fields = batch.select(*key, order_col, *attrs).schema.fields
    seen = [StructField(c, TimestampType()) for c in ("_first_seen_ts", "_last_seen_ts")]
    return BucketTable(spark, root.rstrip("/"), StructType([*[StructField(f.name, f.dataType) for f in fields], *seen]), tuple(key), n_buckets)


def merge_buckets(table: BucketTable, batch: DataFrame, attrs: list[str], batch_ts: str, version: int,
                  order_col: str = "logical_date", nullable_keys: tuple[str, ...] = ()) -> list[int]:
    """Merge ``batch`` (the rules of ``merge_upsert``) as ``version``; returns the buckets rewritten.

    The batch is reduced to one row per key before it is staged, so repeated keys cost one row."""
    key = list(table.key)
    latest = latest_per_key(batch.select(*key, order_col, *attrs), key, [order_col])
    staged, touched = table.staged(latest)
    pointers = table.pointers(before=version)
    merged = merge_upsert(table.read(pointers, touched), staged, key, attrs, batch_ts, order_col, nullable_keys)
    table.commit(merged, touched, version, pointers)
    return touched
