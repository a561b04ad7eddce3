"""Helpers shared by the operators: reading tables, row identity, scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: cuts the lineage
    without relying on executors' disks."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once and bound to ``v``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def give_back() -> None:
    """Return memory that this Python worker has freed: it stays alive after its task, beside the stages that follow."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def giving_back(run):
    """``run`` of a mapInArrow, after whose last batch the worker gives its free memory back."""
    def done(batches):
        yield from run(batches)
        give_back()
    return done


def ints(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]
