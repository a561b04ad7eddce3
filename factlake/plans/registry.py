"""Registry of named queries over the driver's tables, with their DuckDB oracle SQL.

Every query reads the given tables (or what Spark derives from them), so its
work grows with them.  Results are normalised at the boundary to types both
engines render the same way: DECIMAL and FLOAT -> DOUBLE, INT -> BIGINT,
TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock), ARRAY<STRING> -> comma-joined STRING.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def boundary(df: DataFrame) -> DataFrame:
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC")
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            # instants are rendered as their UTC wall clock, whatever the session zone
            c = F.convert_timezone(F.lit(tz), F.lit("UTC"), c.cast("timestamp_ntz"))
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``; ``sql`` is its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return boundary(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from factlake.plans import (  # noqa: F401
        gold_queries,
        silver_queries,
        quality_queries,
        history_queries,
        request_queries,
        source_queries,
        landing_queries,
        stream_queries,
        export_queries,
    )
