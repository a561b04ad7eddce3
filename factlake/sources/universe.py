"""Company universe files: a JSON list of objects with ``cik`` or of bare values.

Values may be numbers or strings, padded or not; the result is padded,
distinct and ascending, optionally limited to the first N.  A document that is
not a list is an error, as is a missing file (Spark raises on read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.functions import keys as K


class UniverseFormatError(ValueError):
    pass


def read_universe(spark: SparkSession, path: str, limit: int | None = None, check: bool = True) -> DataFrame:
    docs = spark.read.text(path, wholetext=True)
    arr = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    d = docs.select(arr.alias("a"))
    if check:
        bad = d.where(F.col("a").isNull()).limit(1).collect()
        if bad:
            raise UniverseFormatError("universe document is not a JSON list")
    v = d.select(F.explode("a").alias("v"))
    cik = F.coalesce(F.try_variant_get("v", "$.cik", "string"), F.try_variant_get("v", "$", "string"))
    u = v.select(K.pad_cik(cik).alias("cik")).where(F.col("cik").isNotNull() & (F.col("cik") != "")).distinct()
    return u.orderBy("cik").limit(limit) if limit is not None else u
