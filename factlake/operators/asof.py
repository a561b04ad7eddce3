"""As-of (validity-interval) join of dated rows to an SCD-2 dimension, in one ordered pass.

Versions and rows are put into one stream, sorted by (key, date, versions before rows), and each row takes the last
version before it.  A version is one row however long it is open, there is no range condition and no
search, and a hot key is cut into pieces between which the last version is handed on
(``sequence.carry_last``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.operators.sequence import carry_last


def asof_join(rows: DataFrame, versions: DataFrame, key: str, date_col: str,
              how: str = "inner", version_cols: list[str] | None = None) -> DataFrame:
    """Attach the version with ``valid_from <= d < valid_to`` (open ``valid_to`` = current).

    Versions of one key do not overlap.  Rows without key or date meet no version; an
    inner join drops rows that meet none, a left join keeps them with nulls."""
    vcols = version_cols or [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    kept = ["valid_from", "valid_to", *vcols]
    row, version = F.struct(*[F.col(c) for c in rows.columns]), F.struct(*[F.col(c) for c in kept])
    v = versions.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_k"), F.col("valid_from").alias("_d"), F.lit(0).alias("_kind"), version.alias("_version"))
    r = rows.select(F.col(key).alias("_k"), F.col(date_col).alias("_d"), F.lit(1).alias("_kind"), row.alias("_row"))
    both = v.unionByName(r, allowMissingColumns=True)
    met = carry_last(both, ["_k"], ["_d", "_kind"], "_version").where("_kind = 1")
    valid = F.col("_version").isNotNull() & (F.col("_version.valid_to").isNull() | (F.col("_d") < F.col("_version.valid_to")))
    met = met.withColumn("_version", F.when(valid, F.col("_version")))
    if how == "inner":
        met = met.where("_version IS NOT NULL")
    return met.select(*[F.col("_row")[c].alias(c) for c in rows.columns], *[F.col("_version")[c].alias(c) for c in kept])
