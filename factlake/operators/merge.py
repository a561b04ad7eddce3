"""Idempotent keyed merge (SCD-1 upsert) and SCD-2 history without MERGE INTO.

Parquet has no MERGE: a merge produces the next snapshot of the table as a
DataFrame (null-safe full outer join on the business key), written to a new
directory.  Both join sides hold one row per key, so hot keys cannot skew it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.functions import keys as K
from factlake.operators.sequence import hot_keys, ordered_lag, ordered_lead


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest ``order``, ties by the other columns, so the winner never
    depends on the order of the input (aggregate with partial combine)."""
    rest = [*order, *[c for c in df.columns if c not in key and c not in order]]
    return df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_r")).select(*key, "_r.*")


def merge_upsert(target: DataFrame | None, batch: DataFrame, key: list[str], attrs: list[str],
                 batch_ts: str, order_col: str = "logical_date",
                 nullable_keys: tuple[str, ...] = ()) -> DataFrame:
    """SCD-1 upsert of ``batch`` into ``target``.

    ``_first_seen_ts`` is set on insert and kept; ``_last_seen_ts`` moves to the
    batch time on every merge that sees the key.  Attributes are replaced only
    when the incoming ``order_col`` is not older than the target's, so a late
    backfill cannot roll a row back.  Running the same batch twice is a no-op.

    Business keys are NOT NULL by contract and join with plain equality, which
    lets the join reuse the batch's hash partitioning on the key; key parts
    listed in ``nullable_keys`` (e.g. ``period_start``) join null-safely.
    """
    ts = K.utc_timestamp(F.lit(batch_ts))
    b = latest_per_key(batch.select(*key, order_col, *attrs), key, [order_col])
    if target is None:
        return b.select(*key, order_col, *attrs, ts.alias("_first_seen_ts"), ts.alias("_last_seen_ts"))
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    b = b.withColumn("_in_b", F.lit(True)).alias("b")
    on = reduce(lambda x, y: x & y,
                [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) if k in nullable_keys
                 else F.col(f"t.{k}") == F.col(f"b.{k}") for k in key])
    j = t.join(b, on, "full_outer")
    has_b = F.col("b._in_b").isNotNull()
    has_t = F.col("t._in_t").isNotNull()
    take_b = has_b & (~has_t | (F.col(f"b.{order_col}") >= F.col(f"t.{order_col}")))
    out = [F.when(has_t, F.col(f"t.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in key]
    out += [F.when(take_b, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in [order_col, *attrs]]
    out += [F.when(has_t, F.col("t._first_seen_ts")).otherwise(ts).alias("_first_seen_ts"),
            F.when(has_b, ts).otherwise(F.col("t._last_seen_ts")).alias("_last_seen_ts")]
    return j.select(*out)


def scd2_history(snapshots: DataFrame, key: str, tracked: list[str], arrays: tuple[str, ...] = (),
                 date_col: str = "logical_date", within_day: tuple[str, ...] = (), carry: tuple[str, ...] = ()) -> DataFrame:
    """Versions from dated captures: a new version whenever ``_hash_diff`` changes.

    Gaps-and-islands on one partitioning: lag/lead of the hash marks version
    starts and ends, a lead over those rows gives each version's last sighting,
    and a lead over starts gives ``valid_to`` (half-open, = next ``valid_from``).
    Captures whose hash equals the previous one never create a version, so
    re-ordered arrays or a repeated day change nothing.  With ``within_day`` (columns that order
    several captures of one day) only the last capture of a day counts, so no version is empty.
    ``carry`` names untracked attributes; a version has them as of its first capture.
    """
    if within_day:
        snapshots = latest_per_key(snapshots.select(key, date_col, *within_day, *tracked, *carry), [key, date_col], list(within_day))
    s = snapshots.select(key, date_col, *tracked, *carry).withColumn(
        "_hash_diff", K.hash_diff(*tracked, arrays=arrays))
    hot = hot_keys(s, [key])
    s = ordered_lag(s, [key], [date_col], ["_hash_diff"], prefix="prev_", lead_cols=["_hash_diff"], hot=hot)
    s = (s.withColumn("_start", ~F.col("prev__hash_diff").eqNullSafe(F.col("_hash_diff")))
          .withColumn("_end", ~F.col("next__hash_diff").eqNullSafe(F.col("_hash_diff")))
          .where(F.col("_start") | F.col("_end")))
    s = ordered_lead(s, [key], [date_col], [date_col], prefix="next_", hot=hot)
    starts = s.where("_start").withColumn(
        "_last_seen", F.when(F.col("_end"), F.col(date_col)).otherwise(F.col(f"next_{date_col}")))
    v = ordered_lead(starts.drop(f"next_{date_col}"), [key], [date_col], [date_col], prefix="next_", hot=hot)
    return v.select(
        key, *tracked, *carry,
        F.col("_hash_diff"),
        F.col(date_col).alias("valid_from"),
        F.col(f"next_{date_col}").alias("valid_to"),
        F.col(f"next_{date_col}").isNull().alias("is_current"),
        K.utc_timestamp(F.col(date_col)).alias("_first_seen_ts"),
        K.utc_timestamp(F.col("_last_seen")).alias("_last_seen_ts"),
    )
