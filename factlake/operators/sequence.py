"""Previous-row lookups over ordered groups that stay balanced under skew.

A hash-partitioned window puts every row of one key into one task.  For fact
keys that is normally tens of rows, but one key may hold a large share of a
table.  ``ordered_lag`` therefore:

1. samples the key columns to find hot keys, written as a small table (at most rows /
   ``hotKeyRows`` keys, however many that is: nothing is collected or capped);
2. runs ordinary keys through plain ``lag``/``lead`` windows (one shuffle on
   the key, one sort shared by every lag and lead on the same order);
3. runs hot keys through a range-partitioned two-level pass: rows are range
   partitioned on (key, order) and checkpointed with their partition id,
   lagged/led inside each (key, partition) piece, and the first (last) row of
   each piece takes the last (first) row of the previous (next) piece from a
   per-piece summary.  Pieces are contiguous ranges, so the summary holds at
   most (#hot keys + #partitions) rows.

How the key table and the summary are joined is left to Spark, which broadcasts
them only if their measured size allows.

The result equals ``lag(col)`` / ``lead(col) over (partition by keys order by
order)``.  ``order`` must be a total order inside each key for a deterministic
answer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlake.session import checkpoint_root, scratch_dir, shuffle_width

HOT_ROWS_CONF = "factlake.skew.hotKeyRows"
SAMPLE_CONF = "factlake.skew.sampleFraction"


def _conf(df: DataFrame, key: str, default: str) -> str:
    return df.sparkSession.conf.get(key, default)


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def _order_cols(order: list[str]) -> list[Column]:
    return [F.col(c).asc() for c in order]


@dataclass(frozen=True)
class HotKeys:
    """The keys to split (None: there are none)."""

    keys: DataFrame | None


def hot_keys(df: DataFrame, keys: list[str]) -> HotKeys:
    """Keys estimated (by sampling) to hold more than ``hotKeyRows`` rows, as a written table."""
    hot_rows = int(_conf(df, HOT_ROWS_CONF, "2000000"))
    fraction = float(_conf(df, SAMPLE_CONF, "0.01"))
    if hot_rows <= 0:
        return HotKeys(None)
    projected = df.select(*keys)
    sampled = projected if fraction >= 1.0 else projected.sample(fraction=fraction, seed=17)
    found = (sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") >= F.lit(max(1.0, hot_rows * fraction))).select(*keys))
    path = scratch_dir(df.sparkSession, "hot-keys")
    found.write.parquet(path)
    found = df.sparkSession.read.schema(found.schema).parquet(path)
    return HotKeys(None if found.isEmpty() else found)


HOT_FLAG = "_hot_key"


def _plain(df: DataFrame, keys, order, lag_cols, lead_cols, prefix, next_prefix) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in lag_cols],
                     *[F.lead(c).over(w).alias(next_prefix + c) for c in lead_cols], F.lit(False).alias(HOT_FLAG))


def _struct(cols: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(c) for c in cols]) if cols else F.struct(F.lit(None).alias("_none"))


def _ranged(df: DataFrame, keys, order, lag_cols, lead_cols, prefix, next_prefix) -> DataFrame:
    n = shuffle_width(df.sparkSession)
    ordering = [F.col(k).asc() for k in keys] + _order_cols(order)
    # The piece id is read by two branches (local lag, piece summary).  Range
    # bounds are sampled per computation, so the assignment is materialised
    # once (reliable checkpoint in the shared folder) and both branches read it.
    checkpoint_root(df.sparkSession)
    r = df.repartitionByRange(n, *ordering).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    piece = Window.partitionBy(*keys, "_pid").orderBy(*_order_cols(order))
    local = r.select("*", F.lag(F.lit(1)).over(piece).isNull().alias("_first_in_piece"),
                     F.lead(F.lit(1)).over(piece).isNull().alias("_last_in_piece"),
                     *[F.lag(c).over(piece).alias(prefix + c) for c in lag_cols],
                     *[F.lead(c).over(piece).alias(next_prefix + c) for c in lead_cols])
    ords = F.struct(*[F.col(c) for c in order])
    summary = r.groupBy(*keys, "_pid").agg(F.max_by(_struct(lag_cols), ords).alias("_last"),
                                           F.min_by(_struct(lead_cols), ords).alias("_first"))
    over_pieces = Window.partitionBy(*keys).orderBy("_pid")
    # Range pieces are contiguous intervals of (key, order): at most #hot keys + #partitions of them.
    edges = summary.select(*keys, "_pid", F.lag("_last").over(over_pieces).alias("_prev"),
                           F.lead("_first").over(over_pieces).alias("_next"))
    joined = local.join(edges, _null_safe_on(local, edges, list(keys) + ["_pid"]), "left")
    out = [local[c] for c in df.columns]
    out += [F.when(local["_first_in_piece"], edges["_prev"][c]).otherwise(local[prefix + c]).alias(prefix + c)
            for c in lag_cols]
    out += [F.when(local["_last_in_piece"], edges["_next"][c]).otherwise(local[next_prefix + c])
            .alias(next_prefix + c) for c in lead_cols]
    return joined.select(*out, F.lit(True).alias(HOT_FLAG))


def ordered_lag(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
                prefix: str = "prev_", lead_cols: list[str] = (), next_prefix: str = "next_",
                hot: HotKeys | None = None) -> DataFrame:
    """Add ``prefix + c`` = ``c`` on the previous row of the same key (and, for
    ``lead_cols``, ``next_prefix + c`` = ``c`` on the next row), in one ordered pass.

    Rows of hot keys carry ``_hot_key = true`` (they went through the range path).
    ``hot`` may pass a ``hot_keys`` result computed once for a parent of ``df``
    (a subset of rows has no hotter keys), saving a sampling pass.
    """
    keys, order, cols, lead_cols = list(keys), list(order), list(cols), list(lead_cols)
    if HOT_FLAG in df.columns:  # chained lags: the flag is recomputed for this split
        df = df.drop(HOT_FLAG)
    hot = (hot if hot is not None else hot_keys(df, keys)).keys
    args = (keys, order, cols, lead_cols, prefix, next_prefix)
    if hot is None:
        return _plain(df, *args)
    cold_rows = df.join(hot, _null_safe_on(df, hot, keys), "left_anti")
    hot_rows = df.join(hot, _null_safe_on(df, hot, keys), "left_semi")
    return _plain(cold_rows, *args).unionByName(_ranged(hot_rows, *args))


def ordered_lead(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
                 prefix: str = "next_", hot: HotKeys | None = None) -> DataFrame:
    """``lead`` in the same ascending order (shares the sort with lags on the same key)."""
    return ordered_lag(df, keys, order, [], lead_cols=cols, next_prefix=prefix, hot=hot)


def _carry_ranged(df: DataFrame, keys: list[str], order: list[str], col: str) -> DataFrame:
    n = shuffle_width(df.sparkSession)
    ordering = [F.col(k).asc() for k in keys] + _order_cols(order)
    checkpoint_root(df.sparkSession)
    r = df.repartitionByRange(n, *ordering).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    upto = Window.partitionBy(*keys, "_pid").orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = r.withColumn("_inside", F.last(col, ignorenulls=True).over(upto))
    ords = F.when(F.col(col).isNotNull(), F.struct(*[F.col(c) for c in order]))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    summary = r.groupBy(*keys, "_pid").agg(F.max_by(F.col(col), ords).alias("_last"))
    edges = summary.select(*keys, "_pid", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    joined = local.join(edges, _null_safe_on(local, edges, [*keys, "_pid"]), "left")
    return joined.select(*[F.coalesce(local["_inside"], edges["_before"]).alias(c) if c == col else local[c] for c in df.columns])


def carry_last(df: DataFrame, keys: list[str], order: list[str], col: str, hot: HotKeys | None = None) -> DataFrame:
    """``df`` with nulls of ``col`` replaced by its last value before them in the same key.

    Ordinary keys take one window; hot keys go through range pieces, between which each piece's last value is handed on."""
    hot = (hot if hot is not None else hot_keys(df, keys)).keys
    upto = Window.partitionBy(*keys).orderBy(*_order_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    plain = lambda d: d.withColumn(col, F.last(col, ignorenulls=True).over(upto)).select(*df.columns)
    if hot is None:
        return plain(df)
    on = _null_safe_on(df, hot, keys)
    return plain(df.join(hot, on, "left_anti")).unionByName(_carry_ranged(df.join(hot, on, "left_semi"), keys, order, col))
