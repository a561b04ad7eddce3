"""Skew-safe ordered lag: the hot-key (range-partitioned) path equals a plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from factlake.operators.sequence import HOT_FLAG, ordered_lag, ordered_lead


def _data(spark):
    # one hot key holding most rows, a few ordinary keys, a NULL key part
    rows = [("hot", None, i, f"a{i:05d}", float(i % 7)) for i in range(3000)]
    rows += [(f"k{j}", "p", i, f"b{i}", float(i)) for j in range(40) for i in range(5)]
    rows += [("n", None, i, f"c{i}", 1.0) for i in range(4)]
    return spark.createDataFrame(rows, "k string, p string, t int, acc string, v double")


def _expected(df, keys, order, desc=False):
    o = [F.col(c).desc() if desc else F.col(c) for c in order]
    w = Window.partitionBy(*keys).orderBy(*o)
    return df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("acc").over(w).alias("prev_acc"))


def _rows(df):
    return sorted(tuple(r) for r in df.select("k", "p", "t", "acc", "v", "prev_v", "prev_acc").collect())


def test_plain_path_matches_window(spark):
    df = _data(spark)
    got = ordered_lag(df, ["k", "p"], ["t", "acc"], ["v", "acc"])
    assert _rows(got) == _rows(_expected(df, ["k", "p"], ["t", "acc"]))
    assert got.where(F.col(HOT_FLAG)).count() == 0


def test_hot_path_matches_window(spark):
    df = _data(spark)
    spark.conf.set("factlake.skew.hotKeyRows", "100")
    spark.conf.set("factlake.skew.sampleFraction", "1.0")
    try:
        got = ordered_lag(df, ["k", "p"], ["t", "acc"], ["v", "acc"])
        assert got.where(F.col(HOT_FLAG)).count() == 3000
        assert _rows(got) == _rows(_expected(df, ["k", "p"], ["t", "acc"]))
    finally:
        spark.conf.unset("factlake.skew.hotKeyRows")
        spark.conf.unset("factlake.skew.sampleFraction")


def test_any_number_of_hot_keys_is_split(spark):
    df = _data(spark)
    spark.conf.set("factlake.skew.hotKeyRows", "1")
    spark.conf.set("factlake.skew.sampleFraction", "1.0")
    try:
        got = ordered_lag(df, ["k", "p"], ["t", "acc"], ["v", "acc"])
        assert got.where(~F.col(HOT_FLAG)).count() == 0
        assert _rows(got) == _rows(_expected(df, ["k", "p"], ["t", "acc"]))
        assert "strategy=broadcast" not in got._jdf.queryExecution().optimizedPlan().toString()  # no hint
    finally:
        for k in ("hotKeyRows", "sampleFraction"):
            spark.conf.unset(f"factlake.skew.{k}")


def test_lead_hot_path(spark):
    df = _data(spark)
    spark.conf.set("factlake.skew.hotKeyRows", "100")
    spark.conf.set("factlake.skew.sampleFraction", "1.0")
    try:
        got = ordered_lead(df, ["k", "p"], ["t", "acc"], ["v", "acc"], prefix="prev_")
        assert _rows(got) == _rows(_expected(df, ["k", "p"], ["t", "acc"], desc=True))
    finally:
        spark.conf.unset("factlake.skew.hotKeyRows")
        spark.conf.unset("factlake.skew.sampleFraction")


def test_chained_lags_on_hot_keys(spark):
    from factlake.operators.merge import scd2_history
    rows = [("1", f"2024-01-{d:02d}", "A" if d < 10 or d > 20 else "B") for d in range(1, 29)]
    rows += [("2", "2024-01-05", "C")]
    s = spark.createDataFrame(rows, "cik string, d string, name string").select(
        "cik", F.to_date("d").alias("logical_date"), "name")
    base = sorted(tuple(r) for r in scd2_history(s, "cik", ["name"]).collect())
    spark.conf.set("factlake.skew.hotKeyRows", "3")
    spark.conf.set("factlake.skew.sampleFraction", "1.0")
    try:
        hot = sorted(tuple(r) for r in scd2_history(s, "cik", ["name"]).collect())
    finally:
        spark.conf.unset("factlake.skew.hotKeyRows")
        spark.conf.unset("factlake.skew.sampleFraction")
    assert hot == base and len(base) == 4
