"""Landing writes: determinism, rerun overwrite, empty batch, fan-out rules, dry run."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.functions import keys as K
from factlake.session import scratch_dir, to_local_path
from factlake.sinks import landing as sink
from factlake.sources import landing as src


def envelopes(spark, n=20, dates=("2026-07-29", "2026-07-30")):
    rows = [(f"000000{i:04d}-26-{i:06d}", dates[i % len(dates)], f'{{"i":{i}}}') for i in range(n)]
    df = spark.createDataFrame(rows, "rid string, d string, payload string")
    return src.build_envelope(df, "filing_index", F.col("d"), F.col("rid"), K.daily_index_url("d"),
                              F.col("payload"), F.lit("2026-07-30T06:00:00.000000Z"))


def part_bytes(root, stream="filing_index"):
    out = {}
    for p in sorted(glob.glob(os.path.join(to_local_path(root), "edgar", stream, "logical_date=*", "*.gz"))):
        with gzip.open(p, "rb") as fh:
            out.setdefault(os.path.basename(os.path.dirname(p)), []).append(fh.read())
    return out


def test_same_input_same_bytes_and_rerun_overwrites(spark):
    a, b = scratch_dir(spark, "a"), scratch_dir(spark, "b")
    env = envelopes(spark)
    sink.write_stream(env, a, "filing_index")
    sink.write_stream(env, b, "filing_index")
    sink.write_stream(env, b, "filing_index")
    pa, pb = part_bytes(a), part_bytes(b)
    assert pa == pb
    assert all(len(v) > 1 for v in pb.values())  # a date is not one task


def test_raw_files_have_mtime_zero(spark):
    a = scratch_dir(spark, "a")
    sink.write_stream(envelopes(spark), a, "filing_index")
    p = glob.glob(os.path.join(to_local_path(a), "edgar", "filing_index", "*", "*.gz"))[0]
    with open(p, "rb") as fh:
        head = fh.read(8)
    assert head[4:8] == b"\x00\x00\x00\x00"


def test_rewriting_one_date_leaves_others(spark):
    a = scratch_dir(spark, "a")
    sink.write_stream(envelopes(spark), a, "filing_index")
    before = part_bytes(a)
    sink.write_stream(envelopes(spark, n=3, dates=("2026-07-29",)), a, "filing_index")
    after = part_bytes(a)
    assert after["logical_date=2026-07-30"] == before["logical_date=2026-07-30"]
    assert after["logical_date=2026-07-29"] != before["logical_date=2026-07-29"]


def test_empty_batch_replaces_partition(spark):
    a = scratch_dir(spark, "a")
    sink.write_stream(envelopes(spark), a, "filing_index")
    sink.write_batch(envelopes(spark).limit(0), a, "filing_index", "2026-07-29")
    back = src.read_landing(spark, a, "filing_index")
    assert back.where(F.col("logical_date") == "2026-07-29").count() == 0
    assert back.where(F.col("logical_date") == "2026-07-30").count() == 10


def test_round_trip_restores_logical_date(spark):
    a = scratch_dir(spark, "a")
    env = envelopes(spark)
    sink.write_stream(env, a, "filing_index")
    back = src.read_landing(spark, a, "filing_index").select(*C.ENVELOPE_FIELDS)
    assert back.exceptAll(env).count() == 0 and env.exceptAll(back).count() == 0


def test_fanout_copy_failure_is_recorded_primary_failure_is_fatal(spark):
    env = envelopes(spark)
    p, c = scratch_dir(spark, "p"), scratch_dir(spark, "c")
    res = sink.fan_out(env, [p, c, "nosuchscheme://x/y"], streams=("filing_index",))
    assert res.targets == [p, c] and len(res.failed) == 1 and "landing_push_failed" in res.failed[0][1]
    assert res.records == 20 and res.bytes == sum(len(f'{{"i":{i}}}') for i in range(20))
    assert part_bytes(p) == part_bytes(c)
    with pytest.raises(Exception):
        sink.fan_out(env, ["nosuchscheme://x/y", c], streams=("filing_index",))
    assert sink.fan_out(env, []).targets == []
    d = "2026-07-29"  # a batch that came back empty replaces what was landed for its date
    sink.fan_out(env.where(F.col("logical_date") != d), [p], streams=("filing_index",), dates=(d,))
    assert src.read_landing(spark, p, "filing_index").where(F.col("logical_date") == d).count() == 0


def test_dry_run_writes_nothing(spark):
    totals = sink.dry_run(envelopes(spark))
    assert totals == {"records": 20, "bytes": sum(len(f'{{"i":{i}}}') for i in range(20))}


def test_resumed_run_lands_the_same_bytes_as_a_straight_run(spark):
    env = envelopes(spark, n=30, dates=("2026-07-28", "2026-07-29", "2026-07-30"))
    straight, resumed = scratch_dir(spark, "s"), scratch_dir(spark, "r")
    sink.write_stream(env, straight, "filing_index")
    sink.write_stream(env.where(F.col("logical_date") < "2026-07-29"), resumed, "filing_index")
    sink.write_stream(env.where(F.col("logical_date") >= "2026-07-29"), resumed, "filing_index")
    assert part_bytes(straight) == part_bytes(resumed)


def test_export_overwrites_never_appends(spark):
    from factlake.plans import export as X
    root = scratch_dir(spark, "serving")
    t = spark.createDataFrame([(1,), (2,)], "a int")
    X.export_tables({"t": t}, root)
    X.export_tables({"t": t}, root)
    assert spark.read.parquet(f"{root}/v1/t").count() == 2


def test_dry_run_creates_nothing(spark):
    root = scratch_dir(spark, "dry")
    sink.dry_run(envelopes(spark))
    assert not os.path.exists(to_local_path(root))
