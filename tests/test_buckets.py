"""Bucketed merge and incremental history: untouched files, replays, late captures, retired versions."""

import datetime as dt
import glob
import random

from factlake.operators import buckets, history
from factlake.operators.merge import scd2_history

ATTRS = ["name"]


def batch(spark, rows):
    return spark.createDataFrame([(k, p, dt.date(2024, 1, d), n) for k, p, d, n in rows], "id string, part string, logical_date date, name string")


def files(root, pointers):
    return {b: sorted(glob.glob(f"{root}/data/v={v}/key_bucket={b}/*.parquet")) for b, v in pointers.items()}


def rows(table):
    return sorted((r.id, r.part or "-", r.logical_date.day, r.name, str(r._first_seen_ts)[:10], str(r._last_seen_ts)[:10]) for r in table.read().collect())


def made(spark, root):
    first = batch(spark, [(f"k{i}", None if i % 3 else "p", 10, f"n{i}") for i in range(60)])
    table = buckets.keyed_table(spark, root, first, ["id", "part"], ATTRS, n_buckets=8)
    touched = buckets.merge_buckets(table, first, ATTRS, "2024-02-01 00:00:00", 1, nullable_keys=("part",))
    assert touched == list(range(8))
    return table


def test_untouched_buckets_keep_their_files_and_replays_change_nothing(spark, tmp_root):
    table = made(spark, tmp_root)
    before = files(tmp_root, table.pointers())
    small = batch(spark, [("k1", None, 12, "new"), ("k1", None, 11, "between"), ("k2", None, 5, "late"), ("k100", None, 1, "more")])
    touched = buckets.merge_buckets(table, small, ATTRS, "2024-03-01 00:00:00", 2, nullable_keys=("part",))
    assert 0 < len(touched) <= 3
    after = files(tmp_root, table.pointers())
    assert {b for b in before if before[b] != after[b]} == set(touched)
    got = {r[0]: r[1:] for r in rows(table)}
    assert len(got) == 61
    assert got["k1"] == ("-", 12, "new", "2024-02-01", "2024-03-01")
    assert got["k2"] == ("-", 10, "n2", "2024-02-01", "2024-03-01")     # late: seen, but not rolled back
    assert got["k3"] == ("p", 10, "n3", "2024-02-01", "2024-02-01")
    once, pointers = rows(table), table.pointers()
    buckets.merge_buckets(table, small, ATTRS, "2024-03-01 00:00:00", 2, nullable_keys=("part",))
    assert rows(table) == once and table.pointers() == pointers
    buckets.merge_buckets(table, small.limit(0), ATTRS, "2024-04-01 00:00:00", 3, nullable_keys=("part",))
    assert rows(table) == once


def test_a_merge_without_manifest_is_not_seen_and_old_buckets_go(spark, tmp_root):
    table = made(spark, tmp_root)
    once = rows(table)
    half = batch(spark, [("k1", None, 12, "unfinished")]).withColumn("key_bucket", table.bucket())
    half.selectExpr("id", "part", "logical_date", "name", "key_bucket").write.partitionBy("key_bucket").parquet(f"{tmp_root}/data/v=2")
    assert rows(table) == once and table.retire(keep=1) == 0
    for v in (2, 3, 4):
        buckets.merge_buckets(table, batch(spark, [("k1", None, 12 + v, f"v{v}")]), ATTRS, "2024-03-01 00:00:00", v, nullable_keys=("part",))
    assert table.versions() == [1, 2, 3, 4]
    assert table.retire(keep=2) == 2 and table.versions() == [3, 4]     # k1's bucket of versions 1 and 2
    assert {r[0]: r[3] for r in rows(table)}["k1"] == "v4" and len(rows(table)) == 60


CAPTURE = "cik string, logical_date date, name string, tags array<string>"


def captures(spark, items):
    return spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(days=d), n, t) for k, d, n, t in items], CAPTURE)


def spans(table):
    v = history.history(table, ["name", "tags"])
    return sorted((r.cik, r.name or "-", str(r.valid_from), str(r.valid_to), r.is_current, str(r._last_seen_ts)[:10]) for r in v.collect())


def test_late_captures_split_join_and_repeat(spark, tmp_root):
    first = captures(spark, [("a", 0, "x", ["p", "q"]), ("a", 10, "x", ["q", "p"]), ("a", 20, "y", []), ("b", 3, "z", [])])
    table = history.history_table(spark, tmp_root, first, "cik", ["name", "tags"], n_buckets=4)
    apply = lambda items, v: history.scd2_apply(table, captures(spark, items), ["name", "tags"], v, arrays=("tags",))
    apply([("a", 0, "x", ["p", "q"]), ("a", 10, "x", ["q", "p"]), ("a", 20, "y", []), ("b", 3, "z", [])], 1)
    of_b = ("b", "z", "2024-01-04", "None", True, "2024-01-04")
    assert spans(table) == [("a", "x", "2024-01-01", "2024-01-21", False, "2024-01-11"), ("a", "y", "2024-01-21", "None", True, "2024-01-21"), of_b]
    apply([("a", 5, "y", [])], 2)   # falls inside and splits: back to x at its next sighting
    assert spans(table)[:4] == [("a", "x", "2024-01-01", "2024-01-06", False, "2024-01-01"), ("a", "x", "2024-01-11", "2024-01-21", False, "2024-01-11"),
                                ("a", "y", "2024-01-06", "2024-01-11", False, "2024-01-06"), ("a", "y", "2024-01-21", "None", True, "2024-01-21")]
    same = spans(table)
    apply([("a", 5, "y", []), ("b", 3, "z", [])], 3)   # repeated days
    assert spans(table) == same
    apply([("a", 15, "y", [])], 4)  # equals the version that follows: that one starts earlier
    assert ("a", "y", "2024-01-16", "None", True, "2024-01-21") in spans(table)
    apply([("a", -5, None, None), (None, 1, "lost", [])], 5)
    assert spans(table)[0] == ("a", "-", "2023-12-27", "2024-01-01", False, "2023-12-27")


def test_any_order_of_batches_equals_the_full_rebuild(spark, tmp_root):
    rnd = random.Random(5)
    items = [(f"c{c}", d, rnd.choice("xyz"), []) for c in range(12) for d in rnd.sample(range(40), 15)]
    full = scd2_history(captures(spark, items), "cik", ["name", "tags"], arrays=("tags",))
    want = sorted((r.cik, r.name, str(r.valid_from), str(r.valid_to), r.is_current, str(r._last_seen_ts)[:10]) for r in full.collect())
    rnd.shuffle(items)
    table = history.history_table(spark, tmp_root, captures(spark, items), "cik", ["name", "tags"], n_buckets=4)
    for v in range(4):
        history.scd2_apply(table, captures(spark, items[v::4]), ["name", "tags"], v, arrays=("tags",))
    assert spans(table) == want
