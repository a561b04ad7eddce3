"""SCD-2 versions, idempotent merge, as-of join, bronze rescue and dedupe."""

import datetime as dt

from pyspark.sql import functions as F

from factlake.operators import bronze
from factlake.operators.asof import asof_join
from factlake.operators.merge import merge_upsert, scd2_history


def snaps(spark, rows):
    df = spark.createDataFrame(rows, "cik string, d string, name string, tickers array<string>")
    return df.select("cik", F.to_date("d").alias("logical_date"), "name", "tickers")


def test_scd2_permuted_arrays_and_change_back(spark):
    s = snaps(spark, [
        ("1", "2024-01-01", "A", ["X", "Y"]),
        ("1", "2024-01-02", "A", ["Y", "X"]),   # permuted tickers: no new version
        ("1", "2024-01-05", "B", ["X", "Y"]),   # rename
        ("1", "2024-01-04", "A", ["X", "Y"]),   # out-of-order arrival, same as before
        ("1", "2024-01-09", "A", ["X", "Y"]),   # change back: a new version
        ("2", "2024-01-03", "C", []),
    ])
    v = scd2_history(s, "cik", ["name", "tickers"], arrays=("tickers",)).orderBy("cik", "valid_from").collect()
    got = [(r.cik, r.name, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.is_current) for r in v]
    assert got == [("1", "A", "2024-01-01", "2024-01-05", False),
                   ("1", "B", "2024-01-05", "2024-01-09", False),
                   ("1", "A", "2024-01-09", None, True),
                   ("2", "C", "2024-01-03", None, True)]
    assert v[0]._last_seen_ts == dt.datetime(2024, 1, 4)


def test_merge_twice_is_idempotent_and_backfill_does_not_roll_back(spark):
    b1 = spark.createDataFrame([("1", "2024-01-02", "A"), ("2", "2024-01-02", "B")], "cik string, d string, n string") \
        .select("cik", F.to_date("d").alias("logical_date"), "n")
    b2 = spark.createDataFrame([("1", "2024-01-05", "A2"), ("3", "2024-01-05", "C")], "cik string, d string, n string") \
        .select("cik", F.to_date("d").alias("logical_date"), "n")
    late = spark.createDataFrame([("1", "2024-01-01", "OLD")], "cik string, d string, n string") \
        .select("cik", F.to_date("d").alias("logical_date"), "n")
    t1 = merge_upsert(None, b1, ["cik"], ["n"], "2024-01-02 06:00:00")
    t2 = merge_upsert(t1, b2, ["cik"], ["n"], "2024-01-05 06:00:00")
    t3 = merge_upsert(t2, b2, ["cik"], ["n"], "2024-01-05 06:00:00")
    r2 = {r.cik: r for r in t2.collect()}
    r3 = {r.cik: r for r in t3.collect()}
    assert len(r2) == len(r3) == 3
    assert {k: (v.n, v._first_seen_ts) for k, v in r2.items()} == {k: (v.n, v._first_seen_ts) for k, v in r3.items()}
    assert r2["1"].n == "A2" and r2["1"]._first_seen_ts == dt.datetime(2024, 1, 2, 6)
    t4 = {r.cik: r for r in merge_upsert(t3, late, ["cik"], ["n"], "2024-01-06 06:00:00").collect()}
    assert t4["1"].n == "A2" and t4["1"]._last_seen_ts == dt.datetime(2024, 1, 6, 6)


def test_asof_join_interval_semantics(spark):
    versions = spark.createDataFrame(
        [("1", "2020-01-15", "2021-03-01", "v1"), ("1", "2021-03-01", None, "v2"), ("2", "2019-01-01", None, "w")],
        "cik string, f string, t string, attr string").select(
        "cik", F.to_date("f").alias("valid_from"), F.to_date("t").alias("valid_to"), "attr")
    rows = spark.createDataFrame(
        [("1", "2020-01-14"), ("1", "2020-01-15"), ("1", "2021-02-28"), ("1", "2021-03-01"), ("1", "2030-05-05"),
         ("2", "2018-12-31"), ("2", "2025-01-01")], "cik string, d string").select("cik", F.to_date("d").alias("d"))
    got = sorted((r.cik, str(r.d), r.attr) for r in asof_join(rows, versions, "cik", "d", how="left").collect())
    assert got == [("1", "2020-01-14", None), ("1", "2020-01-15", "v1"), ("1", "2021-02-28", "v1"),
                   ("1", "2021-03-01", "v2"), ("1", "2030-05-05", "v2"), ("2", "2018-12-31", None),
                   ("2", "2025-01-01", "w")]


def test_asof_pieces_of_hot_keys_and_open_versions(spark):
    rows = spark.sql("SELECT IF(id % 3 = 0, 'hot', concat('k', id % 7)) AS cik, date_add(DATE'1990-01-01', CAST(id * 7 % 13000 AS INT)) AS d, id FROM range(3000)")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS cik, DATE'2000-01-01' AS d, 9001L AS id UNION ALL SELECT 'hot', NULL, 9002L"))
    versions = spark.sql("""SELECT k AS cik, date_add(DATE'1992-01-01', 400 * n) AS valid_from,
        CASE WHEN n < 9 THEN date_add(DATE'1992-01-01', 400 * n + IF(n = 4, 100, 400)) END AS valid_to, concat(k, '-', n) AS attr
        FROM (SELECT explode(array('hot', 'k1', 'k2', NULL)) AS k) CROSS JOIN (SELECT CAST(id AS INT) AS n FROM range(10))""")
    on = (rows.cik == versions.cik) & (rows.d >= versions.valid_from) & (versions.valid_to.isNull() | (rows.d < versions.valid_to))
    want = sorted((r.id, r.attr) for r in rows.join(versions, on).collect())
    for hot, fraction in (("2000000", "0.01"), ("100", "1.0")):
        spark.conf.set("factlake.skew.hotKeyRows", hot)
        spark.conf.set("factlake.skew.sampleFraction", fraction)
        try:
            assert sorted((r.id, r.attr) for r in asof_join(rows, versions, "cik", "d").collect()) == want
            assert asof_join(rows, versions, "cik", "d", how="left").count() == 3002
        finally:
            spark.conf.unset("factlake.skew.hotKeyRows")
            spark.conf.unset("factlake.skew.sampleFraction")


def test_rescue_keeps_types_and_is_null_when_nothing_extra(spark):
    df = spark.createDataFrame([('{"a":1,"x":{"k":[1,2]},"y":"s"}',), ('{"a":2}',)], "p string")
    got = [r.r for r in df.select(bronze.rescued(F.col("p"), ("a",)).alias("r")).collect()]
    assert got == ['{"x":{"k":[1,2]},"y":"s"}', None]


def test_dedupe_keeps_distinct_contents_of_one_resource(spark):
    df = spark.createDataFrame(
        [("r1", "h1", "2024-01-01", "t1"), ("r1", "h1", "2024-01-02", "t2"), ("r1", "h2", "2024-01-02", "t2"),
         ("r2", "h3", "2024-01-01", "t1")], "resource_id string, content_sha256 string, logical_date string, fetched_at string")
    got = sorted((r.resource_id, r.content_sha256, r.logical_date, r.captures)
                 for r in bronze.dedupe_captures(df).collect())
    assert got == [("r1", "h1", "2024-01-01", 2), ("r1", "h2", "2024-01-02", 1), ("r2", "h3", "2024-01-01", 1)]


SUBMISSIONS = {
    "cik": "0004200017", "entityType": "operating", "sic": "1234", "sicDescription": "Invented Goods",
    "name": "Example Inc.", "ein": "000000017", "category": "Small filer", "fiscalYearEnd": "0630",
    "stateOfIncorporation": "DE", "lei": None, "tickers": ["ZZZ", "AAA"], "exchanges": ["Nasdaq", "Cboe"],
    "addresses": {"mailing": {"city": "X"}, "business": {"city": "Y"}},
    "formerNames": [{"name": "Sample Goods Inc.", "from": "2001-02-03", "to": "2010-11-12"}],
    "filings": {"recent": {
        "accessionNumber": ["0004200017-26-000001", "0004200017-26-000002"],
        "filingDate": ["2026-07-29", "2026-07-28"], "reportDate": ["", ""], "acceptanceDateTime": ["", ""],
        "act": ["34", ""], "form": ["10-Q", "4"], "fileNumber": ["", ""], "filmNumber": ["", ""],
        "items": ["", ""], "core_type": ["10-Q", "4"], "primaryDocument": ["a.htm", "b.xml"],
        "primaryDocDescription": ["10-Q", "4"], "size": [1, 2], "isXBRL": [1, 0], "isInlineXBRL": [1, 0],
        "isXBRLNumeric": [1, 0]},
        "files": [{"name": "CIK0004200017-submissions-001.json", "filingCount": 1, "filingFrom": "2001-02-03",
                   "filingTo": "2005-06-07"}]},
}


def test_company_typing_and_recent_filings(spark):
    import json
    docs = spark.createDataFrame([(json.dumps(SUBMISSIONS), "2026-07-29")], "payload_json string, d string") \
        .select("payload_json", F.to_date("d").alias("logical_date"))
    from factlake.operators import silver
    c = silver.company_from_submissions(docs).first()
    assert c.cik == "0004200017" and c.company_name == "Example Inc."
    assert c.tickers == ["AAA", "ZZZ"] and c.exchanges == ["Cboe", "Nasdaq"]
    assert c.former_names == ["Sample Goods Inc."] and c.fiscal_year_end == "0630"
    f = sorted(silver.submission_filings(docs).collect(), key=lambda r: r.accession_number)
    assert [(r.accession_number, r.filing_date, r.form_type, r.primary_document) for r in f] == [
        ("0004200017-26-000001", "2026-07-29", "10-Q", "a.htm"), ("0004200017-26-000002", "2026-07-28", "4", "b.xml")]


def test_replay_diff_is_multiset_difference(spark):
    from factlake.operators.setops import replay_diff
    a = spark.createDataFrame([("d1", "x", "t1"), ("d1", "x", "t1"), ("d1", "y", "t1"), ("d2", "z", "t1")],
                              "d string, v string, fetched_at string")
    b = spark.createDataFrame([("d1", "x", "t9"), ("d1", "y", "t9"), ("d1", "w", "t9"), ("d2", "z", "t9")],
                              "d string, v string, fetched_at string")
    got = {r.d: (r.rows_a, r.rows_b, r.only_a, r.only_b, r.equivalent)
           for r in replay_diff(a, b, "d", ignore=("fetched_at",)).collect()}
    ea = a.drop("fetched_at").exceptAll(b.drop("fetched_at")).count()
    eb = b.drop("fetched_at").exceptAll(a.drop("fetched_at")).count()
    assert got == {"d1": (3, 3, 1, 1, False), "d2": (1, 1, 0, 0, True)}
    assert (ea, eb) == (1, 1)


def test_replay_tree_equals_the_plain_difference(spark):
    from factlake.operators.setops import replay_diff, replay_tree
    a = spark.sql("SELECT concat('d', id % 5) AS d, CAST(id AS STRING) AS v, 'x' AS fetched_at FROM range(400)")
    same = a.withColumn("fetched_at", F.lit("y"))
    assert replay_tree(a, same, "d", ignore=("fetched_at",)).where("NOT equivalent OR leaves_compared > 0").isEmpty()
    b = same.where("v <> '7'").unionByName(same.where("v = '11'")).unionByName(spark.sql("SELECT 'd9' AS d, CAST(NULL AS STRING) AS v, 'y' AS fetched_at"))
    b = b.withColumn("v", F.when(F.col("v") == "13", "changed").otherwise(F.col("v")))
    tree = {r.d: r for r in replay_tree(a, b, "d", ignore=("fetched_at",)).collect()}
    plain = {r.d: r for r in replay_diff(a, b, "d", ignore=("fetched_at",)).collect()}
    cols = ["rows_a", "rows_b", "only_a", "only_b", "equivalent"]
    assert {d: [r[c] for c in cols] for d, r in tree.items()} == {d: [r[c] for c in cols] for d, r in plain.items()}
    assert tree["d4"].equivalent and tree["d4"].leaves_compared == 0 and 0 < tree["d3"].leaves_compared < 16
