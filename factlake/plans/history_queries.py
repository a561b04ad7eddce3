"""History queries: SCD-2 versions, hash diff, idempotent merge, as-of and fact-filing joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.functions import keys as K
from factlake.operators import buckets, history
from factlake.operators.asof import asof_join
from factlake.operators.merge import merge_upsert, scd2_history
from factlake.plans import bindings as B
from factlake.plans import oracle as O
from factlake.plans.registry import register
from factlake.session import scratch_dir

TRACKED = ["company_name", "sic", "state_of_incorporation"]


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.company_snapshots_from_orders(B.table(spark, sf_dir, "orders"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_history(snapshots(spark, sf_dir), "cik", TRACKED)


SCD2_SQL = O.with_ctes(
    """SELECT cik, company_name, sic, state_of_incorporation, _hash_diff, valid_from, valid_to,
              valid_to IS NULL AS is_current, CAST(valid_from AS TIMESTAMP) AS _first_seen_ts,
              CAST(last_seen AS TIMESTAMP) AS _last_seen_ts FROM versions""",
    **O.SCD2_CTES)


@register("scd2_history", SCD2_SQL)
def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company versions [valid_from, valid_to) from daily captures; a version per hash change."""
    return versions(spark, sf_dir)


HASH_SQL = f"""SELECT o_orderkey, {O.pad('o_custkey')} AS cik,
    array_to_string(list_sort([o_orderpriority, o_orderstatus, 'X' || CAST(o_custkey AS VARCHAR)]), ',') AS tickers,
    sha256(concat_ws('|', coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''),
        array_to_string(list_sort([o_orderpriority, o_orderstatus, 'X' || CAST(o_custkey AS VARCHAR)]), ',')))
      AS _hash_diff
  FROM orders"""


@register("hash_diff", HASH_SQL)
def hash_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sha256 over tracked columns with arrays sorted first (order-insensitive)."""
    o = B.table(spark, sf_dir, "orders").select(
        "o_orderkey", K.pad_cik("o_custkey").alias("cik"), "o_orderstatus", "o_orderpriority",
        F.array("o_orderpriority", "o_orderstatus",
                F.concat(F.lit("X"), F.col("o_custkey").cast("string"))).alias("tickers"))
    return o.select("o_orderkey", "cik", F.sort_array("tickers").alias("tickers"),
                    K.hash_diff("o_orderstatus", "o_orderpriority", "tickers", arrays=("tickers",))
                    .alias("_hash_diff"))


SPLIT = "1998-01-01"
TS1, TS2 = "1998-01-01 00:00:00", "2002-01-01 00:00:00"
MERGE_SQL = O.with_ctes(
    f"""SELECT coalesce(t.cik, b.cik) AS cik,
          CASE WHEN b.cik IS NOT NULL AND (t.cik IS NULL OR b.logical_date >= t.logical_date)
               THEN b.logical_date ELSE t.logical_date END AS logical_date,
          CASE WHEN b.cik IS NOT NULL AND (t.cik IS NULL OR b.logical_date >= t.logical_date)
               THEN b.company_name ELSE t.company_name END AS company_name,
          CASE WHEN b.cik IS NOT NULL AND (t.cik IS NULL OR b.logical_date >= t.logical_date)
               THEN b.sic ELSE t.sic END AS sic,
          CASE WHEN b.cik IS NOT NULL AND (t.cik IS NULL OR b.logical_date >= t.logical_date)
               THEN b.state_of_incorporation ELSE t.state_of_incorporation END AS state_of_incorporation,
          CASE WHEN t.cik IS NOT NULL THEN TIMESTAMP '{TS1}' ELSE TIMESTAMP '{TS2}' END AS _first_seen_ts,
          CASE WHEN b.cik IS NOT NULL THEN TIMESTAMP '{TS2}' ELSE TIMESTAMP '{TS1}' END AS _last_seen_ts
       FROM b1 t FULL OUTER JOIN b2 b ON t.cik = b.cik""",
    snap=O.SNAPSHOTS,
    b1=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY logical_date DESC) rn
           FROM snap WHERE logical_date < DATE '{SPLIT}') WHERE rn = 1""",
    b2=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY logical_date DESC) rn
           FROM snap WHERE logical_date >= DATE '{SPLIT}') WHERE rn = 1""")


@register("merge_upsert", MERGE_SQL)
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches (before / from 1998) merged by cik: SCD-1 attributes, first/last seen."""
    s = snapshots(spark, sf_dir)
    b1 = s.where(F.col("logical_date") < F.lit(SPLIT).cast("date"))
    b2 = s.where(F.col("logical_date") >= F.lit(SPLIT).cast("date"))
    t = merge_upsert(None, b1, ["cik"], TRACKED, TS1)
    return merge_upsert(t, b2, ["cik"], TRACKED, TS2)


@register("scd2_apply", SCD2_SQL)
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same versions, built by four batches of captures in shuffled order: most captures are late, fall inside
    versions and split or join them."""
    s = snapshots(spark, sf_dir)
    table = history.history_table(spark, scratch_dir(spark, "company-history"), s, "cik", TRACKED, n_buckets=16)
    dealt = F.pmod(F.xxhash64("cik", "logical_date"), F.lit(4))
    for n in range(4):
        history.scd2_apply(table, s.where(dealt == n), TRACKED, version=n)
        table.retire()
    return history.history(table, TRACKED)


BUCKET_KEY, BUCKET_ATTRS = ["cik", "state"], ["company_name", "sic"]
BATCHES = [("1998-01-01 00:00:00", "logical_date >= DATE '1994-01-01' AND logical_date < DATE '1997-01-01'"),
           ("2002-01-01 00:00:00", "logical_date < DATE '1995-06-01' OR logical_date >= DATE '1998-01-01'"),
           ("2003-01-01 00:00:00", "sic = 'P'")]


def _merge_step(n: int) -> str:
    """SQL of merge ``n``: table m<n-1> and batch b<n>, null-safe on the state."""
    ts, late = f"TIMESTAMP '{BATCHES[n - 1][0]}'", "t.cik IS NULL OR b.logical_date >= t.logical_date"
    pick = lambda c: f"CASE WHEN b.cik IS NOT NULL AND ({late}) THEN b.{c} ELSE t.{c} END AS {c}"
    return f"""SELECT coalesce(t.cik, b.cik) AS cik, coalesce(t.state, b.state) AS state, {pick('logical_date')}, {pick('company_name')}, {pick('sic')},
        coalesce(t._first_seen_ts, {ts}) AS _first_seen_ts, CASE WHEN b.cik IS NOT NULL THEN {ts} ELSE t._last_seen_ts END AS _last_seen_ts
      FROM m{n - 1} t FULL OUTER JOIN b{n} b ON t.cik = b.cik AND t.state IS NOT DISTINCT FROM b.state"""


@register("merge_buckets", O.with_ctes(
    "SELECT * FROM m3", snap=O.SNAPSHOTS, keyed="SELECT *, nullif(state_of_incorporation, '5-LOW') AS state FROM snap",
    **{f"b{n}": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik, state ORDER BY logical_date DESC) AS rn FROM keyed WHERE {where}) WHERE rn = 1"""
       for n, (_, where) in enumerate(BATCHES, 1)},
    m1=f"SELECT cik, state, logical_date, company_name, sic, TIMESTAMP '{BATCHES[0][0]}' AS _first_seen_ts, TIMESTAMP '{BATCHES[0][0]}' AS _last_seen_ts FROM b1",
    m2=_merge_step(2), m3=_merge_step(3)))
def merge_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches merged by (cik, state), a key whose second part may be null: the second is partly older than the table,
    the third touches few keys; each rewrites only its buckets."""
    s = snapshots(spark, sf_dir).withColumn("state", F.nullif(F.col("state_of_incorporation"), F.lit("5-LOW")))
    table = buckets.keyed_table(spark, scratch_dir(spark, "company-buckets"), s, BUCKET_KEY, BUCKET_ATTRS, n_buckets=16)
    for n, (ts, where) in enumerate(BATCHES, 1):
        buckets.merge_buckets(table, s.where(where), BUCKET_ATTRS, ts, version=n, nullable_keys=("state",))
        table.retire()
    return table.read()


ASOF_SQL = O.with_ctes(
    """SELECT r.l_orderkey, CAST(r.l_linenumber AS BIGINT) AS l_linenumber, r.l_partkey, r.l_suppkey, r.cik, r.d, v.valid_from,
              v.sic, v.state_of_incorporation
       FROM r ASOF JOIN versions v ON r.cik = v.cik AND r.d >= v.valid_from""",
    **O.SCD2_CTES,
    r=f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {O.pad('o_custkey')} AS cik,
             CAST(l_shipdate AS DATE) AS d
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")


@register("asof_dimension_join", ASOF_SQL)
def asof_dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fact (by customer via its order) joined to the company version valid on its date."""
    li = B.table(spark, sf_dir, "lineitem")
    o = B.table(spark, sf_dir, "orders")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", K.pad_cik("o_custkey").alias("cik"),
        F.to_date("l_shipdate").alias("d"))
    # The dimension is a table in its own right: written once (shared folder), then read by
    # both the horizon subquery and the join instead of being recomputed for each.
    path = scratch_dir(spark, "company-versions")
    versions(spark, sf_dir).select("cik", "valid_from", "valid_to", "sic", "state_of_incorporation") \
        .write.mode("overwrite").parquet(path)
    v = spark.read.parquet(path)
    j = asof_join(rows, v, "cik", "d", how="inner", version_cols=["sic", "state_of_incorporation"])
    return j.drop("valid_to")


FACT_FILING_SQL = f"""
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, f.accession_number,
         CAST(CAST(l_extendedprice AS DECIMAL(38,6)) AS DOUBLE) AS value,
         g.cik AS filing_cik, g.form_type, g.filed_date
  FROM (SELECT *, printf('%010d-00-000000', l_orderkey) AS accession_number FROM lineitem) f
  LEFT JOIN (SELECT printf('%010d-00-000000', o_orderkey) AS accession_number, {O.pad('o_custkey')} AS cik,
                    o_orderpriority AS form_type, CAST(o_orderdate AS DATE) AS filed_date FROM orders) g
    ON f.accession_number = g.accession_number"""


@register("fact_filing_join", FACT_FILING_SQL)
def fact_filing_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts joined to their filings on the asserting accession (left: old accessions stay)."""
    acc = lambda c: F.format_string("%010d-00-000000", F.col(c))
    f = B.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", acc("l_orderkey").alias("accession_number"),
        F.col("l_extendedprice").cast("decimal(38,6)").alias("value"))
    g = B.table(spark, sf_dir, "orders").select(
        acc("o_orderkey").alias("accession_number"), K.pad_cik("o_custkey").alias("filing_cik"),
        F.col("o_orderpriority").alias("form_type"), F.to_date("o_orderdate").alias("filed_date"))
    return f.join(g, "accession_number", "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "accession_number", "value",
        "filing_cik", "form_type", "filed_date")
