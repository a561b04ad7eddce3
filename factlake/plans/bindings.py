"""Adapters from the driver's tables to the engine's inputs.

Each binding is a pure projection of one table, so Catalyst prunes columns and
pushes filters into the parquet scan; nothing here shuffles.  The SQL twins of
these views (for the DuckDB oracle) live in ``factlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.functions import keys as K

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed literals that make every query deterministic (no wall clock in results).
RUN_ID = "run-00000000"
GENERATED_AT = "2026-01-01 00:00:00"
AS_OF_DATE = "2026-07-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def generated_at() -> Column:
    return K.utc_timestamp(F.lit(GENERATED_AT))


def concept_canonical(tag: Column) -> Column:
    """Canonical concept from the fixed 2-entry map; NULL when unmapped."""
    m = F.create_map(*[F.lit(x) for pair in C.CONCEPT_MAP for x in pair])
    return F.try_element_at(m, tag)


def facts_from_lineitem(lineitem: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """silver.financial_fact rows: one assertion per lineitem row.

    cik = padded order key; concept = 'L' || line number; odd lines are instant
    facts; the asserting accession is built from (part, ship year, supplier).
    """
    li = lineitem
    odd = (F.col("l_linenumber") % 2) == 1
    tag = F.concat(F.lit("L"), F.col("l_linenumber").cast("string"))
    filed = F.to_date(F.col("l_shipdate"))
    return li.select(
        K.pad_cik("l_orderkey").alias("cik"),
        F.lit(C.TAXONOMY).alias("taxonomy"),
        tag.alias("concept_tag"),
        concept_canonical(tag).alias("concept_canonical"),
        F.lit("USD").alias("unit"),
        F.when(odd, F.lit(None).cast("date")).otherwise(F.lit("1995-01-01").cast("date")).alias("period_start"),
        F.lit("2001-12-31").cast("date").alias("period_end"),
        F.when(odd, F.lit("instant")).otherwise(F.lit("duration")).alias("period_type"),
        K.accession_from_parts(F.col("l_partkey"), F.year("l_shipdate") % 100, F.col("l_suppkey"))
        .alias("accession_number"),
        F.col("l_extendedprice").cast("decimal(38,6)").alias("value"),
        F.lit(None).cast("int").alias("decimals"),
        F.year("l_shipdate").alias("fiscal_year"),
        F.concat(F.lit("Q"), F.quarter("l_shipdate").cast("string")).alias("fiscal_period"),
        F.when(F.col("l_returnflag") == "R", F.lit("10-K/A")).otherwise(F.lit("10-K")).alias("form_type"),
        filed.alias("filed_date"),
        F.lit(None).cast("string").alias("frame"),
        filed.alias("logical_date"),
        *[F.col(c).alias(c) for c in keep],
    )


def companies_from_customer(customer: DataFrame) -> DataFrame:
    """Current company rows (one per cik) used for name lookups."""
    return customer.select(K.pad_cik("c_custkey").alias("cik"), F.col("c_name").alias("company_name"))


def facts_with_defects(lineitem: DataFrame) -> DataFrame:
    """Facts whose defects follow from the data itself: unpadded cik on single-unit
    lines, malformed accession at the top discount, empty unit when untaxed,
    no value when undiscounted, period end before start on 50-unit lines."""
    raw = ("l_orderkey", "l_quantity", "l_discount", "l_tax")
    g = facts_from_lineitem(lineitem, keep=raw)
    cols = {c: F.col(c) for c in g.columns if c not in raw}
    cols["cik"] = F.when(F.col("l_quantity") == 1, F.col("l_orderkey").cast("string")).otherwise(cols["cik"])
    cols["accession_number"] = (F.when(F.col("l_discount") >= 0.095,
                                       F.regexp_replace(cols["accession_number"], "-", ""))
                                .otherwise(cols["accession_number"]))
    cols["unit"] = F.when(F.col("l_tax") == 0, F.lit("")).otherwise(cols["unit"])
    cols["value"] = F.when(F.col("l_discount") == 0, F.lit(None).cast("decimal(38,6)")).otherwise(cols["value"])
    cols["period_end"] = (F.when(F.col("l_quantity") == 50, F.lit("1994-12-31").cast("date"))
                          .otherwise(cols["period_end"]))
    return g.select(*[e.alias(n) for n, e in cols.items()])


def index_rows_with_defects(events: DataFrame) -> DataFrame:
    """Index rows whose defects follow from the events: malformed accession on errors, too wide cik above 300,
    no form on small views, no date on small signups, a date before the floor on larger clicks; purchases
    carry undeclared keys."""
    r = index_rows_from_events(events, extra=("event_type", "value", "props"))
    et, v = F.col("event_type"), F.col("value")
    return r.select(
        "company_name", "file_name", "logical_date",
        F.when(et == "error", F.regexp_replace("accession_number", "-", "")).otherwise(F.col("accession_number")).alias("accession_number"),
        F.when(v > 300, F.concat("cik", F.lit("00000000000"))).otherwise(F.col("cik")).alias("cik"),
        F.when((et == "view") & (v < 5), F.lit("")).otherwise(F.col("form_type")).alias("form_type"),
        F.when((et == "signup") & (v < 5), F.lit("n/a")).when((et == "click") & (v > 100), F.lit("19921231"))
        .otherwise(F.col("date_filed")).alias("date_filed"),
        F.when(et == "purchase", F.col("props")).alias("_rescued_data"))


def submissions_from_customer(customer: DataFrame) -> DataFrame:
    """One submissions document per customer; too wide cik on a negative balance, no name in one market segment."""
    key, wide = F.col("c_custkey").cast("string"), F.col("c_acctbal") < 0
    doc = F.to_json(F.struct(
        F.when(wide, F.concat(key, F.lit("00000000000"))).otherwise(key).alias("cik"), F.lit("operating").alias("entityType"),
        F.col("c_nationkey").cast("string").alias("sic"), F.col("c_mktsegment").alias("sicDescription"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"), F.lpad(key, 9, "0").alias("ein"),
        F.array(F.concat(F.lit("T"), key), F.lit("A")).alias("tickers"), F.array(F.lit("NYSE"), F.lit("NASDAQ")).alias("exchanges"),
        F.array(F.struct(F.concat(F.lit("Old "), key).alias("name"))).alias("formerNames")))
    return customer.select(doc.alias("payload_json"), F.lit("2024-01-01").cast("date").alias("logical_date"))


def company_dimension_from_customer(customer: DataFrame) -> DataFrame:
    """Current company attributes: nation key as SIC code, market segment as its description."""
    return customer.select(
        K.pad_cik("c_custkey").alias("cik"),
        F.col("c_name").alias("company_name"),
        F.col("c_nationkey").cast("string").alias("sic"),
        F.col("c_mktsegment").alias("sic_description"),
        F.lit("operating").alias("entity_type"),
        F.lit(None).cast("string").alias("state_of_incorporation"),
        F.lit("1231").alias("fiscal_year_end"),
        F.lit(None).cast("array<string>").alias("tickers"),
        F.lit(None).cast("array<string>").alias("exchanges"),
    )


def index_rows_from_events(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Daily-index rows (bronze filing_index payload fields, all strings).

    One filing per event: accession from (event id, year, user), cik = user,
    form = upper(event type) with '/A' on every 7th event.
    """
    acc = K.accession_from_parts(F.col("event_id"), F.year("ts") % 100, F.col("user_id") % 1000000)
    form = F.concat(F.upper("event_type"), F.when(F.col("event_id") % 7 == 0, F.lit("/A")).otherwise(F.lit("")))
    return events.select(
        F.format_string("Filer %d", F.col("user_id")).alias("company_name"),
        form.alias("form_type"),
        F.col("user_id").cast("string").alias("cik"),
        F.date_format("ts", "yyyyMMdd").alias("date_filed"),
        F.format_string("edgar/data/%d/%s.txt", F.col("user_id"), acc).alias("file_name"),
        acc.alias("accession_number"),
        F.to_date("ts").alias("logical_date"),
        *[F.col(c) for c in extra],
    )


def company_snapshots_from_orders(orders: DataFrame) -> DataFrame:
    """Daily company captures: cik = customer, tracked = (status, priority).

    Keeps the capture of the greatest order key per (cik, day), as one
    submissions document per company and day would.
    """
    o = orders.select(
        K.pad_cik("o_custkey").alias("cik"),
        F.to_date("o_orderdate").alias("logical_date"),
        F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"))
    best = o.groupBy("cik", "logical_date").agg(
        F.max_by(F.struct("o_orderstatus", "o_orderpriority"), F.col("o_orderkey")).alias("s"))
    return best.select(
        "cik", "logical_date",
        F.format_string("Company %s", F.col("cik")).alias("company_name"),
        F.col("s.o_orderstatus").alias("sic"),
        F.col("s.o_orderpriority").alias("state_of_incorporation"),
    )


def request_log_from_events(events: DataFrame) -> DataFrame:
    """A fetch log: one request per event; stream by user, status by event type (views above 150: transport errors, no status)."""
    status = (F.when((F.col("event_type") == "view") & (F.col("value") > 150), F.lit(None).cast("int"))
              .when(F.col("event_type") == "signup", 404)
              .when(F.col("event_type") == "error", 503)
              .when(F.col("event_type") == "purchase", 429)
              .otherwise(200))
    streams = F.array(*[F.lit(s) for s in C.STREAMS])
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("requested_at"),
        K.pad_cik("user_id").alias("resource_cik"),
        K.submissions_url("user_id").alias("url"),
        F.element_at(streams, (F.col("user_id") % 3 + 1).cast("int")).alias("stream"),
        status.alias("http_status"),
    )


def universe_from_customer(customer: DataFrame) -> DataFrame:
    return customer.select(K.pad_cik("c_custkey").alias("cik"))


def completed_from_orders(orders: DataFrame) -> DataFrame:
    """Pairs already fetched in an interrupted run: the first concept of every
    customer with a fulfilled order; for even customer keys it was not reported
    (null envelope, still done)."""
    return (orders.where(F.col("o_orderstatus") == "F")
            .select(K.pad_cik("o_custkey").alias("cik"), F.lit(C.CONCEPT_SET[0]).alias("concept"),
                    F.when(F.col("o_custkey") % 2 == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit("env:"), K.pad_cik("o_custkey"), F.lit("/"),
                                        F.lit(C.CONCEPT_SET[0]))).alias("envelope"))
            .distinct())


def fetched_for_plan(plan: DataFrame, customer: DataFrame) -> DataFrame:
    """Outcome of fetching the pending pairs: customers with a negative balance
    report nothing (404, null envelope)."""
    neg = customer.select(K.pad_cik("c_custkey").alias("cik"), (F.col("c_acctbal") < 0).alias("_neg"))
    return plan.join(neg, "cik", "left").select(
        "cik", "concept",
        F.when(F.coalesce(F.col("_neg"), F.lit(False)), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("env:"), F.col("resource_id"))).alias("envelope"))
