"""Landed inputs derived from the driver's tables, written under the shared
checkpoint folder so that source operators read real files.

Daily index files: one file per nation, customers as filings.  Layout faults
follow the data: region 0 files carry a changed header, region 1 files shift
the rows of customers with a negative balance by 12 characters, region 2 files
lack the separator line, region 3 files use CRLF line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.plans import bindings as B
from factlake.session import scratch_dir

HEADER_OK = "Form Type   Company Name                                                  CIK"
HEADER_BAD = "Form Type   Ticker   Company Name   CIK"
HEADER_WRAP = "          Date Filed  File Name"
SEPARATOR = "-" * 120
HEADER_LINES = 6  # data starts on line 7


def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = B.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cust = B.table(spark, sf_dir, "customer")
    eol = F.when(F.col("n_regionkey") == 3, F.lit("\r")).otherwise(F.lit(""))
    head = nation.select(
        F.col("n_nationkey").alias("nation"), "n_regionkey",
        F.posexplode(F.array(
            F.lit("Description:           Filings of one day by form type (made from the customer table)"),
            F.lit("Last Data Received:    see the rows"),
            F.lit(""),
            F.when(F.col("n_regionkey") == 0, F.lit(HEADER_BAD)).otherwise(F.lit(HEADER_OK)),
            F.lit(HEADER_WRAP),
            F.when(F.col("n_regionkey") == 2, F.lit(None)).otherwise(F.lit(SEPARATOR)),
            F.lit(""), F.lit("")
        )).alias("seq", "line")).where(F.col("line").isNotNull())
    head = head.select("nation", "n_regionkey",
                       F.when(F.col("seq") >= 6, F.col("seq") + 1000000).otherwise(F.col("seq")).alias("seq"),
                       F.lit(0).cast("bigint").alias("k"), "line")
    acc = F.format_string("%010d-26-%06d", F.col("c_custkey"), F.col("c_nationkey"))
    filed = F.date_format(F.date_add(F.lit("2026-07-01").cast("date"), (F.col("c_custkey") % 28).cast("int")),
                          "yyyyMMdd")
    line = F.format_string("%-17s%-62s%-12s%-12s%s", F.col("c_mktsegment"), F.col("c_name"),
                           F.col("c_custkey").cast("string"), filed,
                           F.format_string("edgar/data/%d/%s.txt", F.col("c_custkey"), acc))
    c = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"])
    shifted = (F.col("n_regionkey") == 1) & (F.col("c_acctbal") < 0)
    body = c.select(F.col("c_nationkey").alias("nation"), "n_regionkey", F.lit(100).alias("seq"),
                    F.col("c_custkey").alias("k"),
                    F.when(shifted, F.concat(F.lit(" " * 12), line)).otherwise(line).alias("line"))
    rows = head.unionByName(body)
    return rows.select("nation", "seq", "k", F.concat(F.col("line"), eol).alias("line"))


def write_index_files(spark: SparkSession, sf_dir: str) -> str:
    """One text file per nation directory (``nation=N/``), lines in file order."""
    path = scratch_dir(spark, "index")
    (index_lines(spark, sf_dir).repartition("nation").sortWithinPartitions("nation", "seq", "k")
     .select("nation", "line").write.mode("overwrite").partitionBy("nation").text(path))
    return path


# ---------------------------------------------------------------------------
# Document captures: every document landed on two days; German texts revised
# on the second day.
# ---------------------------------------------------------------------------
CAPTURE_DATES = ("2024-03-01", "2024-03-02")


def document_envelopes(spark: SparkSession, sf_dir: str, capture: int) -> DataFrame:
    from factlake.functions import keys as K
    from factlake.sources.landing import build_envelope

    d = B.table(spark, sf_dir, "documents")
    day = CAPTURE_DATES[capture]
    text = F.col("text")
    if capture == 1:
        text = F.when(F.col("lang") == "de", F.concat(text, F.lit(" [rev]"))).otherwise(text)
    payload = K.canonical_json(K.sorted_struct(doc_id=F.col("doc_id"), lang=F.col("lang"),
                                               source=F.col("source"), text=text))
    d = d.select("doc_id", payload.alias("_payload"))
    return build_envelope(
        d, "company_submissions", F.lit(day), K.pad_cik("doc_id"), K.submissions_url("doc_id"),
        F.col("_payload"), F.lit(f"{day}T06:00:00.000000Z"))


def land_documents(spark: SparkSession, sf_dir: str, root: str | None = None, captures=(0, 1)) -> str:
    from factlake.sinks.landing import write_stream

    root = root or scratch_dir(spark, "landing")
    for c in captures:
        write_stream(document_envelopes(spark, sf_dir, c), root, "company_submissions")
    return root


def _index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.index_rows_from_events(B.table(spark, sf_dir, "events"), extra=("ts", "event_type", "props", "value"))


def index_envelopes_with_extras(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """filing_index envelopes; payloads of 'error' events carry two undeclared keys."""
    return _with_extras(_index_rows(spark, sf_dir), keep)


def _with_extras(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    from factlake.functions import keys as K
    from factlake.sources.landing import build_envelope, rfc3339

    fields = {f.name: F.col(f.name) for f in C.INDEX_PAYLOAD.fields}
    plain = K.canonical_json(K.sorted_struct(**fields))
    extra = K.canonical_json(K.sorted_struct(**fields, props=F.parse_json("props"), severity=F.lit("high")))
    payload = F.when(F.col("event_type") == "error", extra).otherwise(plain)
    return build_envelope(rows, "filing_index", F.col("logical_date"), F.col("accession_number"),
                          K.daily_index_url(F.col("logical_date")), payload, rfc3339(F.col("ts")), keep=keep)


def faulty_lines(spark: SparkSession, sf_dir: str, fields: list[str], cut_above: float = 400, text_above: float = 450) -> DataFrame:
    """logical_date and raw envelope lines with contract faults that follow the events: 'error' lines
    lack payload_json, 'signup' lines carry a private key, purchases above ``cut_above`` are
    truncated, clicks above ``text_above`` carry http_status as a string."""
    env = index_envelopes_with_extras(spark, sf_dir, keep=("event_type", "value"))
    full = F.to_json(F.struct(*fields))
    no_payload = F.to_json(F.struct(*[f for f in fields if f != "payload_json"]))
    et, v = F.col("event_type"), F.col("value")
    line = (F.when(et == "error", no_payload)
            .when(et == "signup", F.regexp_replace(full, "^\\{", '{"_ingest_ts":"2024-01-01T00:00:00Z",'))
            .when((et == "purchase") & (v > cut_above), F.substring(full, 1, 40))
            .when((et == "click") & (v > text_above), F.regexp_replace(full, '"http_status":200', '"http_status":"200"'))
            .otherwise(full))
    return env.select("logical_date", line.alias("value"))


def write_envelope_lines(spark: SparkSession, sf_dir: str) -> str:
    """Envelope lines with faults as plain text files."""
    path = scratch_dir(spark, "lines")
    faulty_lines(spark, sf_dir, list(C.ENVELOPE_FIELDS)).select("value").write.mode("overwrite").text(path)
    return path


def land_faulty_lines(spark: SparkSession, sf_dir: str) -> str:
    """A landing root whose filing_index lines carry the same faults."""
    from factlake.sinks.landing import stream_root

    root = scratch_dir(spark, "landing")
    faulty_lines(spark, sf_dir, [f for f in C.ENVELOPE_FIELDS if f != "logical_date"], 100, 100) \
        .write.mode("overwrite").partitionBy("logical_date").text(stream_root(root, "filing_index"))
    return root


def land_index(spark: SparkSession, sf_dir: str, root: str | None = None,
               dates: tuple[str | None, str | None] = (None, None)) -> str:
    """Land the filing_index envelopes, optionally only logical dates in [from, to).

    Index rows are dealt before their envelopes are made: narrow rows are shuffled, and the payloads
    are built in as many tasks as the shuffle has, not in the few that scan the events."""
    from factlake.sinks.landing import deal, write_stream

    root = root or scratch_dir(spark, "landing")
    rows = _index_rows(spark, sf_dir)
    if dates[0]:
        rows = rows.where(F.col("logical_date") >= F.lit(dates[0]).cast("date"))
    if dates[1]:
        rows = rows.where(F.col("logical_date") < F.lit(dates[1]).cast("date"))
    env = _with_extras(deal(rows, resource="accession_number"))
    write_stream(env, root, "filing_index", dealt=True)
    return root


# ---------------------------------------------------------------------------
# Concept and submissions documents: one per order (bounded size, no grouping).
# ---------------------------------------------------------------------------
def concept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """company_concept payloads, one per order; pending orders ('P') were not reported: HTTP 404, no payload.

    Units: USD (duration for fulfilled orders, else instant; frame on fulfilled)
    and shares (instant, no frame).  The cik travels as a JSON number.
    """

    o = B.table(spark, sf_dir, "orders")
    absent = F.col("o_orderstatus") == "P"
    tags = F.array(*[F.lit(c) for c in C.CONCEPT_SET])
    tag = F.element_at(tags, (F.col("o_orderkey") % 15 + 1).cast("int"))
    d = F.to_date("o_orderdate")
    accn = F.format_string("%010d-%02d-%06d", F.col("o_custkey"), F.year(d) % 100, F.col("o_orderkey") % 1000000)
    fulfilled = F.col("o_orderstatus") == "F"
    usd = F.struct(
        F.when(fulfilled, F.date_sub(d, 364).cast("string")).alias("start"),
        d.cast("string").alias("end"), F.col("o_totalprice").alias("val"), accn.alias("accn"),
        F.year(d).alias("fy"), F.lit("FY").alias("fp"), F.lit("10-K").alias("form"),
        F.date_add(d, 30).cast("string").alias("filed"),
        F.when(fulfilled, F.format_string("CY%d", F.year(d))).alias("frame"))
    shares = F.struct(
        F.lit(None).cast("string").alias("start"), d.cast("string").alias("end"),
        F.col("o_orderkey").cast("double").alias("val"), accn.alias("accn"), F.year(d).alias("fy"), F.lit("Q4").alias("fp"),
        F.lit("10-Q").alias("form"), F.date_add(d, 45).cast("string").alias("filed"),
        F.lit(None).cast("string").alias("frame"))
    units = F.create_map(F.lit("USD"), F.array(usd), F.lit("shares"), F.array(shares))
    doc = F.to_json(F.struct(F.col("o_custkey").alias("cik"), F.lit("us-gaap").alias("taxonomy"),
                             tag.alias("tag"), tag.alias("label"), F.lit("").alias("description"),
                             F.format_string("Company %d", F.col("o_custkey")).alias("entityName"),
                             units.alias("units")))
    return o.select(F.col("o_orderkey"), F.col("o_custkey"), tag.alias("tag"), F.when(~absent, doc).alias("payload_json"),
                    F.when(absent, 404).otherwise(200).alias("http_status"), d.alias("logical_date"))


def land_concepts(spark: SparkSession, sf_dir: str) -> str:
    """Land the concept documents that were reported (a 404 has no payload and no envelope), one capture a year."""
    from factlake.functions import keys as K
    from factlake.sinks.landing import write_stream
    from factlake.sources.landing import build_envelope

    docs = concept_documents(spark, sf_dir).where("http_status = 200")
    cik, day = K.pad_cik("o_custkey"), F.to_date(F.trunc("logical_date", "year"))
    env = build_envelope(docs, "company_concept", day, F.concat(cik, F.lit("/"), "tag"),
                         K.concept_url("o_custkey", F.col("tag")), F.col("payload_json"),
                         F.concat(day.cast("string"), F.lit("T06:00:00.000000Z")))
    root = scratch_dir(spark, "landing")
    write_stream(env, root, "company_concept")
    return root


def submissions_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """company_submissions payloads, one per order: unsorted tickers, a former name,
    and ``filings.recent`` as two parallel arrays of length 2."""
    o = B.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    cik = F.format_string("%010d", F.col("o_custkey"))
    a1 = F.format_string("%010d-%02d-%06d", F.col("o_custkey"), F.year(d) % 100, F.col("o_orderkey") % 1000000)
    a2 = F.format_string("%010d-%02d-%06d", F.col("o_custkey"), (F.year(d) + 1) % 100, F.col("o_orderkey") % 1000000)
    recent = F.struct(
        F.array(a1, a2).alias("accessionNumber"),
        F.array(d.cast("string"), F.date_add(d, 1).cast("string")).alias("filingDate"),
        F.array(F.lit("10-K"), F.lit("10-K/A")).alias("form"),
        F.array(F.format_string("d%d.htm", F.col("o_orderkey")), F.lit(None).cast("string")).alias("primaryDocument"))
    doc = F.to_json(F.struct(
        cik.alias("cik"), F.lit("operating").alias("entityType"), F.col("o_orderstatus").alias("sic"),
        F.col("o_orderpriority").alias("sicDescription"), F.format_string("Company %d", F.col("o_custkey")).alias("name"),
        F.lit("1231").alias("fiscalYearEnd"),
        F.array(F.concat(F.lit("T"), F.col("o_orderstatus")), F.lit("A"), F.lit("Z")).alias("tickers"),
        F.array(F.lit("NYSE"), F.lit("NASDAQ")).alias("exchanges"),
        F.array(F.struct(F.format_string("Old %d", F.col("o_custkey")).alias("name"),
                         F.lit("1990-01-01").alias("from"), F.lit("1994-12-31").alias("to"))).alias("formerNames"),
        F.struct(recent.alias("recent"), F.array().cast("array<struct<name:string>>").alias("files")).alias("filings")))
    return o.select("o_orderkey", doc.alias("payload_json"), d.alias("logical_date"))


def write_universe_files(spark: SparkSession, sf_dir: str) -> str:
    """JSON lists of companies, one file a nation and 1,000 keys: objects, numbers or padded strings by nation; a company
    with a negative balance is listed twice."""
    from factlake.functions import keys as K

    c = B.table(spark, sf_dir, "customer").select(
        "c_nationkey", F.floor(F.col("c_custkey") / 1000).alias("thousand"), "c_custkey",
        F.when(F.col("c_nationkey") % 3 == 0, F.to_json(F.struct(F.col("c_custkey").alias("cik"), F.col("c_name").alias("name"))))
        .when(F.col("c_nationkey") % 3 == 1, F.col("c_custkey").cast("string"))
        .otherwise(F.concat(F.lit('"'), K.pad_cik("c_custkey"), F.lit('"'))).alias("item"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("c_acctbal") < 0, 2).otherwise(1))).alias("_nth"))
    lists = c.groupBy("c_nationkey", "thousand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "_nth", "item"))), lambda x: x["item"]), ", ").alias("items"))
    path = scratch_dir(spark, "universe")
    lists.select("c_nationkey", "thousand", F.concat(F.lit("["), "items", F.lit("]")).alias("value")).write.partitionBy("c_nationkey", "thousand").text(path)
    return path


def write_drifting_payloads(spark: SparkSession, sf_dir: str) -> str:
    """logical_date and payload_json of index rows whose layout drifts with the events: clicks above 100 carry cik as a number, views
    above 100 lack file_name, purchases above 100 hold a null company_name, errors add an object and a key, signups above 200 are cut."""
    rows = B.index_rows_from_events(B.table(spark, sf_dir, "events"), extra=("event_type", "props", "value"))
    names = [f.name for f in C.INDEX_PAYLOAD.fields]

    def payload(*drop: str, **other) -> Column:
        return F.to_json(F.struct(*[other.get(n, F.col(n)).alias(n) for n in names if n not in drop], *[c.alias(n) for n, c in other.items() if n not in names]),
                         {"ignoreNullFields": "false"})
    kind, high = F.col("event_type"), F.col("value") > 100
    text = (F.when((kind == "click") & high, payload(cik=F.col("cik").cast("bigint")))
            .when((kind == "view") & high, payload("file_name"))
            .when((kind == "purchase") & high, payload(company_name=F.lit(None).cast("string")))
            .when(kind == "error", payload(props=F.from_json("props", "struct<k:bigint>"), severity=F.lit("high")))
            .when((kind == "signup") & (F.col("value") > 200), F.substring(payload(), 1, 20))
            .otherwise(payload()))
    path = scratch_dir(spark, "drifting")
    rows.select("logical_date", text.alias("payload_json")).write.json(path)
    return path
