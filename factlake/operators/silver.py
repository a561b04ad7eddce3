"""Silver typing: filings from index rows, companies from submissions documents,
facts from concept documents.  All projections and generators (explode, inline)
are narrow; only keyed de-duplication shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.functions import keys as K
from factlake.plans.bindings import concept_canonical


PROVENANCE = ("_ingest_batch_id", "_source_file")


def _carried(df: DataFrame, *more: str) -> list[Column]:
    """Provenance and rescued payload keys of the bronze row, where it has them."""
    return [F.col(c) for c in (*more, *PROVENANCE, "_rescued_data") if c in df.columns]


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the contract's columns, in its order; a missing column or another type is an error."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in C.TABLES[table].fields}
    wrong = [f"{n} is {have.get(n, 'missing')}, not {t}" for n, t in want.items() if have.get(n) != t]
    if wrong:
        raise ValueError(f"{table} breaks its contract: {'; '.join(wrong)}")
    return df.select(*want)


def base_form_type(form_type: Column) -> Column:
    return F.regexp_replace(F.upper(form_type), "/A$", "")


def type_filings(index_rows: DataFrame) -> DataFrame:
    """Bronze filing-index rows (strings) -> typed silver.filing business columns."""
    acc = F.coalesce(F.col("accession_number"), K.accession_from_path("file_name"))
    return index_rows.select(
        acc.alias("accession_number"),
        K.pad_cik("cik").alias("cik"),
        F.col("company_name"),
        F.col("form_type"),
        base_form_type(F.col("form_type")).alias("base_form_type"),
        F.col("form_type").endswith("/A").alias("is_amendment"),
        F.try_to_date(F.col("date_filed"), "yyyyMMdd").alias("filed_date"),
        K.primary_doc_url("file_name").alias("primary_doc_url"),
        F.col("logical_date"),
        *_carried(index_rows),
    )


def dedupe_filings(filings: DataFrame) -> DataFrame:
    """One row per accession (the silver key); co-registrants sharing an accession
    resolve deterministically to the lowest cik."""
    cols = [c for c in filings.columns if c != "accession_number"]
    return (filings.groupBy("accession_number")
            .agg(F.min_by(F.struct(*cols), F.struct("cik", "logical_date", "form_type")).alias("r"))
            .select("accession_number", "r.*"))


def company_from_submissions(docs: DataFrame, payload_col: str = "payload_json") -> DataFrame:
    """One company row per submissions document; arrays sorted ascending."""
    p = F.from_json(F.col(payload_col), C.SUBMISSIONS_PAYLOAD)
    d = docs.withColumn("_p", p)
    return d.select(
        K.pad_cik(F.coalesce(F.col("_p.cik"), F.col("cik") if "cik" in docs.columns else F.lit(None)))
        .alias("cik"),
        F.col("_p.name").alias("company_name"),
        F.col("_p.sic").alias("sic"),
        F.col("_p.sicDescription").alias("sic_description"),
        F.col("_p.ein").alias("ein"),
        F.col("_p.entityType").alias("entity_type"),
        F.col("_p.stateOfIncorporation").alias("state_of_incorporation"),
        F.col("_p.fiscalYearEnd").alias("fiscal_year_end"),
        F.sort_array(F.col("_p.tickers")).alias("tickers"),
        F.sort_array(F.col("_p.exchanges")).alias("exchanges"),
        F.transform(F.col("_p.formerNames"), lambda x: x["name"]).alias("former_names"),
        F.col("logical_date"),
        *_carried(docs, "fetched_at"),
    )


def submission_filings(docs: DataFrame, payload_col: str = "payload_json") -> DataFrame:
    """``filings.recent`` is a struct of parallel arrays: zip and inline them to rows."""
    r = F.from_json(F.col(payload_col), C.SUBMISSIONS_PAYLOAD)["filings"]["recent"]
    z = F.arrays_zip(r["accessionNumber"].alias("accession_number"), r["filingDate"].alias("filing_date"),
                     r["form"].alias("form_type"), r["primaryDocument"].alias("primary_document"))
    d = docs.select(K.pad_cik(F.from_json(F.col(payload_col), C.SUBMISSIONS_PAYLOAD)["cik"]).alias("cik"),
                    z.alias("_z"))
    return d.select("cik", F.inline_outer("_z")).where(F.col("accession_number").isNotNull())


def facts_from_concepts(docs: DataFrame, payload_col: str = "payload_json") -> DataFrame:
    """Concept documents -> one row per assertion (units map exploded, then the array).

    ``period_type`` is instant when ``start`` is absent.  Absent documents
    (HTTP 404 / null payload) yield no rows.
    """
    p = F.from_json(F.col(payload_col), C.CONCEPT_PAYLOAD)
    base = docs
    if "http_status" in docs.columns:
        base = base.where(F.col("http_status") == 200)
    d = base.select(p.alias("_p"), *_carried(docs, "logical_date"))
    # One generator over (unit, assertion) pairs: units map entries, each an array.
    pairs = F.flatten(F.transform(
        F.map_entries(F.col("_p.units")),
        lambda e: F.transform(e["value"], lambda f: F.struct(e["key"].alias("unit"), f.alias("f")))))
    a = d.select("*", F.explode(pairs).alias("_u")).select("*", F.col("_u.unit").alias("unit"),
                                                           F.col("_u.f").alias("_f"))
    tag = F.col("_p.tag")
    start = F.to_date(F.col("_f.start"))
    return a.select(
        K.pad_cik(F.col("_p.cik")).alias("cik"),
        F.coalesce(F.col("_p.taxonomy"), F.lit(C.TAXONOMY)).alias("taxonomy"),
        tag.alias("concept_tag"),
        concept_canonical(tag).alias("concept_canonical"),
        F.col("unit"),
        start.alias("period_start"),
        F.to_date(F.col("_f.end")).alias("period_end"),
        F.when(start.isNull(), F.lit("instant")).otherwise(F.lit("duration")).alias("period_type"),
        F.col("_f.accn").alias("accession_number"),
        F.col("_f.val").alias("value"),
        F.col("_f.decimals").alias("decimals"),
        F.col("_f.fy").alias("fiscal_year"),
        F.col("_f.fp").alias("fiscal_period"),
        F.col("_f.form").alias("form_type"),
        F.to_date(F.col("_f.filed")).alias("filed_date"),
        F.col("_f.frame").alias("frame"),
        *_carried(docs, "logical_date"),
    )


def flatten_submissions(docs: DataFrame, payload_col: str = "payload_json", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per recent filing with the company's attributes (document parsed once)."""
    d = docs.select(*keep, F.from_json(F.col(payload_col), C.SUBMISSIONS_PAYLOAD).alias("_p"))
    r = F.col("_p.filings.recent")
    z = F.arrays_zip(r["accessionNumber"].alias("accession_number"), r["filingDate"].alias("filing_date"),
                     r["form"].alias("form_type"), r["primaryDocument"].alias("primary_document"))
    return d.select(
        *keep, K.pad_cik(F.col("_p.cik")).alias("cik"), F.col("_p.name").alias("company_name"),
        F.col("_p.sic").alias("sic"), F.col("_p.sicDescription").alias("sic_description"),
        F.sort_array(F.col("_p.tickers")).alias("tickers"), F.sort_array(F.col("_p.exchanges")).alias("exchanges"),
        F.transform(F.col("_p.formerNames"), lambda x: x["name"]).alias("former_names"),
        F.inline_outer(z))
