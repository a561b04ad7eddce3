"""Gold marts: restatement events, latest facts, filing activity, company profile.

Restatements and the latest view share one ordered pass over the facts: the
window (shuffle on the fact key) attaches the previous assertion, events are a
filter of it, and the latest view is a second window on the same partitioning
and order (no second shuffle or sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.operators.sequence import HOT_FLAG, hot_keys, ordered_lag
from factlake.plans.bindings import RUN_ID, generated_at

FACT_KEY = list(C.FACT_KEY)
FACT_ORDER = ["filed_date", "accession_number", "_tag_pref", "value"]
CARRY = ["accession_number", "filed_date", "value", "decimals", "form_type"]


def with_canonical_key(facts: DataFrame) -> DataFrame:
    """Unmapped concepts keep their as-filed tag as the gold key (else they vanish)."""
    return facts.withColumn("concept_canonical", F.coalesce(F.col("concept_canonical"), F.col("concept_tag")))


def restatement_condition(value: Column, prev: Column, dec: Column, prev_dec: Column) -> Column:
    """Relative tolerance, never ``!=``; rounding-only differences are not events."""
    delta = F.abs(F.try_subtract(value, prev))
    tol = F.greatest(F.abs(prev) * F.lit(C.RESTATEMENT_REL_TOL), F.lit(C.RESTATEMENT_ABS_TOL))
    d = F.least(dec, prev_dec)
    scale = F.pow(F.lit(10.0), d)
    rounding_only = d.isNotNull() & (
        F.round(value.cast("double") * scale) == F.round(prev.cast("double") * scale))
    return prev.isNotNull() & (delta > tol) & ~F.coalesce(rounding_only, F.lit(False))


def tag_preference(tag: Column) -> Column:
    """Rank of an as-filed tag among those mapped to one canonical concept (map order)."""
    ranks = F.create_map(*[x for i, (t, _) in enumerate(C.CONCEPT_MAP) for x in (F.lit(t), F.lit(i))])
    return F.coalesce(F.try_element_at(ranks, tag), F.lit(len(C.CONCEPT_MAP)))


def fact_sequence(facts: DataFrame) -> DataFrame:
    """Valid facts with the previous assertion of the same fact attached and an event flag.

    One ordered pass per fact key, ordered by (filed_date, accession, tag
    preference, value): a row whose predecessor comes from the same accession
    is a second tag (or copy) of one assertion and is dropped, keeping the
    preferred tag, so a tag switch inside one filing is never a restatement.
    The second lag runs on the same partitioning and order (no new exchange
    or sort), and so does the latest view built on top of it.
    """
    f = with_canonical_key(facts.where(F.col("value").isNotNull()))
    extra = [c for c in ("concept_tag", "fiscal_year", "fiscal_period") if c in f.columns]
    pref = tag_preference(F.col("concept_tag")) if "concept_tag" in f.columns else F.lit(0)
    f = f.select(*FACT_KEY, *CARRY, *extra, pref.alias("_tag_pref"))
    hot = hot_keys(f, FACT_KEY)
    d = ordered_lag(f, FACT_KEY, FACT_ORDER, ["accession_number"], prefix="_same_", hot=hot)
    d = d.where(~F.col("_same_accession_number").eqNullSafe(F.col("accession_number"))) \
        .drop("_same_accession_number")
    seq = ordered_lag(d, FACT_KEY, FACT_ORDER, CARRY, hot=hot)
    return seq.withColumn(
        "is_restatement",
        restatement_condition(F.col("value"), F.col("prev_value"), F.col("decimals"), F.col("prev_decimals")))


def materiality_band(delta_pct: Column) -> Column:
    a = F.abs(delta_pct)
    return (F.when(delta_pct.isNull(), F.lit("material"))
            .when(a < F.lit(C.BAND_IMMATERIAL_BELOW), F.lit("immaterial"))
            .when(a <= F.lit(C.BAND_NOTABLE_UP_TO), F.lit("notable"))
            .otherwise(F.lit("material")))


def restatement_id(prev_acc: Column, acc: Column) -> Column:
    return F.sha2(F.concat_ws(
        "|", F.col("cik"), F.col("concept_canonical"), F.col("unit"),
        F.coalesce(F.col("period_start").cast("string"), F.lit("")), F.col("period_end").cast("string"),
        F.col("period_type"), prev_acc, acc), 256)


def _with_company(df: DataFrame, companies: DataFrame | None) -> DataFrame:
    if companies is None:
        return df.withColumn("company_name", F.lit(None).cast("string"))
    # companies holds one current row per cik; AQE broadcasts it at runtime when small.
    return df.join(companies.select("cik", "company_name"), "cik", "left")


def restatement_events(facts: DataFrame, companies: DataFrame | None = None,
                       sequence: DataFrame | None = None, run_id: str = RUN_ID) -> DataFrame:
    seq = sequence if sequence is not None else fact_sequence(facts)
    ev = seq.where("is_restatement")
    delta = F.try_subtract(F.col("value"), F.col("prev_value"))
    orig = F.col("prev_value").cast("double")
    pct = F.when(orig == 0, F.lit(None).cast("double")).otherwise(delta.cast("double") / orig)
    ev = ev.select(
        restatement_id(F.col("prev_accession_number"), F.col("accession_number")).alias("restatement_id"),
        *FACT_KEY,
        F.col("prev_accession_number").alias("original_accession_number"),
        F.col("prev_form_type").alias("original_form_type"),
        F.col("prev_filed_date").alias("original_filed_date"),
        F.col("prev_value").alias("original_value"),
        F.col("prev_decimals").alias("original_decimals"),
        F.col("accession_number").alias("restated_accession_number"),
        F.col("form_type").alias("restated_form_type"),
        F.col("filed_date").alias("restated_filed_date"),
        F.col("value").alias("restated_value"),
        F.col("decimals").alias("restated_decimals"),
        delta.alias("delta_abs"),
        pct.alias("delta_pct"),
        materiality_band(pct).alias("materiality_band"),
        F.datediff(F.col("filed_date"), F.col("prev_filed_date")).alias("days_to_restatement"),
    )
    ev = _with_company(ev, companies)
    cols = [f.name for f in C.TABLES["gold.restatement_event"].fields if not f.name.startswith("_")]
    return ev.select(*cols, generated_at().alias("_generated_at"), F.lit(run_id).alias("_run_id"))


def with_standing(sequence: DataFrame) -> DataFrame:
    """``fact_sequence`` with ``_next`` (NULL on a key's last row), ``assertion_count`` and ``was_restated`` of ordinary keys.

    Taken on the sequence before it is written they cost no shuffle or sort; rows of hot keys have NULLs."""
    w = Window.partitionBy(*FACT_KEY).orderBy(*[F.col(c) for c in FACT_ORDER])
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cold = sequence.where(~F.col(HOT_FLAG)).select(
        "*", F.lead(F.lit(1)).over(w).alias("_next"),
        F.count(F.lit(1)).over(whole).cast("int").alias("assertion_count"),
        F.max(F.col("is_restatement")).over(whole).alias("was_restated"))
    hot = sequence.where(F.col(HOT_FLAG)).select("*", F.lit(None).cast("int").alias("_next"), F.lit(None).cast("int").alias("assertion_count"),
                                                 F.lit(None).cast("boolean").alias("was_restated"))
    return cold.unionByName(hot)


def financials_current(facts: DataFrame, companies: DataFrame | None = None,
                       sequence: DataFrame | None = None, run_id: str = RUN_ID) -> DataFrame:
    """Latest assertion per fact key (greatest filed_date, then accession), with
    assertion_count and whether the key ever saw a restatement.

    Ordinary keys are finished inside the ordered pass that found restatements:
    on the same partitioning and order, ``lead`` marks each key's last row and
    unbounded-frame aggregates give the count and the restated flag, so no
    aggregation or re-sort follows.  Rows of hot keys (spread over many tasks)
    are reduced by a keyed aggregate with partial combine instead.
    """
    seq = sequence if sequence is not None else fact_sequence(facts)
    if "_next" not in seq.columns:
        seq = with_standing(seq)
    payload = ["value", "decimals", "fiscal_year", "fiscal_period", "accession_number", "form_type", "filed_date"]
    cold = seq.where(~F.col(HOT_FLAG) & F.col("_next").isNull()).select(*FACT_KEY, *payload, "assertion_count", "was_restated")
    latest = F.max_by(F.struct(*payload), F.struct(*[F.col(c) for c in FACT_ORDER]))
    hot = (seq.where(F.col(HOT_FLAG)).groupBy(*FACT_KEY)
           .agg(latest.alias("l"), F.count(F.lit(1)).cast("int").alias("assertion_count"),
                F.max(F.col("is_restatement")).alias("was_restated"))
           .select(*FACT_KEY, *[F.col(f"l.{c}").alias(c) for c in payload], "assertion_count", "was_restated"))
    g = _with_company(cold.unionByName(hot), companies)
    cols = [f.name for f in C.TABLES["gold.financials_current"].fields if not f.name.startswith("_")]
    return g.select(*cols, generated_at().alias("_generated_at"), F.lit(run_id).alias("_run_id"))


def filing_activity_daily(filings: DataFrame, run_id: str = RUN_ID, approximate: bool = False,
                          all_filers: DataFrame | None = None) -> DataFrame:
    """Per (filed_date, base_form_type): filings, amendments, distinct filers.

    silver.filing keeps one row per accession, so co-registrants sharing an
    accession count once.  Pass the typed rows before that de-duplication as
    ``all_filers`` to count every filer of a shared accession instead.
    """
    distinct = (F.approx_count_distinct("cik") if approximate else F.countDistinct("cik"))
    g = filings.groupBy("filed_date", "base_form_type").agg(
        F.count(F.lit(1)).cast("int").alias("filing_count"),
        F.count_if(F.col("is_amendment")).cast("int").alias("amendment_count"),
        *([] if all_filers is not None else [distinct.cast("int").alias("distinct_cik_count")]))
    if all_filers is not None:
        d = all_filers.groupBy("filed_date", "base_form_type").agg(distinct.cast("int").alias("distinct_cik_count"))
        g = g.join(d, ["filed_date", "base_form_type"], "left")
    return g.select("filed_date", "base_form_type", "filing_count", "amendment_count", "distinct_cik_count",
                    generated_at().alias("_generated_at"), F.lit(run_id).alias("_run_id"))


SKETCH_LG_K = 14       # 2^14 registers: a standard error of about 0.8 %
SKETCH_BOUND = 0.05    # what users of the estimate may rely on (six standard errors)


def activity_sketches(filings: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per (filed_date, base_form_type): filings, amendments and a mergeable sketch of the filers.

    Distinct counts of days cannot be added up, sketches can be united: a row a day and form is stored
    once and answers any span without its filings."""
    return filings.groupBy("filed_date", "base_form_type").agg(
        F.count(F.lit(1)).alias("filing_count"), F.count_if(F.col("is_amendment")).alias("amendment_count"),
        F.hll_sketch_agg("cik", lg_k).alias("filers_sketch"))


def activity_of_span(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """The stored days united over the span ``by`` stands for: counts are added, ``distinct_cik_estimate`` comes from the
    united sketch (within ``SKETCH_BOUND`` of the exact count)."""
    return sketches.groupBy(*by).agg(
        F.sum("filing_count").alias("filing_count"), F.sum("amendment_count").alias("amendment_count"),
        F.hll_sketch_estimate(F.hll_union_agg("filers_sketch")).alias("distinct_cik_estimate"))


def company_profile(companies: DataFrame, filings: DataFrame, events: DataFrame,
                    run_id: str = RUN_ID) -> DataFrame:
    """One row per company: attributes, filing span and count, restatement count (zero-filled).

    Both sides are pre-aggregated by cik (partial aggregation absorbs hot filers)
    before the joins, so each join is one row per cik on each side.
    """
    fa = filings.groupBy("cik").agg(
        F.count(F.lit(1)).alias("filing_count"),
        F.min("filed_date").alias("first_filed_date"),
        F.max("filed_date").alias("last_filed_date"))
    ra = events.groupBy("cik").agg(F.count(F.lit(1)).alias("restatement_count"))
    p = companies.join(fa, "cik", "left").join(ra, "cik", "left")
    return p.select(
        "cik", "company_name", "sic", "sic_description", "entity_type", "state_of_incorporation",
        "fiscal_year_end", "tickers", "exchanges",
        F.coalesce(F.col("filing_count"), F.lit(0)).cast("int").alias("filing_count"),
        "first_filed_date", "last_filed_date",
        F.coalesce(F.col("restatement_count"), F.lit(0)).cast("int").alias("restatement_count"),
        generated_at().alias("_generated_at"), F.lit(run_id).alias("_run_id"))
