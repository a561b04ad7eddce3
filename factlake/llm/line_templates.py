"""Line dedup by a log-template tree (DataFrame functions only).

Lines are parsed in a tree of fixed depth: the token count, then the first ``LEAD`` tokens, where
tokens with a digit or ``@`` (ids, dates, addresses) stand as the field ``<*>``.  At the leaf the rest
of the line, split in two halves, is generalised: a line's template is the first of

* all its masked tokens,
* its leading tokens and the first half, the second half one open field,
* its leading tokens and the second half, the first half one open field,

that recurs in at least ``MIN_DOCS`` documents (half templates need ``MIN_HALF`` tokens
or more).  Whole-document copies count once, so copied documents do not recur by
themselves.  Of a recurring template the first line (by doc_id, then content, then line number) stays and
the others are dropped; lines of fewer than ``MIN_TOKENS`` tokens have no template.

Each template key is counted by two pre-aggregated steps and joined back to the lines that
carry it; rows are hashes, never texts.  Hot templates are split by the partial aggregation and, in the
join back, by the adaptive skew join.

Defined results: null text stays null, with no lines; empty lines stay.  Repeated rows (same doc_id
and text) are judged alike.  A null doc_id sorts first.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake.llm.common import written

LEAD = 3
MIN_TOKENS = 4
MIN_HALF = 4
MIN_DOCS = 10
SPACES = " \t\x0b\x0c\r"


def masked_tokens(line: Column) -> Column:
    """Tokens of a line, variable fields masked (the slow replacement only where there is one)."""
    trimmed = F.btrim(line, F.lit(SPACES))
    masked = F.when(trimmed.rlike("[0-9@]"), F.regexp_replace(trimmed, r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*", "<*>")).otherwise(trimmed)
    return F.split(masked, r"[\x20\x09-\x0D]+")


def template_keys(tokens: Column) -> Column:
    """(form, hash) of the candidate templates that apply, most specific first."""
    n = F.size(tokens)
    half = F.floor((n - LEAD) / 2).cast("int")
    key = lambda form, *parts: F.struct(F.lit(form).alias("form"), F.xxhash64(F.lit(form), n, *[F.array_join(p, " ") for p in parts]).alias("key"))
    lead = F.slice(tokens, 1, LEAD)
    long_enough = half >= MIN_HALF
    return F.array_compact(F.array(
        F.when(n >= MIN_TOKENS, key(0, tokens)),
        F.when(long_enough, key(1, lead, F.slice(tokens, LEAD + 1, half))),
        F.when(long_enough, key(2, lead, F.slice(tokens, F.lit(LEAD + 1) + half, n - LEAD - half)))))


def _lines(docs: DataFrame) -> DataFrame:
    """k_id, k_text (a document's identity), pos, form, key: the candidate templates of every line, written once."""
    parsed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))).alias("k_id"), F.xxhash64("text").alias("k_text"),
                         F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = parsed.select("k_id", "k_text", "pos", masked_tokens(F.col("line")).alias("tokens"))
    keyed = keyed.select("k_id", "k_text", "pos", F.explode(template_keys(F.col("tokens"))).alias("t"))
    return written(keyed.select("k_id", "k_text", "pos", "t.form", "t.key"), "line-templates")


def recurring(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Template keys held by at least ``min_docs`` distinct documents."""
    return lines.groupBy("key", "k_text").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs).select("key")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k_id, k_text, gone): positions of the lines to drop, per document."""
    lines = _lines(docs)
    keys = recurring(lines, min_docs)
    best = lines.join(keys, "key").groupBy("k_id", "k_text", "pos").agg(F.min(F.struct("form", "key")).alias("t"))
    best = best.select("k_id", "k_text", "pos", F.col("t.key").alias("key"))
    first = best.groupBy("key").agg(F.min(F.struct("k_id", "k_text", "pos")).alias("keep"))
    rest = best.join(first, "key").filter(~((F.col("k_id") == F.col("keep.k_id")) & (F.col("k_text") == F.col("keep.k_text")) & (F.col("pos") == F.col("keep.pos"))))
    return rest.groupBy("k_id", "k_text").agg(F.collect_set("pos").alias("gone"))


def _marked(docs: DataFrame, min_docs: int) -> DataFrame:
    keyed = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("__row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))).alias("k_id"), F.xxhash64("text").alias("k_text"))
    return keyed.join(dropped_lines(docs.select("doc_id", "text"), min_docs), ["k_id", "k_text"], "left")


def _kept_text(text: Column, gone: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(gone, i))
    return F.when(gone.isNull(), text).otherwise(F.array_join(lines, "\n"))


def deduplicated(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with recurring lines cut from ``text``; every row stays."""
    marked = _marked(docs, min_docs)
    return marked.select(*[_kept_text(F.col("text"), F.col("gone")).alias("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: n_lines, n_dropped, sha-256 of what is left."""
    marked = _marked(docs.select("doc_id", "text"), min_docs)
    return marked.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
                         F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
                         F.sha2(F.coalesce(_kept_text(F.col("text"), F.col("gone")), F.lit("")), 256).alias("kept_sha256"))


def oracle_ctes(source: str, min_docs: int = MIN_DOCS) -> str:
    """The same dedup in SQL over ``source`` (columns doc_id, text): CTEs ending in ``ld_text``."""
    return rf"""
ld_base AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {source}),
ld_line AS (SELECT rid, doc_id, text, pos, list_transform(regexp_split_to_array(regexp_replace(
      trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+'), lambda x: x) AS tk
  FROM (SELECT rid, doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM ld_base)),
ld_n AS (SELECT *, len(tk) AS n, (len(tk) - {LEAD}) // 2 AS half FROM ld_line WHERE len(tk) >= {MIN_TOKENS}),
ld_key AS (
  SELECT rid, doc_id, text, pos, 0 AS form, 'full ' || n || ' ' || array_to_string(tk, ' ') AS k FROM ld_n
  UNION ALL SELECT rid, doc_id, text, pos, 1, 'first ' || n || ' ' || array_to_string(tk[1:{LEAD}], ' ') || chr(10) || array_to_string(tk[{LEAD}+1:{LEAD}+half], ' ') FROM ld_n WHERE half >= {MIN_HALF}
  UNION ALL SELECT rid, doc_id, text, pos, 2, 'second ' || n || ' ' || array_to_string(tk[1:{LEAD}], ' ') || chr(10) || array_to_string(tk[{LEAD}+half+1:n], ' ') FROM ld_n WHERE half >= {MIN_HALF}),
ld_rec AS (SELECT k FROM ld_key GROUP BY k HAVING count(DISTINCT text) >= {min_docs}),
ld_best AS (SELECT rid, doc_id, text, pos, k, row_number() OVER (PARTITION BY rid, pos ORDER BY form) AS r FROM ld_key JOIN ld_rec USING (k)),
ld_rank AS (SELECT rid, pos, rank() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, pos) AS seen FROM ld_best WHERE r = 1),
ld_gone AS (SELECT rid, list(pos) AS gone FROM ld_rank WHERE seen > 1 GROUP BY rid),
ld_text AS (SELECT rid, doc_id, string_split(text, chr(10)) AS ls, coalesce(gone, []) AS gone,
    coalesce(array_to_string(list_transform(list_filter(list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10))))), lambda x: NOT list_contains(coalesce(gone, []), x[2])), lambda x: x[1]), chr(10)), '') AS kept_text
  FROM ld_base LEFT JOIN ld_gone USING (rid))"""


ORACLE = f"WITH {oracle_ctes('documents')} SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, len(gone)::BIGINT AS n_dropped, sha256(kept_text) AS kept_sha256 FROM ld_text"
