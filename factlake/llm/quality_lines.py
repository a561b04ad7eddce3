"""Quality rules with cross-document line frequency (DataFrame functions only).

Base metrics and the hashes of the normalised lines (lower case, white space collapsed, digits as
0) are computed once inside each row and written with a row number; everything after that
reads narrow rows.  The distinct documents that hold a line are counted per host (``source``);
whole-document copies count once, so a copied document does not make its own lines look like
boilerplate.  A line of any length is above the limits, and is removed, when more than ``MIN_DOCS``
documents hold it and these are more than ``MAX_SHARE`` of the host's documents or more than
``ENOUGH_DOCS``: a large host does not raise the bar beyond that.  A document is depleted, and
rejected, when less than ``MIN_LEFT`` of its words remain.

Shuffles carry hashes and numbers only.  Counting is two aggregations, both pre-aggregated, so a
line that a third of all rows share is no hot task; the lines that meet the limits again are
salted.  ``filtered`` meets the texts in one join, by (doc_id, text hash, host).

Defined results: null and empty texts have no words, fail the base rules and are not kept.  A null
host is a host of its own.  Results depend on text and source only, so repeated rows repeat
their result.  Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake.llm.common import let, written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MIN_DOCS = 10
MAX_SHARE = 0.01
ENOUGH_DOCS = 100
MIN_LEFT = 0.2
SALTS = 16


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def words_of(text: Column) -> Column:
    """Words: maximal runs of characters other than ASCII white space."""
    return F.when(_trim(text) == "", F.array().cast("array<string>")).otherwise(F.split(_trim(text), r"[\x20\x09-\x0D]+"))


def repeat_words(words: Column) -> Column:
    """Words covered by windows of five words that occur twice or more in the text."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(win: Column) -> Column:
        by_hash = F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            flags = F.transform(s, lambda e, k: F.struct(
                e["i"].alias("i"),
                (F.coalesce(F.get(s, k - 1)["x"] == e["x"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False))).alias("d")))
            return F.sort_array(F.transform(F.filter(flags, lambda z: z["d"]), lambda z: z["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(let(by_hash, places), start, lambda a, i: F.struct(
            (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")), lambda a: a["n"])
    repeats = let(windows, lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(covered(win)))
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(repeats)


def normal_line(line: Column) -> Column:
    collapsed = F.regexp_replace(F.lower(_trim(line)), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")
    return F.translate(collapsed, "123456789", "0" * 9)


def _keys() -> list[Column]:
    """What a document's verdict depends on, and its doc_id: the key under which the texts meet it."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("__id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("__content"),
            F.coalesce(F.concat(F.lit("h:"), F.col("source").cast("string")), F.lit("")).alias("__host")]


def metrics(docs: DataFrame) -> DataFrame:
    """Narrow rows of ``docs``, written once: doc_id, a row number ``__rid``, the key, the base metrics and
    ``__lines``: (place, raw hash, normalised hash, words) of every line with a word."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def line(x: Column, i: Column) -> Column:
        return F.when(_trim(x) != "", F.struct(i.alias("i"), F.xxhash64(x).alias("raw"), F.xxhash64(normal_line(x)).alias("h"),
                                               F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")).alias("n")))
    parsed = docs.withColumn("__words", words_of(text)).withColumn("__lines", F.array_compact(F.transform(F.split(text, "\n", -1), line)))
    n_words = F.size("__words").cast("long")
    n_repeat = repeat_words(F.col("__words")).cast("long")
    measured = parsed.select(
        "doc_id", F.monotonically_increasing_id().alias("__rid"), *_keys(),
        n_words.alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct(F.col("__lines.raw")))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"), "__lines")
    return written(measured, "quality-docs").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def frequent_lines(measured: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, enough: int = ENOUGH_DOCS) -> DataFrame:
    """(host, h): normalised lines above the limits of their host."""
    per_doc = measured.select("__host", "__content", F.explode(F.array_distinct(F.col("__lines.h"))).alias("h"))
    counts = per_doc.groupBy("__host", "h", "__content").agg(F.lit(1).alias("one")).groupBy("__host", "h").agg(F.count("*").alias("docs"))
    hosts = measured.select("__host", "__content").groupBy("__host", "__content").agg(F.lit(1).alias("one")).groupBy("__host").agg(F.count("*").alias("all"))
    common = counts.filter(F.col("docs") > min_docs)
    return common.join(hosts, "__host").filter((F.col("docs") > max_share * F.col("all")) | (F.col("docs") > enough)).select("__host", "h")


def judged(measured: DataFrame) -> DataFrame:
    """__rid, the metrics, n_lines_removed, n_words_left, kept and the places ``__gone`` of the lines to remove (null: none)."""
    limits = written(frequent_lines(measured), "quality-limits").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lines = measured.select("__rid", "__host", F.pmod("__rid", F.lit(SALTS)).cast("int").alias("salt"), F.explode("__lines").alias("x"))
    gone = lines.select("__rid", "__host", "salt", "x.h", "x.i", "x.n").join(limits, ["__host", "h", "salt"])
    gone = gone.groupBy("__rid").agg(F.sum("n").alias("lost"), F.collect_list("i").alias("__gone"))
    out = measured.drop("__lines").join(gone, "__rid", "left")
    out = out.withColumn("n_words_left", F.col("n_words") - F.coalesce("lost", F.lit(0)))
    out = out.withColumn("n_lines_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
    return out.withColumn("kept", ~F.col("base_failed") & ~(F.col("n_words_left") < MIN_LEFT * F.col("n_words")))


def quality(docs: DataFrame) -> DataFrame:
    """Per document the metrics and the verdict."""
    return judged(metrics(docs.select("doc_id", "text", "source"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines_removed", "n_words_left")


def filtered(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents; frequent lines are cut from the texts that stay."""
    keys = ["__id", "__content", "__host"]
    # rows of one key have one verdict: any of them will do
    verdict = judged(metrics(docs.select("doc_id", "text", "source"))).filter("kept").groupBy(*keys).agg(F.first("__gone").alias("__gone"))
    rows = docs.select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias("__row"), *_keys())  # its names may clash
    out = rows.join(verdict, keys)
    kept = let(F.split("text", "\n", -1), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__gone")), lambda i: F.get(x, i)), "\n"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    return out.select(*[text.alias(c) if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns])


ORACLE = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce('h:' || source, '') AS host FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM base
), win AS (
  SELECT rid, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5)
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid
), ln AS (
  SELECT rid, host, t, n, regexp_replace(regexp_replace(lower(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g') AS h
  FROM (SELECT rid, host, t, l, len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n FROM (SELECT rid, host, t, unnest(ls) AS l FROM w))
), freq AS (
  SELECT host, h FROM (SELECT host, h, count(DISTINCT t) AS d FROM ln GROUP BY 1, 2)
  JOIN (SELECT host, count(DISTINCT t) AS a FROM base GROUP BY 1) USING (host) WHERE d > 10 AND (d > 0.01 * a OR d > 100)
), rest AS (
  SELECT rid, sum(CASE WHEN f.h IS NULL THEN n ELSE 0 END) AS lefts, count(f.h) AS gone
  FROM ln LEFT JOIN freq f USING (host, h) GROUP BY rid
), m AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(array_to_string(ws, '')), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         coalesce(rest.lefts, 0) AS n_words_left, coalesce(rest.gone, 0) AS n_lines_removed
  FROM w LEFT JOIN cov USING (rid) LEFT JOIN rest USING (rid)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT (n_words_left < 0.2 * n_words) AS kept,
       n_lines_removed::BIGINT AS n_lines_removed, n_words_left::BIGINT AS n_words_left
FROM b
"""
