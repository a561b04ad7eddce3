"""Fixed-width daily index files: header validation, row slicing, whole-file poisoning.

Each file is read whole (``wholetext``): one row per file, one task per file,
files in parallel.  Header validation and the per-row structural checks are
higher-order array expressions on that row (``transform`` / ``filter`` over the
file's lines), so deciding that one bad row invalidates the whole file needs
no aggregation, join or shuffle.  Only valid files are exploded into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake import contracts as C

LINE_SPLIT = r"\r\n|\r|\n"
_WIDE = 1 << 30


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def field(line: Column, start: int, end: int | None) -> Column:
    """0-based [start:end) slice, padding stripped."""
    return strip(F.substring(line, start + 1, (end - start) if end is not None else _WIDE))


def _slices(line: Column) -> dict[str, Column]:
    return {name: field(line, s, e) for name, s, e in C.INDEX_COLUMNS}


def row_problem(line: Column) -> Column:
    """NULL when the row is structurally sound, else the failed check."""
    f = _slices(line)
    return (F.when(~f["cik"].rlike(r"^\d+$"), F.lit("cik_not_numeric"))
            .when(~f["date_filed"].rlike(r"^\d{8}$"), F.lit("date_not_yyyymmdd"))
            .when(~f["file_name"].rlike(C.ACCESSION_IN_PATH_PATTERN), F.lit("file_name_without_accession")))


def read_index_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) per index file; partition columns under ``path`` are kept."""
    df = spark.read.text(path, wholetext=True)
    return df.withColumn("file", F.col("_metadata.file_path")).withColumnRenamed("value", "text")


def validate_files(files: DataFrame) -> DataFrame:
    """Per file: separator line, header check, first bad row, and the verdict.

    ``reason`` is one of ok, no_separator, header_mismatch, cik_not_numeric,
    date_not_yyyymmdd, file_name_without_accession; ``first_bad_line`` is 1-based.
    """
    lines = F.split(F.col("text"), LINE_SPLIT)
    d = files.withColumn("_lines", lines)
    head = F.slice(F.col("_lines"), 1, C.INDEX_HEADER_SCAN_LINES)
    seps = F.filter(F.transform(head, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                    lambda s: s["x"].rlike(C.INDEX_SEPARATOR_PATTERN))
    d = d.withColumn("_sep", F.get(seps, 0)["i"])  # 0-based index of the separator line
    header = F.regexp_replace(F.array_join(F.slice(F.col("_lines"), 1, F.coalesce(F.col("_sep"), F.lit(0))), " "),
                              r"\s+", " ")
    d = d.withColumn("_header_ok", F.trim(header).contains(C.INDEX_HEADER_TOKENS))
    body_start = F.col("_sep") + 2  # 1-based first data line
    body = F.slice(F.col("_lines"), body_start, F.greatest(F.size("_lines") - F.col("_sep") - 1, F.lit(0)))
    d = d.withColumn("_body", F.when(F.col("_sep").isNotNull(), body).otherwise(F.array()))
    checked = F.transform(F.col("_body"), lambda x, j: F.struct(
        (j + body_start).alias("line_number"), x.alias("line"),
        F.when(strip(x) != "", row_problem(x)).alias("problem")))
    bad = F.get(F.filter(checked, lambda s: s["problem"].isNotNull()), 0)
    d = d.withColumn("_bad", F.when(F.col("_sep").isNotNull() & F.col("_header_ok"), bad))
    reason = (F.when(F.col("_sep").isNull(), F.lit("no_separator"))
              .when(~F.col("_header_ok"), F.lit("header_mismatch"))
              .when(F.col("_bad").isNotNull(), F.col("_bad")["problem"])
              .otherwise(F.lit("ok")))
    return d.withColumn("reason", reason).withColumn("is_valid", F.col("reason") == "ok") \
        .withColumn("first_bad_line", F.col("_bad")["line_number"]) \
        .withColumn("separator_line", F.col("_sep") + 1)


def parse_valid(validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of valid files only: the six raw string fields plus file and line number."""
    # Invalid files explode to nothing.  (A filter on the verdict would be pushed
    # below the projections and re-evaluate the per-file expressions per use.)
    body = F.when(F.col("is_valid"), F.col("_body")).otherwise(F.array())
    v = validated.select("file", *keep, "_sep", F.posexplode(body).alias("_j", "line"))
    v = v.where(strip(F.col("line")) != "")
    f = _slices(F.col("line"))
    return v.select(
        "file", *keep, (F.col("_j") + F.col("_sep") + 2).alias("line_number"),
        f["form_type"].alias("form_type"), f["company_name"].alias("company_name"), f["cik"].alias("cik"),
        f["date_filed"].alias("date_filed"), f["file_name"].alias("file_name"),
        F.regexp_extract(f["file_name"], C.ACCESSION_IN_PATH_PATTERN, 1).alias("accession_number"))


def file_report(validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    body_rows = F.size(F.filter(F.col("_body"), lambda x: strip(x) != ""))
    return validated.select(
        "file", *keep, "is_valid", "reason", "separator_line", "first_bad_line",
        F.when(F.col("is_valid"), body_rows).otherwise(F.lit(0)).cast("bigint").alias("row_count"))


class IndexFormatError(ValueError):
    """A daily index file whose layout changed; no row of it may be used."""


def require_valid(validated: DataFrame) -> None:
    """Strict mode: fail the run when any file is invalid, naming file, reason and line."""
    bad = validated.where(~F.col("is_valid")).select("file", "reason", "first_bad_line").limit(1).collect()
    if bad:
        b = bad[0]
        where = f" at line {b.first_bad_line}" if b.first_bad_line is not None else ""
        raise IndexFormatError(f"{b.file}: {b.reason}{where}")
