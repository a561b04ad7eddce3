"""Column expressions for identities: padded keys, batch ids, paths, hashes.

Everything here returns a ``Column`` built from built-in functions, so it runs
inside whole-stage codegen; nothing performs I/O.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factlake import contracts as C


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pad_cik(x: Column | str) -> Column:
    """Zero-pad to 10 characters; longer values are left alone (``lpad`` would truncate)."""
    s = F.trim(_c(x).cast("string"))
    return F.when(F.length(s) < 10, F.lpad(s, 10, "0")).otherwise(s)


def batch_id(stream: Column | str, logical_date: Column | str) -> Column:
    """``stream-yyyymmdd-<first 12 hex of sha256(stream|yyyy-mm-dd)>``."""
    st, d = _c(stream), F.to_date(_c(logical_date))
    return F.concat_ws(
        "-", st, F.date_format(d, "yyyyMMdd"),
        F.substring(F.sha2(F.concat_ws("|", st, d.cast("string")), 256), 1, 12),
    )


def landing_path(prefix: Column | str, stream: Column | str, logical_date: Column | str) -> Column:
    """``{prefix}/edgar/{stream}/logical_date={d}/{batch_id}.json.gz``."""
    d = F.to_date(_c(logical_date)).cast("string")
    return F.concat(
        F.regexp_replace(_c(prefix), "/+$", ""), F.lit("/edgar/"), _c(stream),
        F.lit("/logical_date="), d, F.lit("/"), batch_id(stream, logical_date), F.lit(".json.gz"),
    )


def reroot(path: Column | str, prefix: str) -> Column:
    """Strip a landing prefix so the same object can be placed under another root."""
    return F.regexp_replace(_c(path), "^" + prefix.replace(".", "\\.").rstrip("/"), "")


def utc_timestamp(text: Column | str) -> Column:
    """A UTC instant from 'yyyy-MM-dd[ HH:mm:ss]' wall-clock text, whatever the session time zone."""
    t = F.regexp_replace(_c(text).cast("string"), " ", "T")
    t = F.when(F.length(t) <= 10, F.concat(t, F.lit("T00:00:00"))).otherwise(t)
    return F.to_timestamp(F.concat(t, F.lit("Z")))


def content_hash(payload_json: Column | str) -> Column:
    return F.sha2(_c(payload_json), 256)


def canonical_json(struct_col: Column) -> Column:
    """Canonical JSON of an engine-built struct: keys sorted, tight separators, nulls kept.

    Spark writes fields in struct order with no whitespace; sorting the fields
    by name first gives the canonical key order.
    """
    return F.to_json(struct_col, {"ignoreNullFields": "false"})


def sorted_struct(**cols: Column) -> Column:
    return F.struct(*[cols[k].alias(k) for k in sorted(cols)])


def canonicalize_document(json_text: Column | str) -> Column:
    """Re-serialise an arbitrary JSON document with sorted keys (VARIANT sorts object keys)."""
    return F.to_json(F.try_parse_json(_c(json_text)))


def array_text(arr: Column | str) -> Column:
    """Sorted, comma-joined array (nulls inside the array dropped)."""
    return F.coalesce(F.concat_ws(",", F.sort_array(_c(arr))), F.lit(""))


def hash_diff(*tracked: Column | str, arrays: tuple[str, ...] = ()) -> Column:
    """sha256 over tracked columns, ``|``-delimited, arrays sorted first.

    ``concat_ws`` drops nulls silently, so every part is coalesced to ''.
    """
    parts = []
    for t in tracked:
        name = t if isinstance(t, str) else None
        if name is not None and name in arrays:
            parts.append(array_text(name))
        else:
            parts.append(F.coalesce(_c(t).cast("string"), F.lit("")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def accession_from_parts(a: Column, b: Column, c: Column) -> Column:
    return F.format_string("%010d-%02d-%06d", a, b, c)


def accession_from_path(file_name: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(file_name), C.ACCESSION_IN_PATH_PATTERN, 1), F.lit(""))


def daily_index_url(d: Column | str) -> Column:
    dd = F.to_date(_c(d))
    return F.format_string(
        "https://www.sec.gov/Archives/edgar/daily-index/%d/QTR%d/form.%s.idx",
        F.year(dd), F.quarter(dd), F.date_format(dd, "yyyyMMdd"))


def submissions_url(cik: Column | str) -> Column:
    return F.format_string("https://data.sec.gov/submissions/CIK%s.json", pad_cik(cik))


def concept_url(cik: Column | str, concept: Column | str, taxonomy: str = C.TAXONOMY) -> Column:
    return F.format_string("https://data.sec.gov/api/xbrl/companyconcept/CIK%s/%s/%s.json",
                           pad_cik(cik), F.lit(taxonomy), _c(concept))


def primary_doc_url(file_name: Column | str) -> Column:
    return F.concat(F.lit(C.ARCHIVES_BASE), _c(file_name))
