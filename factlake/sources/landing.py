"""Landing zone: envelopes around verbatim payloads, and scans of landed gzip NDJSON.

Layout: ``{root}/edgar/{stream}/logical_date={d}/`` holding one envelope per
line.  Readers always pass the declared ENVELOPE schema (never inference) and
carry the file path from ``_metadata``.  gzip is not splittable, so scans are
one task per file; writes therefore give a date many files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake import contracts as C
from factlake.functions import keys as K
from factlake.plans import bindings as B

CORRUPT = "_corrupt_record"


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def build_envelope(df: DataFrame, stream: str | Column, logical_date: Column, resource_id: Column,
                   request_url: Column, payload_json: Column, fetched_at: Column,
                   http_status: Column | int = 200, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wrap each row's payload (already canonical JSON text) in the flat 11-field envelope;
    ``keep`` names input columns to carry along."""
    st = F.lit(stream) if isinstance(stream, str) else stream
    status = F.lit(http_status) if isinstance(http_status, int) else http_status
    d = F.to_date(logical_date)
    return df.select(
        F.lit(C.ENVELOPE_VERSION).alias("envelope_version"),
        F.lit(C.SOURCE_SYSTEM).alias("source_system"),
        st.alias("stream"),
        resource_id.alias("resource_id"),
        d.cast("string").alias("logical_date"),
        K.batch_id(st, d).alias("batch_id"),
        fetched_at.alias("fetched_at"),
        request_url.alias("request_url"),
        status.cast("int").alias("http_status"),
        K.content_hash(payload_json).alias("content_sha256"),
        payload_json.alias("payload_json"),
        *keep,
    )


def index_payload() -> Column:
    """Canonical JSON of the six index fields (keys sorted, nulls kept)."""
    return K.canonical_json(K.sorted_struct(**{f.name: F.col(f.name) for f in C.INDEX_PAYLOAD.fields}))


def index_envelopes(events: DataFrame, extra_payload: dict[str, Column] | None = None) -> DataFrame:
    """filing_index envelopes for the index rows bound from ``events``.

    ``extra_payload`` adds undeclared keys to some payloads (for rescue tests).
    """
    rows = B.index_rows_from_events(events, extra=("ts", "event_type", "props"))
    fields = {f.name: F.col(f.name) for f in C.INDEX_PAYLOAD.fields}
    payload = index_payload()
    if extra_payload:
        payload = K.canonical_json(K.sorted_struct(**fields, **extra_payload))
    return build_envelope(rows, "filing_index", F.col("logical_date"), F.col("accession_number"),
                          K.daily_index_url(F.col("logical_date")), payload, rfc3339(F.col("ts")))


def envelope_read_schema() -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in C.ENVELOPE.fields]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def read_landing(spark: SparkSession, root: str, stream: str | None = None) -> DataFrame:
    """Envelopes under a landing root (all dates, partition column restored from the path).

    Malformed lines are kept in ``_corrupt_record`` (PERMISSIVE) rather than failing the scan.
    """
    path = f"{root.rstrip('/')}/edgar/{stream}" if stream else root
    df = (spark.read.schema(envelope_read_schema()).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def landed_files(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """Path, size and modification time of every landed file of a stream; contents are not read.

    Landed files are gzip, so one without rows has bytes and is listed; a file of no bytes is not."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/edgar/{stream}")
    return files.select("path", "length", "modificationTime")


def read_checked(spark: SparkSession, root: str, stream: str) -> tuple[DataFrame, DataFrame]:
    """(envelopes of the sound lines of a stream, bad lines with their text, file and reason).

    A line that is no JSON object or breaks the envelope contract never becomes a row of NULLs.
    """
    fields = [f for f in C.ENVELOPE_FIELDS if f != "logical_date"]  # restored from the path
    lines = spark.read.text(f"{root.rstrip('/')}/edgar/{stream}").select(
        "value", F.col("logical_date").cast("date").alias("logical_date"), F.col("_metadata.file_path").alias("_source_file"))
    checked = validate_lines(lines, fields=fields)
    good = checked.where("is_valid").select(F.from_json("value", C.ENVELOPE).alias("_e"), "logical_date", "_source_file") \
        .select(*[F.col(f"_e.{f}") if f in fields else F.col(f).cast("string").alias(f) for f in C.ENVELOPE_FIELDS], "_source_file")
    bad = checked.where("NOT is_valid").select("logical_date", F.col("value").alias("line"), "invalid_reason", "_source_file")
    return good, bad


def validate_lines(lines: DataFrame, text_col: str = "value", fields=C.ENVELOPE_FIELDS) -> DataFrame:
    """Envelope contract check on raw JSON lines: parseable, every field of ``fields`` present and
    non-null, ``http_status`` an integer, no ``_``-prefixed key."""
    keys = F.json_object_keys(F.col(text_col))
    parsed = F.from_json(F.col(text_col), C.ENVELOPE)
    missing = F.array_except(F.array(*[F.lit(f) for f in fields]), F.coalesce(keys, F.array()))
    nulls = F.filter(F.array(*[F.when(parsed[f].isNull(), F.lit(f)) for f in fields]),
                     lambda x: x.isNotNull())
    underscore = F.filter(F.coalesce(keys, F.array()), lambda k: k.startswith("_"))
    status_bad = (F.get_json_object(F.col(text_col), "$.http_status").isNotNull()
                  & parsed["http_status"].isNull())
    reason = (F.when(keys.isNull(), F.lit("unparseable"))
              .when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))
              .when(F.size(underscore) > 0, F.concat(F.lit("private_key:"), F.array_join(underscore, ",")))
              .when(status_bad, F.lit("http_status_not_int"))
              .when(F.size(nulls) > 0, F.concat(F.lit("null:"), F.array_join(nulls, ","))))
    return lines.select("*", reason.alias("invalid_reason"), reason.isNull().alias("is_valid"))


def read_completed_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Completed-work lines ``{cik, concept, envelope|null}``: blank and truncated lines
    are skipped (the pair is simply pending again); a null envelope still means done.  Of a pair
    named twice the last line counts (of the last file by name)."""
    schema = T.StructType([T.StructField("cik", T.StringType()), T.StructField("concept", T.StringType()),
                           T.StructField("envelope", T.StringType()),
                           T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    # a line's place: its file, the block that holds it, its turn among the lines read from there
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = raw.select("*", place.alias("_place")).where(F.col(CORRUPT).isNull() & F.col("cik").isNotNull() & F.col("concept").isNotNull())
    return (lines.groupBy(K.pad_cik("cik").alias("cik"), "concept")
            .agg(F.max_by(F.struct("envelope"), "_place").alias("_e")).select("cik", "concept", "_e.envelope"))
