"""Deterministic landing writes, ordered fan-out to several roots, and dry runs.

Same input -> same bytes: a date's rows are dealt by resource id into ``FILES_PER_DATE``
buckets and sorted before a gzip JSON write, so a date spans many tasks and files (gzip
does not split); re-running overwrites only the dates it touches (dynamic partition
overwrite).  An empty single-date batch is written straight
into its partition directory so the old contents are replaced, not kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from factlake import contracts as C
from factlake.session import shuffle_width


FILES_PER_DATE = 16  # buckets a date is written in; raise it with the size of a day


def deal(rows: DataFrame, date: str = "logical_date", resource: str = "resource_id", files: int = FILES_PER_DATE) -> DataFrame:
    """Rows of one (date, bucket of resource ids) together, buckets spread over the tasks."""
    bucket = F.pmod(F.xxhash64(resource), F.lit(files))
    return rows.repartition(shuffle_width(rows.sparkSession), F.col(date), bucket)


def _sorted(envelopes: DataFrame, files: int, dealt: bool = False) -> DataFrame:
    """Dealt rows in the order they are written in."""
    rows = envelopes.select(*C.ENVELOPE_FIELDS)
    return ((rows if dealt else deal(rows, files=files))
            .sortWithinPartitions("logical_date", "resource_id", "content_sha256", *[f for f in C.ENVELOPE_FIELDS if f not in ("logical_date", "resource_id", "content_sha256")]))


def stream_root(root: str, stream: str) -> str:
    return f"{root.rstrip('/')}/edgar/{stream}"


def write_stream(envelopes: DataFrame, root: str, stream: str, files: int = FILES_PER_DATE, dealt: bool = False) -> None:
    """Write one stream's envelopes under ``logical_date=`` partitions (dynamic overwrite).

    ``dealt`` says that they were made from rows that ``deal`` has dealt: they are not shuffled again."""
    (_sorted(envelopes.where(F.col("stream") == stream), files, dealt)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "gzip").partitionBy("logical_date")
     .json(stream_root(root, stream)))


def write_batch(envelopes: DataFrame, root: str, stream: str, logical_date: str, files: int = FILES_PER_DATE) -> None:
    """Write one (stream, date) batch into its own directory, replacing it even when empty."""
    (_sorted(envelopes, files)
     .write.mode("overwrite").option("compression", "gzip")
     .json(f"{stream_root(root, stream)}/logical_date={logical_date}"))


@dataclass
class FanoutResult:
    targets: list[str] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)
    records: int = 0
    bytes: int = 0


def fan_out(envelopes: DataFrame, roots: list[str], streams: tuple[str, ...] = C.STREAMS,
            dates: tuple[str, ...] = ()) -> FanoutResult:
    """Write the same records to every root in order.

    The first root is the system of record: its failure is fatal.  Later roots
    may fail; they are reported as ``landing_push_failed`` and not listed as
    targets.  Records and bytes are counted once, from the first write, with an
    Observation (no extra pass).  No roots: nothing happens.  ``dates`` names the batch's
    logical dates: one without any record is replaced by an empty batch.
    """
    res = FanoutResult()
    if not roots:
        return res
    obs = Observation("landing")
    observed = envelopes.observe(obs, F.count(F.lit(1)).alias("records"),
                                 F.coalesce(F.sum(F.octet_length("payload_json")), F.lit(0)).alias("bytes"))
    cached = observed.persist()
    try:
        for s in streams:
            write_stream(cached, roots[0], s)
        m = obs.get
        held = set()
        if dates:
            of = cached.where(F.col("logical_date").cast("string").isin(*dates))
            held = {(r.stream, str(r.logical_date)) for r in of.select("stream", "logical_date").distinct().collect()}
        empty = [(s, d) for s in streams for d in dates if (s, d) not in held]
        for s, d in empty:
            write_batch(cached.limit(0), roots[0], s, d)
        res.records, res.bytes = int(m["records"]), int(m["bytes"])
        res.targets.append(roots[0])
        for r in roots[1:]:
            try:
                for s in streams:
                    write_stream(cached, r, s)
                for s, d in empty:
                    write_batch(cached.limit(0), r, s, d)
                res.targets.append(r)
            except Exception as e:  # noqa: BLE001 - a copy may fail without failing the run
                res.failed.append((r, f"landing_push_failed: {type(e).__name__}"))
    finally:
        cached.unpersist()
    return res


def dry_run(envelopes: DataFrame) -> dict:
    """Encode and count without writing anything (``noop`` sink + Observation)."""
    obs = Observation("dry_run")
    (envelopes.observe(obs, F.count(F.lit(1)).alias("records"),
                       F.coalesce(F.sum(F.octet_length("payload_json")), F.lit(0)).alias("bytes"))
     .write.format("noop").mode("overwrite").save())
    return {k: int(v) for k, v in obs.get.items()}
