"""Token counts with overlap resynchronisation for huge documents.

A text of at most ``CHUNK`` characters is one chunk.  A longer one is cut into chunks of
``CHUNK`` characters that each reach ``overlap`` characters into the next; every chunk is a
row of its own, encoded with offsets by the tokenizer in whatever task it lands.  Two
neighbours are spliced at a boundary that both encodings prove stable: a token that starts
right after ASCII white space (the tokenizer drops white space and never merges across it)
and that both chunks place at the same offset.  Documents with a seam for which no such
boundary lies in the overlap are cut again with an overlap ``WIDEN`` times as large, until
every seam aligns (at the latest when a chunk reaches the end of the text).

Ordinary texts are counted by their white-space separated words, each word encoded once per
task and kept in a memo of bounded size.

Defined results: null counts as empty (0 bytes, 0 tokens).  Documents are handled by
content, so repeated rows and null or repeated doc_ids each keep their row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.llm.common import written

CHUNK = 32_768
OVERLAP = 512
WIDEN = 8
LIMIT = 2_048
MEMO = 400_000
ASCII_SPACE = " \t\n\r"
_TO_SPACE = str.maketrans("\t\n\r", "   ")


class WordCounter:
    """Token count of a text as the sum over its words, each distinct word encoded once."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.memo: dict[str, int] = {"": 0}

    def count_many(self, texts: list[str | None]) -> list[int]:
        split = [t.translate(_TO_SPACE).split(" ") if t else [] for t in texts]
        memo = self.memo
        new = list({w for ws in split for w in ws if w not in memo})
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                memo[w] = len(e)
        out = [sum(map(memo.__getitem__, ws)) for ws in split]
        if len(memo) > MEMO:
            self.memo = {"": 0}
        return out

    def starts(self, text: str) -> list[int]:
        """Start offset of every token."""
        return [a for a, _ in self.tok.encode(text, add_special_tokens=False).offsets]


_COUNTERS: dict[str, WordCounter] = {}


def counter(spec) -> WordCounter:
    """One counter per worker and tokenizer; ``spec`` is the broadcast tokenizer file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if spec.value not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[spec.value] = WordCounter(spec.value)
    return _COUNTERS[spec.value]


def _small(spec):
    def run(batches):
        count = counter(spec)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(count.count_many(texts), pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])
    return run


def stable_starts(text: str, starts: list[int]) -> dict[int, int]:
    """Offset -> number of tokens before it, for tokens right after ASCII white space."""
    out: dict[int, int] = {}
    for k, a in enumerate(starts):
        if a > 0 and text[a - 1] in ASCII_SPACE and a not in out:
            out[a] = k
    return out


def _encode_chunks(spec, chunk: int, overlap: int):
    """(key, no, n_chunks, body) -> tokens before each stable boundary of the head and tail overlap."""
    def run(batches):
        count = counter(spec)
        for b in batches:
            rows = {"key": [], "no": [], "n": [], "total": [], "head": [], "head_at": [], "tail": [], "tail_at": []}
            for key, no, n, body in zip(*(b.column(k).to_pylist() for k in range(4))):
                starts = count.starts(body)
                stable = stable_starts(body, starts)
                head = {a: k for a, k in stable.items() if no > 0 and a < overlap}
                tail = {a - chunk: k for a, k in stable.items() if no < n - 1 and a >= chunk}
                rows["key"].append(key)
                rows["no"].append(no)
                rows["n"].append(n)
                rows["total"].append(len(starts))
                rows["head"].append(list(head))
                rows["head_at"].append(list(head.values()))
                rows["tail"].append(list(tail))
                rows["tail_at"].append(list(tail.values()))
            i32, i64 = pa.list_(pa.int32()), pa.list_(pa.int64())
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), i32, i64, i32, i64]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))
    return run


def _seams(chunks: DataFrame, overlap: int) -> DataFrame:
    """Per document: n_tokens, or null where a seam has no common stable boundary.

    Each seam is an equi-join of a chunk's tail with its successor's head; a document's
    tokens are each chunk's total minus what lies before its splice in the head, minus what
    lies from its splice in the tail on.
    """
    tails = chunks.filter("no < n - 1").select("key", (F.col("no") + 1).alias("no"), F.map_from_arrays("tail", "tail_at").alias("t"))
    heads = chunks.filter("no > 0").select("key", "no", F.map_from_arrays("head", "head_at").alias("h"))
    # the common boundary nearest the middle of the overlap: both encodings have context there
    common = F.array_sort(F.transform(F.array_intersect(F.map_keys("t"), F.map_keys("h")),
                                      lambda a: F.struct(F.abs(a - overlap // 2).alias("d"), a.alias("a"))))
    seam = tails.join(heads, ["key", "no"]).select("key", F.get(common, F.lit(0))["a"].alias("at"), "t", "h")
    seam = seam.select("key", (F.col("t")[F.col("at")] - F.col("h")[F.col("at")]).alias("kept"),
                       F.col("at").isNull().cast("int").alias("open"))
    # total of chunk k from its splice on: sum(totals) - sum over seams of (total(prev) - t) - h
    ends = chunks.groupBy("key").agg(F.sum(F.when(F.col("no") == F.col("n") - 1, F.col("total"))).alias("last"))
    per_doc = seam.groupBy("key").agg(F.sum("kept").alias("kept"), F.max("open").alias("open"))
    return ends.join(per_doc, "key", "left").select(
        "key", F.when(F.coalesce("open", F.lit(0)) == 0, F.col("last") + F.coalesce("kept", F.lit(0))).alias("n_tokens"))


def _cut(chunk: int, overlap: int, rows: int = 64):
    """(key, body) -> (key, no, n, piece): each text in one pass, ``rows`` pieces a batch."""
    def run(batches):
        for b in batches:
            for key, body in zip(b.column(0), b.column(1)):
                key, body = key.as_py(), body.as_py()  # one text at a time
                n = max(1, -(-(len(body) - overlap) // chunk))
                for at in range(0, n, rows):
                    nos = list(range(at, min(n, at + rows)))
                    pieces = [body[no * chunk:] if no == n - 1 else body[no * chunk:(no + 1) * chunk + overlap] for no in nos]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(nos), pa.string()), pa.array(nos, pa.int32()), pa.array([n] * len(nos), pa.int32()),
                                                      pa.array(pieces, pa.string())], names=["key", "no", "n", "piece"])
    return run


def huge_counts(texts: DataFrame, spec, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, body) of distinct huge texts -> (key, n_tokens), by spliced chunks."""
    done, pending = None, texts
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        pieces = pending.select("key", "body").mapInArrow(_cut(chunk, overlap), "key string, no int, n int, piece string")
        # a document's chunks spread over the tasks; the width is given, as bytes say little of the time a chunk takes
        pieces = pieces.repartition(width, "key", "no")
        found = pieces.mapInArrow(_encode_chunks(spec, chunk, overlap),
                                  "key string, no int, n int, total long, head array<int>, head_at array<long>, tail array<int>, tail_at array<long>")
        result = written(_seams(written(found, "token-chunks"), overlap), "token-splices")
        ok = result.filter("n_tokens is not null")
        done = ok if done is None else done.unionByName(ok)
        again = result.filter("n_tokens is null").select("key")
        if again.isEmpty():
            return done
        overlap *= WIDEN
        pending = pending.join(again, "key", "left_semi")


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, by the tokenizer file at ``path``."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("body"))
    narrow = narrow.withColumn("n_bytes", F.octet_length("body").cast("long"))
    is_huge = F.length("body") > chunk
    small = narrow.filter(~is_huge).mapInArrow(_small(spec), "doc_id long, n_bytes long, n_tokens long")
    huge = narrow.filter(is_huge).withColumn("key", F.sha2("body", 256))
    if huge.isEmpty():
        out = small
    else:
        distinct = huge.groupBy("key").agg(F.first("body").alias("body"))
        counts = huge_counts(distinct, spec, chunk, overlap)
        out = small.unionByName(huge.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
