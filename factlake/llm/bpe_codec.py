"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Every text is split by the vocabulary's pattern.  The words' positions are kept in blocks of about
   ``BLOCK_CHARS`` characters: within a block each distinct word has a number, and each
   document is its sequence of numbers.
2. (word, block, number) rows are shuffled by word and sorted; equal words lie side by side, so each
   distinct word of the corpus is encoded once, and its ids go back to every block that holds it.
3. Blocks (kept in a table bucketed by block, so they are not shuffled) meet their words' ids again
   and documents are reassembled by position.  Decoding looks
   the ids up in the token-byte table (its size is fixed by the vocabulary) and joins the bytes.

Only word rows and compressed numbers are shuffled, never texts; a word that every document
holds is one row a block.  Blocks are written once to the shared folder, so retries of later
steps do not number words anew.

Defined results: null counts as empty and has no token.  Rows are never merged, so repeated
rows and null doc_ids keep theirs.  A text longer than a block is a block of its own.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.llm.common import give_back, giving_back
from factlake.session import scratch_dir

BLOCK_CHARS = 32 << 20
ROW_WORDS = 1 << 19  # words a row of packed documents
SEND_WORDS = 16_384  # words a message back to a block

BLOCKS = "block long, doc_ids array<long>, codes binary, number int, word string"

#: The pattern of the byte-level vocabularies (a fixed value), for which Latin texts have a faster equal form.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN = 0x250


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splitter(pattern: str):
    """The function that lists a text's matches of ``pattern``."""
    import re
    import unicodedata

    import regex

    find = regex.compile(pattern).findall
    if pattern != BYTE_PATTERN:
        return find
    kind = {k: "".join(c for c in map(chr, range(0x80, LATIN)) if unicodedata.category(c)[0] == k) for k in "LN"}
    letter, digit, space = "A-Za-z" + kind["L"], "0-9" + kind["N"], " \\t\\n\\r\\f\\v\x85\xa0"
    latin = re.compile(f" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+").findall
    beyond = re.compile(f"[^\\x00-{chr(LATIN - 1)}]").search
    return lambda text: find(text) if beyond(text) else latin(text)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as compressed byte planes (frequent words have small numbers)."""
    z = zlib.compressobj(1, zlib.DEFLATED, 15, 9, zlib.Z_RLE)
    head = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()
    return head + b"".join(z.compress(np.asarray(a).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()) for a in arrays) + z.flush()


def unpack(data: bytes) -> list[np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    sizes, at, out = np.frombuffer(data[4:4 + 4 * n], "<u4").tolist(), 0, []
    raw = zlib.decompress(data[4 + 4 * n:])
    for size in sizes:
        planes = np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * size
    return out


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _split(pattern: str, block_chars: int):
    """(doc_id, text) -> rows of documents (codes) and of their block's words (number, word)."""
    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        find = splitter(pattern)
        base = TaskContext.get().partitionId() << 24
        seq, numbers, docs, size = 0, _Numbers(), [], 0

        def flush():
            count = np.zeros(len(numbers), dtype=np.int64)
            at = 0
            rows: list[tuple[list, list]] = [([], [])]
            for doc_id, c in docs:
                if at >= ROW_WORDS:
                    rows.append(([], []))
                    at = 0
                rows[-1][0].append(doc_id)
                rows[-1][1].append(c)
                at += len(c)
            joined = [np.concatenate(codes) for _, codes in rows]
            for c in joined:
                count += np.bincount(c, minlength=len(count))
            place = np.empty(len(numbers), dtype=np.uint32)
            place[np.argsort(-count, kind="stable")] = np.arange(len(numbers), dtype=np.uint32)
            block = base | seq
            for (ids, codes), c in zip(rows, joined):
                yield _rows(block, [ids], [pack(np.fromiter(map(len, codes), np.uint32, len(codes)), place[c])], None, None)
            order = sorted(numbers)  # neighbours share prefixes: smaller files
            place = place[np.fromiter(map(numbers.__getitem__, order), np.int64, len(order))].astype(np.int32)
            for at in range(0, len(order), 100_000):
                yield _rows(block, None, None, place[at:at + 100_000], order[at:at + 100_000])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                docs.append((doc_id, np.fromiter(map(numbers.__getitem__, find(text)), dtype=np.uint32) if text else np.zeros(0, np.uint32)))
                size += len(text) if text else 0
                if size >= block_chars:
                    yield from flush()
                    seq, numbers, docs, size = seq + 1, _Numbers(), [], 0
        if docs:
            yield from flush()
    return run


def _rows(block, doc_ids, codes, numbers, words) -> pa.RecordBatch:
    n = len(codes if words is None else words)
    ids = pa.list_(pa.int64())
    cols = [pa.array([block] * n, pa.int64()),
            pa.array(doc_ids, ids) if words is None else pa.nulls(n, ids),
            pa.array(codes, pa.binary()) if words is None else pa.nulls(n, pa.binary()),
            pa.nulls(n, pa.int32()) if words is None else pa.array(numbers, pa.int32()),
            pa.nulls(n, pa.string()) if words is None else pa.array(words, pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=["block", "doc_ids", "codes", "number", "word"])


def encoder(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encode(ranks, pattern: str):
    """Rows (word, block, number) sorted by word -> (block, message of numbers and ids)."""
    def run(batches):
        encode = encoder(ranks.value, pattern).encode_ordinary
        waiting: dict[int, tuple[list, list]] = {}
        held, last, ids = 0, None, []

        def send(blocks):
            out = [(k, message(*waiting.pop(k))) for k in blocks]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([m for _, m in out], pa.binary())], names=["block", "message"])

        for b in batches:
            full = []
            for word, block, number in zip(*(b.column(k).to_pylist() for k in range(3))):
                if word != last:
                    last, ids = word, encode(word)
                w = waiting.get(block)
                if w is None:
                    w = waiting[block] = ([], [])
                w[0].append(number)
                w[1].append(ids)
                held += 1
                if len(w[0]) == SEND_WORDS:
                    full.append(block)
                    yield send([block])
                    held -= SEND_WORDS
            if held > 2_000_000:  # many blocks, few words each: bound what waits
                yield send(list(waiting))
                held = 0
        if waiting:
            yield send(list(waiting))
    return run


def message(numbers: list[int], ids: list[list[int]]) -> bytes:
    lens = np.fromiter(map(len, ids), dtype=np.uint32, count=len(ids))
    order = np.argsort(np.asarray(numbers), kind="stable")
    flat = np.fromiter((t for k in order.tolist() for t in ids[k]), dtype=np.uint32, count=int(lens.sum()))
    return pack(np.diff(np.asarray(numbers, dtype=np.int64)[order], prepend=0), lens[order], flat)


def read_message(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, lengths, ids)."""
    steps, lens, flat = unpack(data)
    return np.cumsum(steps.astype(np.int64)), lens, flat


class BlockWords:
    """A block's words as ids: what reassembly and decoding look up."""

    def __init__(self, messages: list[bytes], tokens: dict[int, bytes]):
        got = [read_message(m) for m in messages]
        n = 1 + max((int(g[0][-1]) for g in got if len(g[0])), default=-1)
        self.lens = np.zeros(n, dtype=np.int64)
        self.text: list[str] = [""] * n
        self.bytes: list[bytes] = [b""] * n
        self.ids: list[list[int]] = [[]] * n
        for numbers, lens, flat in got:
            self.lens[numbers] = lens
            flat, at = flat.tolist(), 0
            for number, size in zip(numbers.tolist(), lens.tolist()):
                ids = flat[at:at + size]
                at += size
                self.ids[number] = ids
                self.text[number] = " ".join(map(str, ids))
                self.bytes[number] = b"".join([tokens[t] for t in ids])


def _assemble(tokens, keep_ids: bool):
    def run(docs: pa.Table, messages: pa.Table) -> pa.Table:
        out = assembled(docs, messages)
        give_back()
        return out

    def assembled(docs: pa.Table, messages: pa.Table) -> pa.Table:
        words = BlockWords(messages.column("message").to_pylist(), tokens.value)
        doc_ids, n_tokens, ids_sha, decoded_sha, ids, decoded = [], [], [], [], [], []
        for of, data in zip(docs.column("doc_ids").to_pylist(), docs.column("codes").to_pylist()):
            doc_ids += of
            lens, every = unpack(data)
            ends = np.cumsum(lens.astype(np.int64)).tolist()
            for a, z in zip([0, *ends], ends):
                codes = every[a:z].tolist()
                raw = b"".join(map(words.bytes.__getitem__, codes))
                if keep_ids:
                    ids.append([t for c in codes for t in words.ids[c]])
                    decoded.append(raw)
                    continue
                n_tokens.append(int(words.lens[every[a:z]].sum()) if codes else 0)
                ids_sha.append(hashlib.sha256(" ".join(map(words.text.__getitem__, codes)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(raw).hexdigest())
        doc_id = pa.array(doc_ids, pa.int64())
        if keep_ids:
            return pa.table({"doc_id": doc_id, "ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.binary())})
        return pa.table({"doc_id": doc_id, "n_tokens": pa.array(n_tokens, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                         "decoded_sha256": pa.array(decoded_sha, pa.string())})
    return run


def _coded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int, keep_ids: bool, schema: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(ranks)
    tokens = spark.sparkContext.broadcast({i: b for b, i in ranks.items()})
    path = scratch_dir(spark, "bpe-blocks")
    name = "bpe_blocks_" + path.rsplit("-", 1)[-1]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    (narrow.mapInArrow(giving_back(_split(pattern, block_chars)), BLOCKS).write.format("parquet").option("compression", "zstd").option("path", path)
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name))
    blocks = spark.table(name)
    words = blocks.filter("word is not null").select("word", "block", "number").repartition("word").sortWithinPartitions("word")
    messages = words.mapInArrow(giving_back(_encode(vocabulary, pattern)), "block long, message binary")
    documents = blocks.filter("word is null").select("block", "doc_ids", "codes")
    return documents.groupBy("block").cogroup(messages.groupBy("block")).applyInArrow(_assemble(tokens, keep_ids), schema)


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, ids, decoded (bytes of the ids) of every document."""
    return _coded(docs, ranks, pattern, block_chars, True, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of every document."""
    return _coded(docs, ranks, pattern, block_chars, False, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
