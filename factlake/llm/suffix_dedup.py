"""Removal of repeated 400-byte strings with a sparse suffix array, sorted deep-shallow.

A byte goes if a 400-byte string covers it that also starts anywhere else in the corpus (same
document included).  Sorting every suffix is not needed: each 400-byte window has one anchor,
the leftmost smallest hash of its 32-byte strings, so equal windows have equal anchors at equal
places.  Only suffixes at anchors whose 32 bytes occur twice are sorted.

1. Anchors of every text, one row per fingerprint and text with its number of places; fingerprints
   with one place are dropped (pre-aggregated counts).
2. For the others the bytes of all windows they own (left and right context) are shuffled by
   fingerprint and read in order of (fingerprint, content).  Equal contents are copies: all their
   windows repeat, and one of them stays as a reference.  Equal contexts of one text are one row with
   the intervals they cover, so a long run of one byte or of a short period costs one row.
3. The distinct contexts of a fingerprint are sorted deep-shallow, the right contexts as suffixes,
   the left ones as reversed prefixes: multikey quicksort on 8-byte words to ``SHALLOW`` bytes, then
   blind tries order the groups that still agree.  From both orders and their common prefix lengths
   follow the window offsets that occur twice.
4. A fingerprint with more than ``GROUP`` places (a hot passage amid different texts) never meets in
   one task: its contexts are dealt by content and salt, copies are taken out there, and the windows of
   the others are counted by their hashes, with partial sums.
5. The covered intervals return to the texts that hold them.

Everything is keyed by content (128-bit digest of the text), so copies, repeated rows and null
doc_ids need no special case.  Defined results: null counts as empty; texts under 400 bytes
keep everything; very long texts are hashed in pieces, with windows across them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.llm.bytewords import mix
from factlake.llm.common import giving_back, let, written

LENGTH = 400
GRAM = 32
PIECE = 1 << 18   # window starts handled at once
SHALLOW = 96      # bytes sorted by multikey quicksort before the tries
GROUP = 20_000    # places of one fingerprint sorted in one task
SALTS = 16        # tasks over which one content of a hot fingerprint is dealt
PAIRS = 40        # groups up to this size compare ranges of the sorted order pair by pair

_BYTE = np.random.default_rng(7).integers(0, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INDEX = np.uint64((1 << 20) - 1)


def _gram_hashes(arr: np.ndarray) -> np.ndarray:
    h, width, base = _BYTE[arr], 1, _BASE
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base = base * base & 0xFFFFFFFFFFFFFFFF
        width *= 2
    return mix(h)


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, fingerprint, first owned window start, last one) for all windows of a text."""
    n = len(data) - length + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    arr, span = np.frombuffer(data, np.uint8), length - GRAM + 1
    out = []
    for at in range(0, n, PIECE):
        end = min(n, at + PIECE)
        v = _gram_hashes(arr[at:end + length - 1])
        low = (v & ~_INDEX) | np.arange(len(v), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
        owner = (low & _INDEX).astype(np.int64)
        first = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
        last = np.append(first[1:], len(owner)) - 1
        own = owner[first]
        out.append((own + at, v[own].view(np.int64), first + at, last + at))
    return tuple(np.concatenate(c) for c in zip(*out))


# --- deep-shallow sorting -------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n if x == 0 else n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Patricia trie that keeps only branch depths and bytes; strings are compared once an insertion."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None  # node: ("leaf", members) or (depth, {byte: node})

    def insert(self, k: int) -> None:
        s = self.strings[k]
        if self.root is None:
            self.root = ("leaf", [k])
            return
        node = self.root
        while node[0] != "leaf":  # descend blindly to some leaf
            branch = self._byte(s, node[0])
            node = node[1].get(branch) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(k)
            return
        parent, edge, node = None, None, self.root
        while node[0] != "leaf" and node[0] < depth:
            parent, edge = node, self._byte(s, node[0])
            node = node[1][edge]
        if node[0] == depth:
            node[1][self._byte(s, depth)] = ("leaf", [k])
            return
        new = (depth, {self._byte(other, depth): node, self._byte(s, depth): ("leaf", [k])})
        if parent is None:
            self.root = new
        else:
            parent[1][edge] = new

    @staticmethod
    def _byte(s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    def order(self) -> tuple[list[int], list[int]]:
        """(members in order, common prefix of each with the one before; the first has -1)."""
        members, lcp = [], []
        stack = [(self.root, -1)]
        while stack:
            node, before = stack.pop()
            if node[0] == "leaf":
                for i, k in enumerate(node[1]):
                    members.append(k)
                    lcp.append(before if i == 0 else len(self.strings[k]))
                continue
            kids = sorted(node[1].items())
            stack += [(kid, before if i == 0 else node[0]) for i, (_, kid) in reversed(list(enumerate(kids)))]
        return members, lcp


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp with the predecessor) of the strings; equal strings keep their order."""
    order: list[int] = []
    lcp: list[int] = []
    words = np.zeros((len(strings), shallow // 8), dtype=np.uint64)
    for k, s in enumerate(strings):
        words[k] = np.frombuffer(s[:shallow].ljust(shallow, b"\0"), ">u8")

    def place(members, depth):
        """Order members that agree on ``depth`` words."""
        if len(members) == 1:
            order.append(int(members[0]))
            lcp.append(-1)
        elif depth * 8 >= shallow or len(members) <= 4:
            trie = BlindTrie(strings)
            for k in members.tolist():
                trie.insert(k)
            got, pre = trie.order()
            order.extend(got)
            lcp.extend(pre)
        else:  # multikey quicksort: three-way partition by the word at this depth
            key = words[members, depth]
            pivot = np.sort(key)[len(key) // 2]
            for part, deeper in ((key < pivot, 0), (key == pivot, 1), (key > pivot, 0)):
                if part.any():
                    yield members[part], depth + deeper
    stack = [(np.arange(len(strings)), 0)]
    while stack:
        members, depth = stack.pop()
        stack.extend(reversed(list(place(members, depth))))
    for i, v in enumerate(lcp):
        if v < 0 and i:  # neighbours from different parts
            lcp[i] = common_prefix(strings[order[i - 1]], strings[order[i]])
    return np.array(order), np.array(lcp)


def repeated_offsets(lefts: list[bytes], rights: list[bytes], length: int = LENGTH) -> list[tuple[int, int] | None]:
    """Per member the smallest and largest d for which (last d bytes of left, first length - d
    bytes of right) also occurs at another member; ``lefts`` are reversed."""
    m = len(rights)
    r_order, r_lcp = deep_shallow(rights)
    l_order, l_lcp = deep_shallow(lefts)
    if m <= PAIRS:
        r, lft = _pairwise(r_order, r_lcp), _pairwise(l_order, l_lcp)
        ok = r + lft >= length
        np.fill_diagonal(ok, False)
        top = np.where(ok, lft, -1).max(axis=1)
        bottom = length - np.where(ok, r, -1).max(axis=1)
        return [(int(max(0, b)), int(t)) if t >= 0 else None for b, t in zip(bottom, top)]
    low, high = np.full(m, length + 1), np.full(m, -1)
    right_group, left_group = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(max(map(len, lefts)) + 1):
        right_group[r_order] = np.cumsum(r_lcp < length - d)
        left_group[l_order] = np.cumsum(l_lcp < d)
        _, inverse, n = np.unique(right_group * (m + 1) + left_group, return_inverse=True, return_counts=True)
        hit = n[inverse] > 1
        low[hit] = np.minimum(low[hit], d)
        high[hit] = d
    return [(int(a), int(b)) if b >= 0 else None for a, b in zip(low, high)]


def _pairwise(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    m = len(order)
    out = np.zeros((m, m), dtype=np.int64)
    for i in range(m - 1):
        v = np.minimum.accumulate(lcp[i + 1:])
        out[order[i], order[i + 1:]] = v
        out[order[i + 1:], order[i]] = v
    return out


# --- the Spark job --------------------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"), F.unhex(F.md5(body)).alias("tkey"))


def _anchor_rows(length: int):
    def run(batches):
        for b in _sliced(batches):
            for tkey, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fp, n = np.unique(anchors(body.encode("utf-8"), length)[1], return_counts=True)
                if len(fp):
                    yield pa.RecordBatch.from_arrays([pa.array([tkey] * len(fp), pa.binary()), pa.array(fp, pa.int64()), pa.array(n, pa.int64())],
                                                     names=["tkey", "fp", "n"])
    return _batched(run)


def _sliced(batches, rows: int = 500):
    """Few texts at a time become Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _batched(run, rows: int = 20_000):
    """Join the small record batches of ``run`` (each costs a message to the JVM)."""
    def joined(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return joined


def _joined(firsts: list[int], size: int) -> list[int]:
    """Ascending intervals of one size, merged: begin, end, begin, end, ..."""
    out: list[int] = []
    for at in firsts:
        if out and at <= out[-1]:
            out[-1] = at + size
        else:
            out += [at, at + size]
    return out


def _contexts(length: int, rows: int = 4_000):
    """(tkey, body, repeated fingerprints, hot ones) -> the distinct contexts of the text, with the intervals they cover."""
    kinds = {"fp": pa.int64(), "hot": pa.bool_(), "content": pa.binary(), "tkey": pa.binary(), "first": pa.int64(), "left": pa.int32(),
             "bytes": pa.binary(), "spans": pa.list_(pa.int64())}

    def run(batches):
        for b in _sliced(batches):
            for tkey, body, fps, hot in zip(*(b.column(k).to_pylist() for k in range(4))):
                data, hot = body.encode("utf-8"), set(hot)
                pos, fp, first, last = anchors(data, length)
                pick = np.flatnonzero(np.isin(fp, np.asarray(fps)))
                held: dict[tuple, list[int]] = {}  # (content, left) -> starts; equal ones have one fingerprint and size
                sizes: list[tuple[int, int]] = []
                for f, p, a, z in zip(*(x[pick].tolist() for x in (fp, pos, first, last + length))):
                    key = hashlib.blake2b(data[a:z], digest_size=16).digest(), p - a
                    if key not in held:
                        held[key] = []
                        sizes.append((f, z - a))
                    held[key].append(a)
                out = []
                for ((content, left), firsts), (f, size) in zip(held.items(), sizes):
                    a = firsts[0]
                    out.append((f, f in hot, content, tkey, a, left, data[a:a + size], _joined(firsts, size)))
                    if len(out) == rows:
                        yield _rows(out, kinds)
                        out = []
                if out:
                    yield _rows(out, kinds)
    return _batched(run, rows)


CONTEXT = "fp long, hot boolean, content binary, tkey binary, first long, left int, bytes binary, spans array<long>"
SPAN = "tkey binary, lo long, hi long, over binary, left int"


def _rows(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def _sorted_groups(length: int):
    """Contexts sorted by (fp, content, left) -> covered intervals; of hot fingerprints also the distinct contexts as they are."""
    def run(batches):
        spans: list[tuple] = []
        fp = None
        members: list[list] = []  # [content, left, tkey, first, bytes, copied, intervals]

        def cover(tkey, intervals):
            spans.extend((tkey, lo, hi, None, None) for lo, hi in zip(intervals[::2], intervals[1::2]))

        def finish():
            if len(members) < 2:
                return
            got = repeated_offsets([m[4][:m[1]][::-1] for m in members], [m[4][m[1]:] for m in members], length)
            for m, d in zip(members, got):
                if d is not None and not m[5]:
                    spans.append((m[2], m[3] + m[1] - d[1], m[3] + m[1] - d[0] + length, None, None))

        for b in batches:
            for f, hot, content, tkey, first, left, raw, own in zip(*(b.column(k).to_pylist() for k in range(8))):
                if f != fp:
                    finish()
                    fp, members = f, []
                if members and members[-1][0] == content and members[-1][1] == left:
                    m = members[-1]
                    if not m[5]:
                        m[5] = True
                        cover(m[2], m[6])
                    cover(tkey, own)
                    continue
                if hot:  # the one before is done with: only this one is held
                    members = []
                    spans.append((tkey, first, first + len(raw), raw, left))
                copied = own != [first, first + len(raw)]  # by its own text
                if copied:
                    cover(tkey, own)
                members.append([content, left, tkey, first, raw, copied, own])
            if len(spans) >= 5_000:
                yield _span_rows(spans)
                spans.clear()
        finish()
        if spans:
            yield _span_rows(spans)
    return run


def _span_rows(spans) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*spans), kinds)], names=["tkey", "lo", "hi", "over", "left"])


def _windows(length: int):
    """Every window of a hot context by its digest."""
    def run(batches):
        for b in batches:
            for tkey, lo, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(raw[k:k + length], digest_size=16).digest() for k in range(n)], pa.binary()),
                                                  pa.array([tkey] * n, pa.binary()), pa.array(range(lo, lo + n), pa.int64())], names=["window", "tkey", "lo"])
    return _batched(run)


def covered(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(tkey, spans): covered intervals (begin, end, begin, end, ..., not merged) of each text that has any."""
    long_ = _keyed(docs).filter(F.octet_length("body") >= length)
    texts = long_.groupBy("tkey").agg(F.count("*").alias("rows"), F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("one"))
    found = written(long_.select("tkey", "body").mapInArrow(giving_back(_anchor_rows(length)), "tkey binary, fp long, n long"), "suffix-anchors")
    text = F.xxhash64("tkey")  # copies of a text share their places
    places = found.groupBy("fp").agg(F.min(text).alias("a"), F.max(text).alias("b"), F.max("n").alias("most"), F.sum("n").alias("n"))
    twice = places.filter("most > 1 OR a <> b").select("fp", (F.col("n") > group).alias("hot"))
    repeated = found.select("tkey", "fp").join(twice, "fp").groupBy("tkey").agg(F.collect_set("fp").alias("fps"), F.collect_set(F.when(F.col("hot"), F.col("fp"))).alias("hot"))
    holder = long_.withColumn("one", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(texts.select("tkey", "one"), ["tkey", "one"], "left_semi")
    contexts = holder.join(repeated, "tkey").select("tkey", "body", "fps", "hot").mapInArrow(giving_back(_contexts(length)), CONTEXT)
    dealt = F.when(F.col("hot"), F.xxhash64("content", F.pmod(F.xxhash64("tkey"), F.lit(SALTS)))).otherwise(F.lit(0))
    ordered = contexts.repartition("fp", dealt).sortWithinPartitions("fp", "content", "left", "tkey", "first")
    spans = written(ordered.mapInArrow(giving_back(_sorted_groups(length)), SPAN), "suffix-spans")
    plain = spans.filter("over is null").select("tkey", "lo", "hi")
    hot = spans.filter("over is not null")
    if not hot.isEmpty():
        windows = hot.mapInArrow(_windows(length), "window binary, tkey binary, lo long")
        place = F.xxhash64("tkey", "lo")
        again = windows.groupBy("window").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("window")
        plain = plain.unionByName(windows.join(again, "window", "left_semi").select("tkey", "lo", (F.col("lo") + length).alias("hi")))
    whole = texts.filter("rows > 1").select("tkey", F.lit(0).cast("long").alias("lo"), F.lit(1 << 62).cast("long").alias("hi"))
    every = plain.unionByName(whole)
    return every.groupBy("tkey").agg(F.flatten(F.collect_list(F.array("lo", "hi"))).alias("spans"))


def merged(spans: list[int]) -> list[int]:
    """Intervals (begin, end, begin, end, ...) in order, those that meet as one."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _merged_rows(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([merged(s) for s in b.column(1).to_pylist()], pa.list_(pa.int64()))], names=["tkey", "runs"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, kept (the remaining bytes), spans removed, per document.

    Only intervals go through Python; the texts are cut where they are."""
    runs = covered(docs, length, group).mapInArrow(_merged_rows, "tkey binary, runs array<long>")
    size = F.octet_length("body").cast("long")
    marked = _keyed(docs).join(runs, "tkey", "left").select("doc_id", "body", size.alias("n_bytes"), F.transform(
        F.coalesce("runs", F.array().cast("array<long>")), lambda x: F.least(x, size)).alias("removed"))
    # kept: from the start, then from each end, to the next begin or the end of the text
    data, edges = F.col("body").cast("binary"), F.concat(F.array(F.lit(0).cast("long")), "removed", F.array("n_bytes"))

    def cut(d, e):
        piece = lambda k: F.hex(F.substring(d, (F.get(e, 2 * k) + 1).cast("int"), (F.get(e, 2 * k + 1) - F.get(e, 2 * k)).cast("int")))
        return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.size(e) / 2).cast("int") - 1), piece), ""))
    kept = F.when(F.size("removed") == 0, data).otherwise(let(data, lambda d: let(edges, lambda e: cut(d, e))))
    return marked.select("doc_id", "n_bytes", "removed", kept.alias("kept"))


def digests(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the digest of what is left."""
    out = remove_repeats(docs, length, group)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      (F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
