"""Benchmark decontamination with a generalised suffix automaton.

The word sequences of the test items feed one suffix automaton; a document's words
stream through it and the automaton tracks the longest match that ends at each word.  Where
that match holds a window (``WINDOW`` consecutive words of one item, or a whole shorter
item) its words are hit, and the state names the items that contain the window.

``decontaminate`` also cuts by coverage (``COVER`` of an item, changed words included): of an item of n words,
``WINDOW`` or more, a stretch of at most n / ``COVER`` words goes, from its first to its last run, if runs of
``RUN`` or more words common to both hold at least ``COVER`` * n different words of the item and as many of the stretch.
``contamination`` counts windows only.

The benchmark is used in blocks of about ``BLOCK_BYTES`` (its size is measured first), each
broadcast on its own; documents are scanned against every block without a shuffle.

Defined results: null or empty text has no words and no hits.  Repeated documents and
repeated items each give their own row / count once by item_id.  Items without words never
match.  A null item_id counts as the item ``null``.  Empty tables give no rows, or no hits.
Extra columns pass through ``scan`` untouched.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake.llm.bytewords import fold, word_hashes

WINDOW = 10
BLOCK_BYTES = 4 << 20
RUN = 4
COVER = (4, 5)  # a fraction: exact in integers

SPANS, ITEMS, WORDS = "__hit_spans", "__hit_items", "__n_words"


class ItemAutomaton:
    """Suffix automaton over the items' words, with the items of each state."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.names: list[str] = []
        ids: dict[str, int] = {}
        sequences = []
        for name, text in items:
            data = fold(text)
            _, starts, ends = word_hashes(data)
            if len(starts) == 0:
                continue
            seq = [self.vocab.setdefault(data[a:b], len(self.vocab)) for a, b in zip(starts, ends)]
            if name not in ids:
                ids[name] = len(self.names)
                self.names.append(name)
            sequences.append((ids[name], seq))
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        for _, seq in sequences:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.texts: dict[int, set[tuple[int, ...]]] = defaultdict(set)  # of items with a coverage limit
        for item, seq in sequences:
            if len(seq) >= window:
                self.texts[item].add(tuple(seq))
        self.grams: dict[tuple[int, ...], dict[tuple[int, ...], list[int]]] = {}  # places of runs, of texts looked at
        self.items: list[set[int]] = [set() for _ in self.len]
        self.whole: dict[int, list[tuple[int, int]]] = defaultdict(list)  # state -> (length, short item)
        for item, seq in sequences:
            state = 0
            for c in seq:
                state = up = self.next[state][c]
                while up > 0 and item not in self.items[up]:
                    self.items[up].add(item)
                    up = self.link[up]
            if len(seq) < window:
                while self.len[self.link[state]] >= len(seq):
                    state = self.link[state]
                if (len(seq), item) not in self.whole[state]:
                    self.whole[state].append((len(seq), item))
        self.above = [0] * len(self.len)  # nearest state upwards (itself included) that ends a short item
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.above[s] = s if s in self.whole else self.above[self.link[s]]
        self.shortest = min([window, *(len(s) for _, s in sequences)], default=window)
        self._lookup(sequences)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        q = nxt[last].get(c)
        if q is not None and length[q] == length[last] + 1:
            return q
        cur = -1
        if q is None:
            cur = len(length)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p == -1:
                return cur
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
                return cur
        else:
            p = last
        copy = len(length)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        if cur == -1:
            return copy
        link[cur] = copy
        return cur

    def _lookup(self, sequences) -> None:
        """Sorted word hashes, and the word pairs that occur in items, for skipping quickly."""
        names = sorted(self.vocab, key=self.vocab.__getitem__)
        joined = b" ".join(names)
        h = word_hashes(joined)[0] if names else np.zeros(0, np.uint64)
        self.words = names
        order = np.argsort(h)
        self.hashes, self.hash_ids = h[order], order.astype(np.int64)
        n = max(1, len(names))
        self.pairs = np.unique(np.array([a * n + b for _, s in sequences for a, b in zip(s, s[1:])], dtype=np.int64))

    def ids_of(self, hashes: np.ndarray) -> np.ndarray:
        if len(self.hashes) == 0 or len(hashes) == 0:
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.hash_ids[at], -1)

    def runs(self, ids: np.ndarray, least: int) -> list[tuple[int, int]]:
        """Runs of words in which a window can lie: known words, each pair of neighbours in some item."""
        if len(ids) == 0:
            return []
        known = ids >= 0
        if not known.any():
            return []
        code = ids[:-1] * len(self.words) + ids[1:]
        joined = known[:-1] & known[1:]
        where = np.flatnonzero(joined)
        if len(self.pairs) and len(where):
            at = np.minimum(np.searchsorted(self.pairs, code[where]), len(self.pairs) - 1)
            joined[where] = self.pairs[at] == code[where]
        else:
            joined[:] = False
        cut = np.flatnonzero(~joined) + 1
        begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(ids)]))
        ok = (end - begin >= least) & known[begin]
        return list(zip(begin[ok].tolist(), end[ok].tolist()))

    def match(self, ids: list[int], offset: int, spans: list[tuple[int, int]], found: set[int],
              places: dict[int, list[int]] | None = None) -> None:
        """Stream one run; adds hit spans (word indexes, end exclusive) and items, and to ``places`` where
        runs of ``RUN`` words of each item begin."""
        nxt, link, length, window = self.next, self.link, self.len, self.window
        state = matched = 0
        for i, c in enumerate(ids, offset + 1):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            else:
                matched = 0
            if places is not None and matched >= RUN:
                up = state
                while length[link[up]] >= RUN:
                    up = link[up]
                for item in self.items[up]:
                    places[item].append(i - RUN)
            if matched >= window:
                up = state
                while length[link[up]] >= window:
                    up = link[up]
                spans.append((i - window, i))
                found |= self.items[up]
            up = self.above[state]
            while up:
                for size, item in self.whole[up]:
                    if size <= matched:
                        spans.append((i - size, i))
                        found.add(item)
                up = self.above[link[up]]

    def covered(self, ids: list[int], places: dict[int, list[int]], spans: list[tuple[int, int]]) -> None:
        """Adds the stretches that hold enough of an item."""
        num, den = COVER
        for item, begins in places.items():
            for text in self.texts.get(item, ()):
                n = len(text)
                if len(begins) * RUN * den < num * n:
                    continue
                if text not in self.grams:
                    grams = self.grams[text] = defaultdict(list)
                    for k in range(n - RUN + 1):
                        grams[text[k:k + RUN]].append(k)
                grams, times = self.grams[text], [0] * n
                hits = [(p, grams[g]) for p in begins if (g := tuple(ids[p:p + RUN])) in grams]
                of_item = of_doc = left = 0
                for right, (p, at) in enumerate(hits):
                    of_doc += min(RUN, p - hits[right - 1][0]) if right > left else RUN
                    for k in at:
                        for j in range(k, k + RUN):
                            of_item += not times[j]
                            times[j] += 1
                    while (p + RUN - hits[left][0]) * num > n * den:
                        of_doc -= min(RUN, hits[left + 1][0] - hits[left][0])
                        for k in hits[left][1]:
                            for j in range(k, k + RUN):
                                times[j] -= 1
                                of_item -= not times[j]
                        left += 1
                    if min(of_item, of_doc) * den >= num * n:
                        spans.append((hits[left][0], p + RUN))

    def scan(self, data: bytes, cover: bool = False) -> tuple[int, list[tuple[int, int]], set[int]]:
        hashes, starts, ends = word_hashes(data)
        ids = self.ids_of(hashes)
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        places: dict[int, list[int]] | None = defaultdict(list) if cover else None
        known = np.full(len(ids), -1, dtype=np.int64)
        for a, b in self.runs(ids, min(RUN, self.shortest) if cover else self.shortest):
            seq = [i if data[starts[k]:ends[k]] == self.words[i] else -1 for k, i in enumerate(ids[a:b].tolist(), a)]
            self.match(seq, a, spans, found, places)
            known[a:b] = seq
        if places:
            self.covered(known.tolist(), places, spans)
        return len(starts), merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_BUILT: dict[int, ItemAutomaton] = {}


def _automaton(block) -> ItemAutomaton:
    """One automaton per broadcast block and worker."""
    if block.id not in _BUILT:
        _BUILT.clear()
        _BUILT[block.id] = ItemAutomaton(block.payload.value, block.window)
    return _BUILT[block.id]


class _Block:
    def __init__(self, key, payload, window):
        self.id, self.payload, self.window = key, payload, window


def blocks(benchmark: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> list[_Block]:
    """The benchmark in blocks of about ``block_bytes``, each broadcast."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").alias("body")).distinct()
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    out = []
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k).orderBy("item", "body")
        rows = [(r.item, r.body) for r in part.collect()]
        payload = spark.sparkContext.broadcast(rows)
        out.append(_Block((spark.sparkContext.applicationId, id(payload), k), payload, window))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, cover: bool = False) -> DataFrame:
    """``docs`` with n_words, merged hit spans (word indexes, flattened begin/end; with ``cover`` those by coverage too) and item ids."""
    columns = docs.columns
    out = docs.select("*", F.lit(0).cast("long").alias(WORDS), F.array().cast("array<int>").alias(SPANS),
                      F.array().cast("array<string>").alias(ITEMS))
    for block in blocks(benchmark, window, block_bytes):
        out = out.mapInArrow(_scanner(block, columns.index("text"), cover), out.schema)
    return out


def _scanner(block: _Block, text_at: int, cover: bool):
    def run(batches):
        auto = _automaton(block)
        for b in batches:
            n_words, spans, items = [], [], []
            old_spans, old_items = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            for text, s0, i0 in zip(b.column(text_at).to_pylist(), old_spans, old_items):
                n, s, found = auto.scan(fold(text), cover)
                n_words.append(n)
                s = merged(s + list(zip(s0[::2], s0[1::2]))) if s0 else s
                spans.append([x for p in s for x in p])
                items.append(sorted({*i0, *(auto.names[i] for i in found)}))
            cols = [b.column(k) for k in range(b.num_columns - 3)]
            cols += [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: word and hit counts, and the digest of the items found."""
    hit = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), benchmark, window, block_bytes)
    n_hit = F.aggregate(SPANS, F.struct(F.lit(0).cast("long").alias("s"), F.lit(1).alias("sign")),
                        lambda a, x: F.struct((a["s"] - a["sign"] * x).alias("s"), (-a["sign"]).alias("sign")), lambda a: a["s"])
    return hit.select("doc_id", F.col(WORDS).alias("n_words"), n_hit.cast("long").alias("n_hit"),
                      F.size(ITEMS).cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort(ITEMS), ","), 256).alias("items_sha256"),
                      (F.size(SPANS) > 0).alias("contaminated"))


def clean_text(text: str | None, spans: list[int]) -> str | None:
    """The text without the hit words (and what stands between the words of one span)."""
    if not spans or text is None:
        return text
    raw = text.encode("utf-8")
    _, starts, ends = word_hashes(raw.lower())
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(raw[at:starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode("utf-8")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with every hit span cut out of ``text``; clean documents are unchanged."""
    hit = scan(docs, benchmark, window, block_bytes, cover=True)
    at = docs.columns.index("text")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])

    def run(batches):
        for b in batches:
            texts, spans = b.column(at).to_pylist(), b.column(b.num_columns - 2).to_pylist()
            cols = [b.column(k) for k in range(len(schema.fields))]
            cols[at] = pa.array([clean_text(t, s) for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])
    return hit.mapInArrow(run, schema)


_WORDS = """list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[0-9a-z\\x{80}-\\x{10FFFF}]+'), lambda x: x <> '')"""
ORACLE = f"""
WITH item AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS m, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
size AS (SELECT DISTINCT m FROM win),
hit AS (SELECT rid, i, m, item FROM (
    SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (
      SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, size WHERE len(w) >= m)) JOIN win USING (m, g)),
cover AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM hit)) GROUP BY rid),
found AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cover.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
  sha256(coalesce(found.s, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN cover USING (rid) LEFT JOIN found USING (rid)
"""
