"""Exact Jaccard links (sets of five-word shingles, similarity 0.8 or more) with a MinHash LSH forest.

1. Every text becomes its set of shingle hashes.  Texts with equal sets are copies: one
   class member with a multiplicity, never expanded.
2. Each distinct set gets ``TREES`` signatures of ``DEPTH`` minima.  In each tree the signatures are
   sorted, which is a prefix trie: what a signature shares with its neighbours is the longest
   prefix it shares with anyone.  Signatures alone in their shortest prefix leave here.
3. One ordered pass climbs each trie from the full depth: members meet at their longest shared
   prefixes first, and the matched prefix is shortened, minimum by minimum, for the members
   whose chance to meet a link of least similarity is still below ``TARGET``.  That similarity
   depends on the size of the set (six shingles: 5/6), so documents stop at different depths.
   Members within ``TIGHT`` bytes of an earlier member's sketch are tied to it and climb no
   further; the others are tied to every part of their prefix with a member less than ``FAR``
   away.  A prefix yields one edge a member, to the least of its part.
   A pair that meets has sketches at most 6 standard deviations from its similarity apart; ties
   add at most ``TIGHT`` a level on both sides, so ``FAR`` loses none of them.
   Connected components of the edges are the clusters to verify.
4. Inside a cluster all pairs are verified on their whole shingle sets, with intersections counted as
   matrix products in strips.  Clusters over ``BLOCK`` members or ``BLOCK_SHINGLES`` shingles are
   split into blocks and each pair of blocks is a task of its own.  Only degrees and labels leave a task.
5. Verified links' components are the classes.

Result per document: class_id (smallest doc_id of the class), n_links (documents linked to it,
copies included) and n_copies (other documents with the same shingle set).

Defined results: texts without a word (null, empty) link to nothing and are a class each.
Texts of fewer than five words have one shingle of all their words.  Repeated rows are
copies.  A null doc_id sorts first in ties and gives a null class_id if it is the smallest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factlake.llm.bytewords import fold, shingles, word_hashes
from factlake.llm.common import written

SHINGLE = 5
NUM, DEN = 4, 5  # threshold 0.8 as a fraction: exact in integers
TREES, DEPTH, TARGET = 32, 6, 1 - 1e-6
WIDTH = 2    # bytes a minimum in a signature
SKETCH = 64  # one byte each, for telling near from far members of a prefix
TIGHT = 1    # sketches that differ in no more bytes are one member for what follows
BLOCK = 3_000
BLOCK_SHINGLES = 4_000_000
NO_ID = -(1 << 63)

_SEEDS = np.random.default_rng(20_240_501).integers(1, 1 << 63, size=(2, TREES * DEPTH), dtype=np.uint64)
_SEEDS[0] |= np.uint64(1)


def recall(depth: int, trees: int = TREES, threshold: float = NUM / DEN) -> float:
    return 1 - (1 - threshold ** depth) ** trees


def match_depth(trees: int = TREES, depth: int = DEPTH, threshold: float = NUM / DEN, target: float = TARGET) -> int:
    """The matched prefix, shortened until the recall at the threshold reaches the target."""
    while depth > 1 and recall(depth, trees, threshold) < target:
        depth -= 1
    return depth


SHORTEST = match_depth()
#: Bytes in which the sketches of a linked pair's representatives can differ: its own distance
#: (mean and 6 standard deviations) and the ties of both members on every level.
FAR = round(SKETCH * (1 - NUM / DEN) + 6 * (SKETCH * NUM * (DEN - NUM)) ** 0.5 / DEN) + 2 * TIGHT * (DEPTH - SHORTEST + 1)


def least_similarity(size: int) -> float:
    """Smallest similarity, short of equality, that a link of a set of ``size`` can have (1: none)."""
    if size > DEN * DEN:
        return NUM / DEN  # close enough: the recall at the threshold itself is a lower bound
    least = 1.0
    for union in range(size, DEN * size // NUM + 1):
        common = min(size, -(-NUM * union // DEN))
        if common < union and DEN * common >= NUM * union:
            least = min(least, common / union)
    return least


def stop_depth(size: int) -> int:
    """The prefix at which a set of ``size`` has its target recall."""
    return match_depth(threshold=least_similarity(size))


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingles(word_hashes(fold(text))[0], SHINGLE))


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def minima(s: np.ndarray) -> np.ndarray:
    """TREES * DEPTH minima (upper 32 bits) of a shingle set."""
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(s), 4_096):
        h = s[at:at + 4_096][None, :] * _SEEDS[0][:, None] + _SEEDS[1][:, None]
        np.minimum(out, (h >> np.uint64(32)).astype(np.uint32).min(axis=1), out=out)
    return out


def _signatures(batches):
    for b in batches:
        keys, sizes, forests, sketches = [], [], [], []
        for text in b.column(1).to_pylist():
            s = shingle_set(text)
            sizes.append(len(s))
            if len(s) == 0:
                keys.append(None)
                forests.append(None)
                sketches.append(None)
                continue
            m = minima(s)
            keys.append(set_key(s))
            forests.append(((m * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2").tobytes())
            sketches.append((m[:SKETCH] & np.uint32(0xFF)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(forests, pa.binary()), pa.array(sketches, pa.binary())],
            names=["doc_id", "content", "rid", "size", "forest", "sketch"])


class _Level:
    """Members of the open prefix of one depth: sketches, and a part of each (perhaps joined to others since)."""

    def __init__(self):
        self.ids: list[int] = []
        self.sketches = np.empty((16, SKETCH), dtype=np.uint8)
        self.parts = np.empty(16, dtype=np.int64)

    def append(self, k: int, sketch: np.ndarray, part: int) -> None:
        n = len(self.ids)
        if n == len(self.parts):
            self.sketches = np.concatenate((self.sketches, np.empty_like(self.sketches)))
            self.parts = np.concatenate((self.parts, np.empty_like(self.parts)))
        self.sketches[n], self.parts[n] = sketch, part
        self.ids.append(k)

    def distances(self, sketch: np.ndarray) -> np.ndarray:
        return np.count_nonzero(self.sketches[:len(self.ids)] != sketch, axis=1)


class _Subtree:
    """The open path of a trie below one shortest prefix.  Holds members that no earlier one stands for."""

    def __init__(self):
        self.rids: list[bytes] = []
        self.stops: list[int] = []
        self.sketches: list[np.ndarray] = []
        self.part: list[int] = []
        self.levels = {d: _Level() for d in range(SHORTEST, DEPTH + 1)}
        self.edges: list[tuple[bytes, bytes]] = []

    def _root(self, k: int) -> int:
        while self.part[k] != k:
            self.part[k] = self.part[self.part[k]]
            k = self.part[k]
        return k

    def _join(self, a: int, b: int) -> None:
        a, b = self._root(a), self._root(b)
        if a != b:
            low, high = (a, b) if self.rids[a] <= self.rids[b] else (b, a)
            self.part[high] = low

    def _meet(self, depth: int, k: int) -> int | None:
        """Member ``k`` comes to its prefix of ``depth``; the member that stands for it from here on, if any."""
        level, other = self.levels[depth], None
        if level.ids:
            far = level.distances(self.sketches[k])
            at = int(np.argmin(far))
            if far[at] <= TIGHT:
                other = level.ids[at]
                self.stops[other] = min(self.stops[other], self.stops[k])
            anchor = k if other is None else other
            parts = level.parts[:len(level.ids)]
            near = np.unique(parts[far <= FAR])
            for part in near.tolist():
                self._join(anchor, part)
            if len(near) > 1:
                parts[np.isin(parts, near)] = self._root(anchor)
        if other is None:
            level.append(k, self.sketches[k], self._root(k))
        return other

    def add(self, rid: bytes, stop: int, sketch: bytes) -> None:
        k = len(self.rids)
        self.rids.append(rid)
        self.stops.append(stop)
        self.sketches.append(np.frombuffer(sketch, np.uint8))
        self.part.append(k)
        other = self._meet(DEPTH, k)
        if other is not None:
            self.edges.append((self.rids[other], rid))  # an edge at once: nothing of it is kept
            for kept in (self.rids, self.stops, self.sketches, self.part):
                kept.pop()

    def shorten(self, shared: int) -> None:
        """The next signature shares ``shared`` minima: members climb from the deeper prefixes, until they have their recall."""
        for depth in range(DEPTH, max(shared, SHORTEST), -1):
            for k in self.levels[depth].ids:
                if self.stops[k] < depth:
                    other = self._meet(depth - 1, k)
                    if other is not None:
                        self._join(k, other)
            self.levels[depth] = _Level()

    def close(self) -> list[tuple[bytes, bytes]]:
        self.shorten(SHORTEST)
        roots = (self._root(k) for k in range(len(self.rids)))
        return self.edges + [(self.rids[r], self.rids[k]) for k, r in enumerate(roots) if r != k]


def shared_minima(x: bytes, y: bytes) -> int:
    n = 0
    while n < DEPTH and x[n * WIDTH:(n + 1) * WIDTH] == y[n * WIDTH:(n + 1) * WIDTH]:
        n += 1
    return n


def _trie_edges(batches):
    """Rows (tree, signature, rid, size, sketch) in trie order -> edges of each shortest prefix."""
    at, subtree, out = None, _Subtree(), []
    stops: dict[int, int] = {}
    for b in batches:
        for tree, sig, rid, size, sketch in zip(*(b.column(k).to_pylist() for k in range(5))):
            if at is not None:
                shared = shared_minima(at[1], sig) if at[0] == tree else 0
                if shared < SHORTEST:
                    out += subtree.close()
                    subtree = _Subtree()
                elif shared < DEPTH:
                    subtree.shorten(shared)
            at = (tree, sig)
            size = min(size, DEN * DEN + 1)
            if size not in stops:
                stops[size] = stop_depth(size)
            subtree.add(rid, stops[size], sketch)
        out, subtree.edges = out + subtree.edges, []
        yield _edge_batch(out)
        out = []
    yield _edge_batch(out + subtree.close())


def _edge_batch(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(e) for e in edges], pa.binary()), pa.array([max(e) for e in edges], pa.binary())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(v, c): smallest vertex of each vertex's component, by contraction.

    A round points every vertex at its least neighbour, follows the pointers to their ends and keeps the
    edges between different ends, once each: at least half of the vertices that have edges go.  Rounds are
    written to the shared folder; only whether anything is left reaches the driver.
    """
    edges = written(edges.distinct(), "cc-edges")
    labels = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct().withColumn("c", F.col("v"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("v", "w")
        ends = written(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("e")), "cc-ends")
        while True:
            follow = ends.join(ends.select(F.col("v").alias("e"), F.col("e").alias("f")), "e")
            step = written(follow.select("v", F.col("f").alias("e"), (F.col("f") != F.col("e")).alias("moved")), "cc-ends")
            ends = step.select("v", "e")
            if step.filter("moved").isEmpty():
                break
        labels = written(labels.join(ends.select(F.col("v").alias("c"), "e"), "c", "left").select("v", F.coalesce("e", "c").alias("c")), "cc-labels")
        one, two = ends.toDF("a", "x"), ends.toDF("b", "y")
        left = edges.join(one, "a").join(two, "b").filter("x <> y")
        edges = written(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
    return labels


RARE = 32
STRIP = 256
COLUMNS = 2_048


def links_within(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact links between members i in ``left`` and j in ``right`` (boolean masks; a pair counts
    if it lies across, either way round): (weighted degrees, component labels)."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(m), sizes)
    values, inverse, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(inverse, kind="stable")
    posted = owner[order]
    begin = np.concatenate(([0], np.cumsum(df)[:-1]))
    codes = []
    for d in range(2, min(RARE, m) + 1):  # rare shingles: the pairs of their few members
        lists = posted[begin[df == d][:, None] + np.arange(d)[None, :]]
        if len(lists):
            i, j = np.triu_indices(d, 1)
            codes.append((lists[:, i] * m + lists[:, j]).ravel())
            codes.append((lists[:, j] * m + lists[:, i]).ravel())
    pair_code, pair_n = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    common = np.flatnonzero(df > RARE)  # common shingles: columns of a member matrix
    column = np.full(len(values), -1, dtype=np.int64)
    column[common] = np.arange(len(common))
    matrix = np.zeros((m, len(common)), dtype=np.uint8)
    col = column[inverse]
    matrix[owner[col >= 0], col[col >= 0]] = 1
    degrees = np.zeros(m, dtype=np.int64)
    packed = np.zeros((m, (m + 7) // 8), dtype=np.uint8)
    for a in range(0, m, STRIP):
        z = min(m, a + STRIP)
        inter = np.zeros((z - a, m), dtype=np.float32)
        for c in range(0, len(common), COLUMNS):
            part = matrix[:, c:c + COLUMNS].astype(np.float32)
            inter += part[a:z] @ part.T
        count = inter.astype(np.int64)
        lo, hi = np.searchsorted(pair_code, [a * m, z * m])
        np.add.at(count.reshape(-1), pair_code[lo:hi] - a * m, pair_n[lo:hi])
        union = sizes[a:z, None] + sizes[None, :] - count
        link = DEN * count >= NUM * union
        link &= (left[a:z, None] & right[None, :]) | (right[a:z, None] & left[None, :])
        link[np.arange(z - a), np.arange(a, z)] = False
        degrees[a:z] = (link * weights[None, :]).sum(axis=1)
        packed[a:z] = np.packbits(link, axis=1)
    labels = np.arange(m)
    while True:
        new = labels.copy()
        for a in range(0, m, STRIP):
            z = min(m, a + STRIP)
            link = np.unpackbits(packed[a:z], axis=1, count=m).astype(bool)
            new[a:z] = np.minimum(new[a:z], np.where(link, labels[None, :], m).min(axis=1))
        new = np.minimum(new, new[new])
        if (new == labels).all():
            return degrees, labels
        labels = new


def _verify(group: pa.Table) -> pa.Table:
    """Members of one pair of blocks of a cluster -> degrees and labels."""
    seen: dict[bytes, int] = {}
    rids, sets, block, weight = [], [], [], []
    for rid, data, b, w in zip(*(group.column(c).to_pylist() for c in ("rid", "shingles", "block", "copies"))):
        if rid not in seen:
            seen[rid] = len(rids)
            rids.append(rid)
            sets.append(np.frombuffer(data, np.uint64))
            block.append(b)
            weight.append(w)
    one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
    block = np.array(block)
    degrees, labels = links_within(sets, block == one, block == two, np.array(weight, dtype=np.int64))
    # the label is the smallest rid of the component, the same whatever the order of the rows
    least: dict[int, bytes] = {}
    for k, lab in enumerate(labels.tolist()):
        least[lab] = min(least.get(lab, rids[k]), rids[k])
    return pa.table({"rid": pa.array(rids, pa.binary()), "degree": pa.array(degrees, pa.int64()),
                     "label": pa.array([least[lab] for lab in labels.tolist()], pa.binary()),
                     "parts": pa.array([group.column("parts")[0].as_py()] * len(rids), pa.int32())})


def _member_sets(batches):
    """Documents that stand for a cluster member -> its shingle set (checked against its key)."""
    for b in batches:
        rid, data = b.column("rid").to_pylist(), []
        for r, text in zip(rid, b.column("text").to_pylist()):
            s = shingle_set(text)
            data.append(s.tobytes() if set_key(s) == r else None)
        keep = pa.array([d is not None for d in data])
        cols = {c: b.column(c) for c in ("cluster", "rid", "copies", "parts", "block")} | {"shingles": pa.array(data, pa.binary())}
        yield pa.RecordBatch.from_arrays([c.filter(keep) for c in cols.values()], names=list(cols))


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, content (hash of the text), rid (None without words), size, forest (signatures of all trees), sketch of every document, written once."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("content"))
    return written(narrow.mapInArrow(_signatures, "doc_id long, content long, rid binary, size int, forest binary, sketch binary"), "forest-sets")


def tries(distinct: DataFrame) -> DataFrame:
    """(tree, signature, rid, size, sketch) in trie order, of the signatures that share their shortest prefix with another."""
    step = DEPTH * WIDTH
    rows = distinct.select("rid", "forest", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select("rid", "tree", F.expr(f"substring(forest, tree * {step} + 1, {step})").alias("signature"))
    rows = rows.withColumn("shortest", F.expr(f"substring(signature, 1, {SHORTEST * WIDTH})"))
    order = W.partitionBy("tree", "shortest").orderBy("signature")
    shared = rows.select("*", F.lag("rid").over(order).alias("before"), F.lead("rid").over(order).alias("after"))
    shared = shared.filter("before is not null or after is not null").drop("before", "after")
    met = shared.join(distinct.select("rid", "size", "sketch"), "rid")
    return met.repartition("tree", "shortest").sortWithinPartitions("tree", "signature", "rid").select("tree", "signature", "rid", "size", "sketch")


def classes(docs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """(rid, copies, least_id, least_text, degree, label) of every distinct shingle set.

    least_id and least_text (hash) name the document that stands for the set: ids alone can repeat or be null."""
    sets = sets_of(docs) if sets is None else sets
    id_ = F.coalesce("doc_id", F.lit(NO_ID))
    distinct = written(sets.filter("rid is not null").groupBy("rid").agg(
        F.count("*").alias("copies"), F.min(F.struct(id_.alias("id"), F.col("content"))).alias("least"), F.first("size").alias("size"),
        F.first("forest").alias("forest"), F.first("sketch").alias("sketch")).select(
        "rid", "copies", F.col("least.id").alias("least_id"), F.col("least.content").alias("least_text"), "size", "forest", "sketch"), "forest-distinct")
    near = written(tries(distinct).mapInArrow(_trie_edges, "a binary, b binary").distinct(), "forest-edges")
    clusters = components(near).toDF("rid", "cluster").join(distinct.select("rid", "size"), "rid")
    blocks = F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)
    parts = clusters.groupBy("cluster").agg(F.least(F.ceil(blocks), F.count("*")).cast("int").alias("parts"))
    clusters = clusters.drop("size")
    members = clusters.join(parts, "cluster").join(distinct.select("rid", "copies", "least_id", "least_text"), "rid").withColumn(
        "block", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("least_id"), F.xxhash64("text").alias("least_text"), "text")
    shingled = texts.join(members, ["least_id", "least_text"]).select("cluster", "rid", "copies", "parts", "block", "text").mapInArrow(
        _member_sets, "cluster binary, rid binary, copies long, parts int, block int, shingles binary")
    spread = shingled.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    spread = spread.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("other")
    verified = written(spread.groupBy("cluster", "one", "two").applyInArrow(_verify, "rid binary, degree long, label binary, parts int"), "forest-links")
    degree = verified.groupBy("rid").agg(F.sum("degree").alias("degree"), F.min("label").alias("label"), F.max("parts").alias("parts"))
    split = verified.filter("parts > 1")
    if not split.isEmpty():  # labels of different pairs of blocks are joined up
        whole = components(split.select(F.col("rid").alias("a"), F.col("label").alias("b"))).toDF("rid", "joined")
        degree = degree.join(whole, "rid", "left").withColumn("label", F.coalesce("joined", "label"))
    linked = degree.select("rid", "degree", "label")
    return distinct.select("rid", "copies", "least_id", "least_text").join(linked, "rid", "left").select(
        "rid", "copies", "least_id", "least_text", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("label", "rid").alias("label"))


def links(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id, n_links, n_copies."""
    sets = sets_of(docs)
    found = written(classes(docs, sets), "forest-classes")
    least = found.groupBy("label").agg(F.min("least_id").alias("class_id"))
    by_set = found.join(least, "label").select("rid", "class_id", (F.col("degree") + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"))
    out = sets.select("doc_id", "rid").join(by_set, "rid", "left")
    zero = F.lit(0).cast("long")
    class_id = F.when(F.col("rid").isNull(), F.col("doc_id")).otherwise(F.nullif("class_id", F.lit(NO_ID)))
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_copies", zero).alias("n_copies"))


def one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id (of repeated doc_ids
    that hold the class's text one row); documents without words all stay."""
    sets = sets_of(docs)
    found = written(classes(docs, sets), "forest-classes")
    least = found.groupBy("label").agg(F.min(F.struct("least_id", "rid", "least_text")).alias("best")).select("best.*")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    keep = least.select(F.col("least_id").alias("__id"), F.col("least_text").alias("__content"), F.col("rid").alias("__rid"))
    columns = docs.columns

    keyed = docs.withColumn("__id", id_).withColumn("__content", F.xxhash64("text"))
    member = docs.select(*columns, id_.alias("__id"), F.lit(None).cast("binary").alias("__rid")).schema
    chosen = keyed.join(keep, ["__id", "__content"], "inner").mapInArrow(_only_member(columns), member)
    chosen = chosen.dropDuplicates(["__id", "__rid"]).select(*columns)
    wordless = docs.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"))
    return chosen.unionByName(wordless)


def _only_member(columns: list[str]):
    """Rows whose text has the class's shingle set (doc_ids can repeat with other texts)."""
    def run(batches):
        for b in batches:
            names = b.schema.names
            text, rid = b.column(names.index("text")).to_pylist(), b.column(names.index("__rid")).to_pylist()
            keep = pa.array([set_key(shingle_set(t)) == r for t, r in zip(text, rid)], pa.bool_())
            cols = [b.column(names.index(c)).filter(keep) for c in [*columns, "__id", "__rid"]]
            yield pa.RecordBatch.from_arrays(cols, names=[*columns, "__id", "__rid"])
    return run


_WORDS = """list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[0-9a-z\\x{80}-\\x{10FFFF}]+'), lambda x: x <> '')"""
ORACLE = f"""
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
sh AS (SELECT DISTINCT rid, array_to_string(w[i:i + least({SHINGLE}, len(w)) - 1], ' ') AS s FROM (
  SELECT rid, w, unnest(range(1, greatest(1, len(w) - {SHINGLE - 1}) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
link AS (SELECT a, b, c = x.n AND c = y.n AS same FROM (SELECT p.rid AS a, q.rid AS b, count(*) AS c FROM sh p JOIN sh q USING (s) WHERE p.rid <> q.rid GROUP BY 1, 2)
  JOIN size x ON x.rid = a JOIN size y ON y.rid = b WHERE {DEN} * c >= {NUM} * (x.n + y.n - c)),
reach AS (SELECT rid AS a, rid AS b FROM doc UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
class AS (SELECT a AS rid, min(doc_id) AS class_id FROM reach JOIN doc ON doc.rid = b GROUP BY a),
degree AS (SELECT a AS rid, count(*) AS n, count(*) FILTER (WHERE same) AS k FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(k, 0)::BIGINT AS n_copies FROM doc JOIN class USING (rid) LEFT JOIN degree USING (rid)
"""
