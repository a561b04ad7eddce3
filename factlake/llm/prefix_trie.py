"""Prefix trie of conversations by the Euler-tour technique.

Every conversation c is rebuilt: the first h turns of conversation c - c % 20, h = crc32(c) % 4, then
its own turns after the first h.  A node is a distinct sequence of the first d rebuilt turns; the
root has none.  The tree is never walked:

1. Turns are range-sorted by (conversation, turn) and numbered.  A turn at depth d becomes two 64-bit
   hashes of (d, role, text); the exclusive-or of a conversation's first d turns names its prefix (128
   bits), its parent's name is one exclusive-or away, and pieces of a long conversation are combined
   by their own exclusive-ors, so no conversation has to fit into one task.
2. Prefixes are grouped to nodes (pre-aggregated), and one range-sorted pass over each node followed by its
   children links children to parents and next siblings, again in pieces, so that a node may have any number of children.
3. Every node gets an enter and an exit arc; the tour's successors follow from first child, next
   sibling and parent.  The list is ranked by contraction: a block of arcs joins its chains to one
   arc each, first in ranges of conversations (neighbours in the tour are mostly neighbours
   there), then in pairs dealt by coin flips, which join a quarter of the arcs on average in any
   list.  Once one block holds what is left it is ranked, and ranks are handed back level by level.
4. Leaves and savings ride along as weights, so each arc knows their sums over the tour before it;
   a subtree's total is the difference between a node's exit and enter arc.

The digest of the conversations that end in a node joins their numbers in parallel to chunks and
streams the chunks, so memory does not grow with a node either.

Defined results: null role and text are empty; turns come in order of turn (null first), then role,
then text; repeated rows stay.  Rows without conv_id belong to no conversation and are left out.
Remainders of negative numbers keep the sign (SQL's %).  Extra columns are not read.  An empty
table gives no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlake.llm.common import written
from factlake.session import shuffle_width

GROUP = 20          # conversations that share a base
HEADS = 4           # h is below this
BLOCK = 200_000     # arcs that a task contracts at once
CHUNK = 4_096       # conversation numbers joined to one string

NODE = ["depth", "x1", "x2"]
PIECE_OF = lambda seq: F.shiftright(seq, 33)  # noqa: E731  (partition part of monotonically_increasing_id)


def _numbered(df: DataFrame, order: list[Column], label: str, keep: list[str]) -> DataFrame:
    """``df`` range-sorted by ``order`` and written, with its number ``seq`` and its piece ``pid``."""
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order)
    out = written(ranged.select(*keep, F.monotonically_increasing_id().alias("seq")), label)
    return out.withColumn("pid", PIECE_OF(F.col("seq")))


def head_turns(conv_id: Column) -> Column:
    """h: how many turns of the base a conversation starts with."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def _terms(depth: Column, c1: Column, c2: Column) -> list[Column]:
    return [F.xxhash64(depth, c1, c2), F.xxhash64(c2, F.lit(7), depth, c1)]


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, x1, x2 (name), p1, p2 (parent's name), words (of the last turn), is_end: every prefix of every rebuilt conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    turns = turns.filter("conv_id is not null").select(
        "*", F.xxhash64(F.lit(1), "role", "text").alias("c1"), F.xxhash64(F.lit(2), "role", "text").alias("c2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.rand(17)]  # repeated rows spread too
    rows = _numbered(turns, order, "trie-turns", ["conv_id", "c1", "c2", "words"])

    # pieces of conversations: rows before them, and how many turns come from the base
    pieces = rows.groupBy("conv_id", "pid").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy("conv_id")).alias("total"))
    base_of = F.col("conv_id") - F.col("conv_id") % GROUP
    bases = pieces.filter("offset = 0").select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    pieces = pieces.withColumn("base", base_of).join(bases, "base", "left").withColumn("h", head_turns(F.col("conv_id")))
    pieces = written(pieces.select("conv_id", "pid", "base", "offset", "first", "total", "h",
                                   F.least(F.col("h"), F.coalesce("base_total", F.lit(0))).cast("int").alias("m")), "trie-pieces")

    rank = F.col("offset") + F.col("seq") - F.col("first") + 1
    ranked = rows.join(pieces, ["conv_id", "pid"]).withColumn("r", rank)
    depth = (F.col("m") + F.col("r") - F.col("h")).cast("long")
    t1, t2 = _terms(F.col("depth"), F.col("c1"), F.col("c2"))
    ranked = ranked.withColumn("depth", depth).select("conv_id", "pid", "seq", "r", "h", "depth", "c1", "c2", "words", t1.alias("t1"), t2.alias("t2"),
                                                      (F.col("r") == F.col("total")).alias("is_end"))
    ranked = written(ranked, "trie-ranked")

    # the base's part of every conversation: at most three turns
    heads = ranked.filter((F.col("conv_id") % GROUP == 0) & (F.col("r") < HEADS)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("r", "c1", "c2", "words"))).alias("heads"))
    convs = pieces.filter("offset = 0").join(heads, "base", "left")
    zero = F.lit(0).cast("long")
    steps, x1, x2 = [F.struct(zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("words"))], zero, zero
    for k in range(1, HEADS):
        turn = F.get(F.col("heads"), F.lit(k - 1))
        t1, t2 = _terms(F.lit(k).cast("long"), turn["c1"], turn["c2"])
        p1, p2, x1, x2 = x1, x2, _xor(x1, t1), _xor(x2, t2)
        steps.append(F.struct(F.lit(k).cast("long").alias("depth"), x1.alias("x1"), x2.alias("x2"), p1.alias("p1"), p2.alias("p2"), turn["words"].alias("words")))
    convs = convs.select("conv_id", "m", (F.col("total") <= F.col("h")).alias("only_head"), F.slice(F.array(*steps), F.lit(1), F.col("m") + 1).alias("steps"))
    convs = written(convs, "trie-heads")
    headed = convs.select("conv_id", "m", "only_head", F.explode("steps").alias("s")).select(
        "conv_id", "s.*", (F.col("only_head") & (F.col("s.depth") == F.col("m"))).alias("is_end"))

    # its own part: exclusive-or within the piece, on top of earlier pieces and of the head
    own = ranked.filter(F.col("r") > F.col("h"))
    sums = own.groupBy("conv_id", "pid").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    last = F.element_at("steps", -1)
    starts = sums.join(convs.select("conv_id", last["x1"].alias("h1"), last["x2"].alias("h2")), "conv_id")
    starts = starts.select("conv_id", "pid", *[_xor(F.col("h" + k), F.coalesce(F.bit_xor("s" + k).over(before), zero)).alias("b" + k) for k in "12"])
    inside = Window.partitionBy("conv_id", "pid").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    own = own.join(starts, ["conv_id", "pid"]).select("conv_id", "depth", "words", "is_end", "t1", "t2", *[
        _xor(F.col("b" + k), F.bit_xor("t" + k).over(inside)).alias("x" + k) for k in "12"])
    own = own.select("conv_id", "depth", "x1", "x2", _xor(F.col("x1"), F.col("t1")).alias("p1"), _xor(F.col("x2"), F.col("t2")).alias("p2"), "words", "is_end")
    return written(headed.unionByName(own), "trie-prefixes")


def tree(prefix_rows: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, x1, x2, n_convs, words, parent, next_sibling, first_child (all by conv_id), n_children."""
    nodes = written(prefix_rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
                                                   F.max("p1").alias("p1"), F.max("p2").alias("p2")), "trie-nodes")
    none = F.lit(None).cast("long")
    heads = nodes.select(*NODE, F.lit(0).alias("kind"), "conv_id", "n_convs", "words")
    children = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.lit(1).alias("kind"),
                                                "conv_id", none.alias("n_convs"), none.alias("words"))
    order = [*NODE, "kind", "conv_id"]
    family = _numbered(heads.unionByName(children), [F.col(c) for c in order], "trie-families", [*order, "n_convs", "words"])
    child = F.when(F.col("kind") == 1, F.col("conv_id"))
    pieces = family.groupBy(*NODE, "pid").agg(F.min(child).alias("first"), F.count(child).alias("n"), F.max(F.when(F.col("kind") == 0, F.col("conv_id"))).alias("head"))
    whole = Window.partitionBy(*NODE)
    pieces = pieces.select(*NODE, "pid", F.lead("first").over(whole.orderBy("pid")).alias("next_first"), F.max("head").over(whole).alias("head"),
                           F.min("first").over(whole).alias("first_child"), F.sum("n").over(whole).alias("n_children"))
    ahead = F.lead("conv_id").over(Window.partitionBy(*NODE, "pid").orderBy("seq"))
    linked = family.withColumn("ahead", ahead).join(pieces, [*NODE, "pid"])
    is_head = F.col("kind") == 0
    linked = linked.select("conv_id", (F.col("depth") + F.col("kind")).alias("depth"), *[F.when(is_head, F.col(c)).alias(c) for c in ("x1", "x2", "n_convs", "words", "first_child", "n_children")],
                           F.when(~is_head, F.col("head")).alias("parent"), F.when(~is_head, F.coalesce("ahead", "next_first")).alias("next_sibling"))
    values = ["x1", "x2", "n_convs", "words", "first_child", "n_children", "parent", "next_sibling"]
    return written(linked.groupBy("conv_id", "depth").agg(*[F.max(c).alias(c) for c in values]), "trie-tree")


def tour(nodes: DataFrame) -> DataFrame:
    """Arcs (a, b) = (conv_id, 2 * depth, + 1 on exit) with successor (sa, sb), null at the end, and weights: 1, leaves, savings."""
    code = F.col("depth") * 2
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    leaf = F.col("first_child").isNull()
    enter = nodes.select(F.col("conv_id").alias("a"), code.alias("b"), F.coalesce("first_child", "conv_id").alias("sa"), F.when(leaf, code + 1).otherwise(code + 2).alias("sb"),
                         one.alias("w0"), leaf.cast("long").alias("w1"), ((F.col("n_convs") - 1) * F.col("words")).alias("w2"))
    leave = nodes.select(F.col("conv_id").alias("a"), (code + 1).alias("b"), F.coalesce("next_sibling", "parent").alias("sa"),
                         F.when(F.col("next_sibling").isNotNull(), code).when(F.col("parent").isNotNull(), code - 1).alias("sb"),
                         one.alias("w0"), zero.alias("w1"), zero.alias("w2"))
    return enter.unionByName(leave)


ARC = "a long, b long, sa long, sb long, w0 long, w1 long, w2 long"
JOINED = "a long, b long, ha long, hb long, e0 long, e1 long, e2 long, sa long, sb long, w0 long, w1 long, w2 long"


def join_chains(a, b, sa, sb, has_next, w):
    """Chains of a block of arcs: (head of every arc, weights before it in its chain, tails, heads of the tails)."""
    n = len(a)
    _, ka = np.unique(np.concatenate((a, sa)), return_inverse=True)
    ub, kb = np.unique(np.concatenate((b, sb)), return_inverse=True)
    key = ka.astype(np.int64) * len(ub) + kb
    order = np.argsort(key[:n])
    found = order[np.minimum(np.searchsorted(key[:n][order], key[n:]), n - 1)]
    inside = has_next & (key[:n][found] == key[n:])
    back = np.full(n, -1)
    back[found[inside]] = np.flatnonzero(inside)
    before = np.where(back >= 0, w[:, back], 0)
    head = np.where(back >= 0, back, np.arange(n))
    while True:  # pointers double their reach
        live = np.flatnonzero(back >= 0)
        if not len(live):
            break
        before[:, live] += before[:, back[live]]
        back[live] = back[back[live]]
        head = head[head]
    tails = np.flatnonzero(~inside)
    return head, before, tails


def _contract(block: int):
    names = [c.split()[0] for c in JOINED.split(", ")]

    def one(part: pa.Table) -> pa.RecordBatch:
        a, b = (part.column(k).to_numpy() for k in (0, 1))
        has_next = part.column(2).is_valid().to_numpy()
        sa, sb = (part.column(k).fill_null(0).to_numpy() for k in (2, 3))
        w = np.stack([part.column(k).to_numpy() for k in (4, 5, 6)])
        head, before, tails = join_chains(a, b, sa, sb, has_next, w)
        # the row of a chain's head also carries the chain as one arc
        chain = np.full(len(a), -1)
        chain[head[tails]] = tails
        is_head, t = chain >= 0, np.maximum(chain, 0)
        more = is_head & has_next[t]
        total = before[:, t] + w[:, t]
        cols = [pa.array(a), pa.array(b), pa.array(a[head]), pa.array(b[head]), *[pa.array(x) for x in before],
                pa.array(sa[t], mask=~more), pa.array(sb[t], mask=~more), *[pa.array(x, mask=~is_head) for x in total]]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, block - rows)
                held.append(take)
                rows += take.num_rows
                batch = batch.slice(take.num_rows)
                if rows == block:
                    yield one(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield one(pa.Table.from_batches(held))
    return run


def ranked_tour(arcs: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, b, e0, e1, e2: the sums of the weights of all arcs before each arc of the list."""
    levels = []
    current = written(arcs, "tour-arcs")
    dealt = current.repartitionByRange(shuffle_width(arcs.sparkSession), "a", "b").sortWithinPartitions("a", "b")
    while True:
        joined = written(dealt.select("a", "b", "sa", "sb", "w0", "w1", "w2").mapInArrow(_contract(block), JOINED), f"tour-level-{len(levels)}")
        levels.append(joined)
        current = joined.filter("w0 is not null").select("a", "b", "sa", "sb", "w0", "w1", "w2")
        left = current.count()
        if left <= 1:
            break
        if left <= block:
            dealt = current.coalesce(1)
        else:
            joins = (F.pmod(F.xxhash64("a", "b", F.lit(len(levels))), F.lit(2)) == 1) & F.col("sa").isNotNull()
            paired = current.select("*", F.when(joins, F.col("sa")).otherwise(F.col("a")).alias("ka"), F.when(joins, F.col("sb")).otherwise(F.col("b")).alias("kb"))
            dealt = paired.repartition("ka", "kb").sortWithinPartitions("ka", "kb")
    sums = None
    for level in reversed(levels):
        rows = level.select("a", "b", "ha", "hb", "e0", "e1", "e2")
        if sums is None:
            sums = rows.drop("ha", "hb")
            continue
        above = sums.select(F.col("a").alias("ha"), F.col("b").alias("hb"), *[F.col(f"e{k}").alias(f"f{k}") for k in range(3)])
        sums = rows.join(above, ["ha", "hb"]).select("a", "b", *[(F.col(f"e{k}") + F.col(f"f{k}")).alias(f"e{k}") for k in range(3)])
    return sums


def end_digests(prefix_rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """depth, x1, x2, ends_sha256: digest of the numbers of the conversations that end in a node, ascending."""
    ends = prefix_rows.filter("is_end").select(*NODE, "conv_id")
    ordered = ends.repartitionByRange(shuffle_width(ends.sparkSession), *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def join_numbers(batches):
        for b in batches:
            keys = np.stack([b.column(k).to_numpy() for k in range(3)])
            new = np.flatnonzero(np.any(np.diff(keys, axis=1, prepend=keys[:, :1] - 1) != 0, axis=0)).tolist()
            numbers = b.column(3).to_pylist()
            cuts = sorted({at for a, z in zip(new, [*new[1:], b.num_rows]) for at in range(a, z, chunk)})
            texts = [",".join(map(str, numbers[a:z])) for a, z in zip(cuts, [*cuts[1:], b.num_rows])]
            rows = b.take(pa.array(cuts))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=[*NODE, "first", "numbers"])

    def digest(batches):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        at, sha = None, None
        for b in batches:
            out = []
            for *key, text in zip(*(b.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if key != at:
                    if at is not None:
                        out.append((*at, sha.hexdigest()))
                    at, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[*NODE, "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*at, sha.hexdigest()), kinds)], names=[*NODE, "ends_sha256"])
    chunks = ordered.mapInArrow(join_numbers, "depth long, x1 long, x2 long, first long, numbers string")
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth long, x1 long, x2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = prefixes(conversations)
    nodes = tree(rows)
    sums = ranked_tour(tour(nodes), block)
    side = F.col("b") % 2
    span = lambda c: (F.max(F.when(side == 1, F.col(c))) - F.max(F.when(side == 0, F.col(c))))
    totals = sums.groupBy(F.col("a").alias("conv_id"), F.shiftright("b", 1).alias("depth")).agg(span("e1").alias("n_leaves"), span("e2").alias("saved_tokens"))
    out = nodes.join(totals, ["conv_id", "depth"]).join(end_digests(rows), NODE, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", empty).alias("ends_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([4294967295::BIGINT],
      flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda k: [ascii(substr(conv_id::VARCHAR, k, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384::BIGINT) ELSE acc >> 1 END), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), s AS (
  SELECT c.conv_id, 0 AS part, t.r, t.role, t.body FROM c JOIN t ON t.conv_id = c.base AND t.r <= c.h
  UNION ALL SELECT c.conv_id, 1, t.r, t.role, t.body FROM c JOIN t ON t.conv_id = c.conv_id AND t.r > c.h
), l AS (
  SELECT c.conv_id, coalesce(x.turns, []) AS turns FROM c LEFT JOIN (SELECT conv_id, list({'role': role, 'body': body} ORDER BY part, r) AS turns FROM s GROUP BY 1) x USING (conv_id)
), p AS (
  SELECT conv_id, d AS depth, len(turns) = d AS ended, CASE WHEN d = 0 THEN NULL ELSE turns[d].body END AS last, turns[1:d] AS path
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM l)
), q AS (SELECT conv_id, depth, ended, last, min(conv_id) OVER (PARTITION BY depth, path) AS node FROM p),
n AS (
  SELECT node, depth, count(*) AS n_convs, coalesce(len(regexp_extract_all(any_value(last), '[^\x20\x09-\x0D]+')), 0) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM q GROUP BY 1, 2
), up AS (
  SELECT n.*, q.node AS parent FROM n LEFT JOIN q ON q.conv_id = n.node AND q.depth = n.depth - 1
), kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS k FROM up WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT up.*, coalesce(k, 0) AS n_children FROM up LEFT JOIN kids USING (node, depth)),
sub AS (
  SELECT q.node, q.depth, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
  FROM full_nodes f JOIN q ON q.conv_id = f.node AND q.depth <= f.depth GROUP BY 1, 2
)
SELECT f.node::BIGINT AS conv_id, f.depth::BIGINT AS depth, f.parent::BIGINT AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       sub.n_leaves::BIGINT AS n_leaves, sub.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sub ON sub.node = f.node AND sub.depth = f.depth
"""
