"""Prefix trie against a plain tree walk and SQL, with tiny blocks, long conversations and odd rows."""

import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from factlake.llm import prefix_trie, queries
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.brute import sha
from tools.oracle_compare import compare, register_views

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    for c in turns:
        turns[c].sort()
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        path = tuple(x[2:] for x in turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = own + sum(saved[k] for k in kids[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   sha(",".join(map(str, sorted(ends[p]))))) for p, m in members.items())


def result(df):
    return sorted(tuple(-1 if v is None else v for v in (r[c] for c in COLUMNS)) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, 1, "y") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, depth int, seq string")


def made(n, seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        c = rnd.choice([c, c, c // 20 * 20 + 1, -c])
        for t in range(rnd.choice([1, 2, 3, 5, 6])):
            rows.append((c, rnd.choice([t, t, t, None, 0]), rnd.choice(["user", "assistant", None, ""]), rnd.choice(["a b", "a b", " c\n d", None, "", "é x y"])))
    return rows + [(None, 0, "user", "lost")] + rows[:7]


@pytest.mark.parametrize("block", [2, 7, 200_000])
def test_small_blocks_and_odd_rows(spark, block):
    queries.ship(spark)
    rows = made(120, block)
    assert result(prefix_trie.prefix_trie(frame(spark, rows), block)) == plain(rows)


def test_long_conversation_hot_turns_and_many_ends(spark):
    queries.ship(spark)
    rows = [(40, t, "user", f"turn {t}") for t in range(900)] + [(41, t, "user", f"turn {t}") for t in range(700)]
    rows += [(c, 0, "user", "hello") for c in range(1000, 2500)] + [(c, 1, "user", "same") for c in range(1000, 2500, 3)]
    rows += [(7, 0, "user", "no base, few turns")]
    assert result(prefix_trie.prefix_trie(frame(spark, rows), 300)) == plain(rows)


def test_one_conversation_and_empty_table(spark):
    queries.ship(spark)
    rows = [(5, 0, "user", "x")]
    assert result(prefix_trie.prefix_trie(frame(spark, rows))) == plain(rows)
    assert prefix_trie.prefix_trie(frame(spark, rows).limit(0)).count() == 0


def test_chains_of_a_block():
    rnd = np.random.default_rng(1)
    order = rnd.permutation(50)
    a, b = np.arange(50) * 10, np.arange(50) % 3
    nxt = np.full(50, -1)
    nxt[order[:-1]] = order[1:]
    has = nxt >= 0
    has[order[20]] = False       # two chains: 21 and 29 arcs
    w = rnd.integers(0, 9, (3, 50))
    head, before, tails = prefix_trie.join_chains(a, b, a[np.maximum(nxt, 0)], b[np.maximum(nxt, 0)], has, w)
    assert set(head) == {order[0], order[21]} and set(tails) == {order[20], order[49]}
    assert (before[:, order[20]] == w[:, order[:20]].sum(axis=1)).all() and (before[:, order[49]] == w[:, order[21:49]].sum(axis=1)).all()


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    register_views(con, sf, ["conversations"])
    ok, why = compare(queries.QUERIES["op13_prefix_trie"](spark, sf), con, queries.ORACLE["op13_prefix_trie"])
    assert ok, why
