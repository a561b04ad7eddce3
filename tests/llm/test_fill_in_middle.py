"""Fill-in-middle: boundary set against the pattern, all container kinds, odd rows."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factlake.llm import fill_in_middle as fim
from factlake.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.brute import sha
from tools.oracle_compare import compare, register_views

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    units = TOKEN.findall(text)
    n = len(units)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:one]), "".join(units[one:two]), "".join(units[two:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, sha(text), sha(text)
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 80 else "psm", len(p), len(m), sha(out), sha(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="a \n\t\x1c\x85\xa0é😀b", max_size=60))
def test_boundaries_equal_pattern(text):
    ends = fim.BoundarySet(text)
    at, want = 0, [0]
    for unit in TOKEN.findall(text):
        at += len(unit)
        want.append(at)
    assert [ends.cut(k) for k in range(len(ends) + 1)] == want


@pytest.mark.parametrize("text, kind", [
    ("a " * 40_000, fim.BitmapContainer), ("word " * 400 + "x" * 70_000, fim.ArrayContainer), ("\n" * 70_000, None), ("é b " * 60_000 + "x" * 200_000 + " z ", fim.BitmapContainer)])
def test_long_texts_and_container_kinds(text, kind):
    ends = fim.BoundarySet(text)
    want = np.cumsum([0] + [len(u) for u in TOKEN.findall(text)])
    assert len(ends) == len(want) - 1
    for k in {0, 1, len(ends) // 3, len(ends) // 2, len(ends) - 1, len(ends)}:
        assert ends.cut(k) == want[k]
    if kind:
        assert isinstance(ends.containers[0], kind)


def test_run_container_and_every_select():
    values = np.concatenate([np.arange(100, 5_000), np.arange(9_000, 65_536)])
    run = fim.container(values)
    dense = fim.container(np.arange(0, 65_536, 3))
    assert isinstance(run, fim.RunContainer) and isinstance(dense, fim.BitmapContainer)
    assert [run.select(k) for k in range(len(values))] == values.tolist()
    assert [dense.select(k) for k in range(21_846)] == list(range(0, 65_536, 3))


def test_odd_rows_and_markers(spark):
    queries.ship(spark)
    rows = [(i, t) for i in (None, 1, 2, 3, 5, 8) for t in (None, "", " ", "a", "a b c d e f", "x <P> y", "<S", "é 😀 \x85 <", " a<\n>S> M> <P ", "a b c d e f")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, n int")
    got = sorted(map(repr, fim.digests(docs).collect()))
    cols = fim.digests(docs).columns
    from pyspark.sql import Row
    want = sorted(repr(Row(**dict(zip(cols, (i, *plain(i, t or "")))))) for i, t in rows)
    assert got == want
    assert fim.digests(docs.limit(0)).count() == 0


def test_texts_come_back_and_parameters_apply(spark):
    queries.ship(spark)
    docs = spark.createDataFrame([(i, f"one two three {i} four five") for i in range(200)], "doc_id long, text string")
    forms = {r.form for r in fim.fill_in_middle(docs, fim=100, spm=0).collect()}
    assert forms == {"psm"} and {r.form for r in fim.fill_in_middle(docs, fim=0).collect()} == {"plain"}
    both = fim.fill_in_middle(docs, seed=7).join(docs, "doc_id")
    assert both.filter(fim.restored(both["form"], both["output"]) != both["text"]).count() == 0


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    register_views(con, SF_SMALL, ["documents"])
    ok, note = compare(queries.QUERIES["op11_fill_in_middle"](spark, SF_SMALL), con, queries.ORACLE["op11_fill_in_middle"])
    assert ok, note
