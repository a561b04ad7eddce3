"""Operators on single texts against plain versions, with nulls, empty tables, repeated rows and odd columns."""

import random
import re
import time

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factlake.llm import bpe_codec, chat_format, decontaminate, language_id, queries, secret_scan, token_counts
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.brute import contamination, sha, words
from tools.oracle_compare import compare, register_views

ODD = [None, "", " ", "\n\n", "é", "x" * 3000, "a b c", "a b c", "日本語 テキスト", "it's I'll  \n x\x85\xa0½² \x1c <|endoftext|>y"]


@pytest.fixture(scope="module")
def llm(spark):
    queries.ship(spark)
    return spark


def frame(spark, rows, extra="label string, n_words int"):
    """doc_id, text and columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "x", None) for i, t in rows], f"doc_id long, text string, {extra}")


def test_language_id(llm):
    docs = llm.read.parquet(f"{SF_MID}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    odd = frame(llm, [(None, t) for t in ODD] + [(1, "12 34!")])
    langs, profiles = language_id.learn(docs)
    rows = language_id.predict(odd.withColumn("lang", F.lit("fr")), langs, profiles).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == "und" for r in rows) == 5
    assert {r.lang_pred for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def test_language_profile_order():
    import numpy as np

    codes = language_id.ngrams("ab ab Ab")
    top = language_id.ranked(codes, 3).tolist()
    uniq, n = np.unique(codes, return_counts=True)
    want = sorted(zip(uniq.tolist(), n.tolist()), key=lambda x: (-x[1], x[0]))[:3]
    assert top == [c for c, _ in want]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_split_equals_pattern(text):
    import regex

    assert bpe_codec.splitter(bpe_codec.BYTE_PATTERN)(text) == regex.findall(public_tokenizers.PATTERN, text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" aB1'st½²\n\t\x85\xa0\x1cé!?", max_size=60))
def test_latin_split_equals_pattern(text):
    import regex

    assert bpe_codec.BYTE_PATTERN == public_tokenizers.PATTERN
    assert bpe_codec.splitter(bpe_codec.BYTE_PATTERN)(text) == regex.findall(public_tokenizers.PATTERN, text)


@pytest.mark.parametrize("block", [200, 1 << 25])
def test_bpe_round_trip(llm, block):
    ranks = bpe_codec.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = bpe_codec.encoder(ranks, public_tokenizers.PATTERN)
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(40).collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(100_000 + i, t) for i, t in enumerate(ODD)]
    df = frame(llm, rows + [(None, "null id"), rows[0]])
    got = bpe_codec.digests(df, ranks, public_tokenizers.PATTERN, block).collect()
    assert len(got) == len(rows) + 2
    want = {i: library.encode_ordinary(t or "") for i, t in [*rows, (None, "null id")]}
    texts = dict(rows) | {None: "null id"}
    for r in got:
        ids = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(texts[r.doc_id] or ""))
    whole = bpe_codec.encode_decode(df, ranks, public_tokenizers.PATTERN, block).collect()
    assert all(list(r.ids) == want[r.doc_id] and bytes(r.decoded) == (texts[r.doc_id] or "").encode() for r in whole)
    assert bpe_codec.digests(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="a\\\n<|>imstarend_", max_size=30), st.lists(st.sampled_from(["<|im_end|>", "<|im_start|>", "<\\|im_end|>", "\\", "\n", "x"]), max_size=6))
def test_every_turn_comes_back(role, parts):
    text = "".join(parts)
    segment, _ = chat_format.render(role, text)
    assert chat_format.reparsed(segment) == [(role, text)]
    body = segment[len(chat_format.START):-len(chat_format.END) - 1]
    assert chat_format.START not in body and chat_format.END not in body


def test_chat_queries(llm):
    con = duckdb.connect()
    register_views(con, SF_SMALL, ["conversations"])
    ok, why = compare(queries.QUERIES["op6_chat_format"](llm, SF_SMALL), con, chat_format.ORACLE)
    assert ok, why


def test_chat_odd_rows(llm):
    rows = [(1, 1, "user", "b", 0), (1, 0, None, None, 0), (1, 1, "assistant", "a", 0), (1, None, "user", "first", 0),
            (1, 1, "user", "b", 0), (None, 0, "assistant", "<|im_end|>", 0)]
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    order = [("user", "first"), ("", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert got[1].n_turns == 5 and got[1].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in order))
    assert (got[1].loss_chars, got[None].loss_chars, got[None].loss_sha256) == (1, 10, sha("<|im_end|>"))
    assert got[None].formatted_chars == 12 + 9 + 1 + 11 + 10 + 1
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_decontamination(llm):
    random.seed(3)
    vocab = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    items = [(str(i), text(random.choice([1, 3, 9, 10, 11, 30]))) for i in range(12)] + [("0", text(12)), ("null", text(15)), ("7", None), ("8", "...")]
    docs = [(i, text(60)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(ODD)] + [(200, "Pre, " + items[-3][1].upper() + " post")]
    docs.append(docs[3])
    bench = llm.createDataFrame([(None if k == "null" else k, b, 1) for k, b in items], "item_id string, text string, n_words int")
    df = frame(llm, docs)
    for block_bytes in (1 << 22, 40):
        got = decontaminate.contamination(df, bench, block_bytes=block_bytes).collect()
        assert len(got) == len(docs)
        for r in got:
            hit, found = contamination(dict(docs)[r.doc_id], items)
            assert (r.n_words, r.n_hit, r.n_items) == (len(words(dict(docs)[r.doc_id])), len(hit), len(found)), r
            assert r.items_sha256 == sha(",".join(sorted(found))) and r.contaminated == bool(hit)
    empty = decontaminate.contamination(df, bench.limit(0)).collect()
    assert len(empty) == len(docs) and not any(r.contaminated for r in empty)
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def test_decontaminated_text(llm):
    item = " ".join(f"word{i}" for i in range(12))
    docs = frame(llm, [(1, f"Keep this, {item.upper()}! And that."), (2, "clean é"), (3, None)])
    bench = llm.createDataFrame([(5, item)], "item_id long, text string")
    out = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench).collect()}
    assert out == {1: "Keep this, ! And that.", 2: "clean é", 3: None}


@pytest.mark.parametrize("text", [
    'password: str = "S3cr3tValue99"', 'password: Optional[str] = "S3cr3tValue99"', 'password: str | None = "S3cr3tValue99"',
    'const TOKEN: &\'static str = "S3cr3tValue99"', 'let token:string="S3cr3tValue99"',
    'config["db_password"] = "S3cr3tValue99"', "config['secret']['value'] = 'S3cr3tValue99'", 'a["secret"][0] = "S3cr3tValue99"',
    'cfg["secret"].value = "S3cr3tValue99"', '["password"] = "S3cr3tValue99"', '"password" => "S3cr3tValue99"', ":token=>'S3cr3tValue99'",
    'token = x = "S3cr3tValue99"', 'x = token = "S3cr3tValue99"', 'a = b = "S3cr3tValue99"\nsecret = a', 'x = cfg["token"] = "S3cr3tValue99"',
    "A=S3cr3tValue99; export TOKEN=$A", "A=S3cr3tValue99; export TOKEN=${A}", 'A=S3cr3tValue99\nTOKEN="$A"', 'A=S3cr3tValue99\nTOKEN="${A}"',
    "$a = 'S3cr3tValue99';\n$token = $a;"])
def test_secret_targets(text):
    assert [text[a:b] for a, b in secret_scan.literal_spans(text)] == ["S3cr3tValue99"]


def plain_covered(text, item):
    """Word positions of the stretches that hold 4/5 of the item in runs of four or more words."""
    w, b, out = words(text), words(item), set()
    size = len(b) * 5 // 4
    for z in range(4, len(w) + 1):
        a = max(0, z - size)
        hits = [(p, k) for p in range(a, z - 3) for k in range(len(b) - 3) if w[p:p + 4] == b[k:k + 4]]
        of_doc, of_item = ({h[i] + j for h in hits for j in range(4)} for i in (0, 1))
        if min(len(of_doc), len(of_item)) * 5 >= len(b) * 4:
            out |= set(range(min(of_doc), max(of_doc) + 1))
    return out


def test_decontamination_by_coverage(llm):
    random.seed(12)
    word = lambda n=5: "".join(random.choice("abcdefghij") for _ in range(n))
    item = [word() for _ in range(40)] + ["again"] * 6
    docs = [" ".join(word() for _ in range(20)) for _ in range(3)]
    for step in (4, 5, 6, 9, 10):
        for change in ([word(7)], [], None):
            body = [x for k, v in enumerate(item) for x in ((change if change is not None else [v, word(7)]) if k % step == step - 1 else [v])]
            docs.append(" ".join([word(), *item[:5], word(), word(), *body, word(), *item[3:8], word()]))
    docs += ["again " * 9, " ".join(item[:20]), " ".join(item[:8] * 6), " ".join((item[:9] + [word()] + item[10:]) * 2)]
    bench = llm.createDataFrame([("i", " ".join(item)), ("i", "short one"), (None, None)], "item_id string, text string")
    df = llm.createDataFrame([(k, t) for k, t in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: words(r.text) for r in decontaminate.decontaminate(df, bench).collect()}
    by_cover = 0
    for k, t in enumerate(docs):
        hit = contamination(t, [("i", " ".join(item))])[0]
        covered = plain_covered(t, " ".join(item))
        by_cover += bool(covered - hit)
        assert got[k] == [v for j, v in enumerate(words(t)) if j not in hit | covered], k
    assert by_cover >= 8 and got[0] == words(docs[0])


def test_secret_targets_are_linear_and_bound():
    found = lambda t: [t[a:b] for a, b in secret_scan.literal_spans(t)]
    assert found('name: str = "abcdefgh12"\ntoken: str') == [] and found('config["a"] = "abcdefgh12"\ntoken = a') == []
    assert found("A=abcdefgh12\nTOKEN='$A'") == [] and found("token = YWJjZGVmZw== other") == ["YWJjZGVmZw=="]
    for part in ("a = ", "a=", 'a["b"]', "a[b]", "a->", "a[0].", "a: b", "a: b<", "$a", "${a}", "a: b | ", "x.a[1]"):
        start = time.perf_counter()
        secret_scan.literal_spans(part * 40_000 + "(")
        assert time.perf_counter() - start < 5, part


def plain_secrets(text):
    t = text or ""
    out = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return out + [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]


def test_secret_spans(llm):
    random.seed(5)
    bits = ["token", "=", ":", " ", '"', "'", "Api_Key", "apikey", "AKIA", "ABCDEFGH12345678", "deadbeef0123456789abcdef", "abc", "passwd", "é", "\n", "secret"]
    rows = [(i, "".join(random.choice(bits) for _ in range(25))) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    got = {r.doc_id: r for r in secret_scan.scan_secrets(frame(llm, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        base = plain_secrets(t)
        assert got[i].base_sha256 == sha(secret_scan.listed(base))
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for *_, k in base) for x in ("assign", "access", "hex")]
        assert {secret_scan.listed([s]) for s in base} <= set(got[i].spans.split(","))
    assert secret_scan.scan_secrets(frame(llm, []).limit(0)).count() == 0


def test_constants_propagate():
    found = lambda t: [t[a:b] for a, b in secret_scan.literal_spans(t)]
    assert found('k = "Zx9$kq02Lm4v"\nx = 1\nDB_PASSWORD = k\n') == ["Zx9$kq02Lm4v"]
    assert found('a = "Zx9kq02L"\nb = a + "mN47pq1Q"\nauth_token: b') == ["Zx9kq02L", "mN47pq1Q"]
    assert found('{"clientSecret": "q8Zt!77xYp0a"}') == ["q8Zt!77xYp0a"]
    assert found("export API_KEY=f0o8ar77Qz") == ["f0o8ar77Qz"]
    assert found('colour = "Zx9$kq02Lm4v"\npassword = "changeme"\nname: value') == []
    assert secret_scan.literal_spans("") == []
    many = [f"Zx9kq{i:03d}Lm" for i in range(200)]  # a long chain of constants loses none of its literals
    assert found("v = " + " + ".join(f'"{m}"' for m in many) + "\nw = v\nsecret_token = w\n") == many
    assert found("n" * 300 + '_password = "Zx9$kq02Lm4v"') == ["Zx9$kq02Lm4v"]


def test_redact(llm):
    out = {r.doc_id: r.text for r in secret_scan.redact(frame(llm, [(1, 'x token = "abcdef99" y'), (2, None), (3, "plain")])).collect()}
    assert out == {1: 'x [SECRET]" y', 2: None, 3: "plain"}


def test_token_counts(llm):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    docs += [(10_000 + i, t) for i, t in enumerate([*ODD, "no-space-" * 300, "a" * 500 + " b" * 400, "é<|endoftext|> ΑΣ " * 90])]
    docs.append(docs[0])
    df = frame(llm, docs)
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in docs}
    for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (300, 24)):
        got = token_counts.token_counts(df, path, chunk, overlap, limit=50).collect()
        assert len(got) == len(docs)
        assert [(r.doc_id, r.n_tokens) for r in got if r.n_tokens != want[r.doc_id]] == []
        assert all(r.n_bytes == len((dict(docs)[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 50) for r in got)
    assert token_counts.token_counts(df.limit(0), path).count() == 0


def plain_ranks(text):
    """n-grams of a text, most frequent first, counted character by character."""
    low = text.lower()
    line = "".join(c if c.isalpha() else " " for c in low)
    count = {}
    for w in line.split():
        padded = " " + w + " "
        grams = list(w) + [padded[i:i + 2] for i in range(len(padded) - 1)] + [padded[i:i + 3] for i in range(len(w))]
        for g in grams:
            code = 0
            for c in g:
                code = code << 21 | ord(c)
            count[code] = count.get(code, 0) + 1
    return sorted(count, key=lambda c: (-count[c], c))


def plain_language(text, langs, profiles):
    doc = plain_ranks(text or "")[:language_id.DOC_TOP]
    if not doc:
        return "und", 0.0
    places = {lang: {c: k for k, c in enumerate(p)} for lang, p in zip(langs, profiles)}
    far = {lang: sum(abs(at[c] - k) if c in at else language_id.PROFILE for k, c in enumerate(doc)) for lang, at in places.items()}
    best = min(langs, key=lambda lang: (far[lang], lang))
    return best, max(0.0, 1.0 - far[best] / (language_id.PROFILE * len(doc)))


def test_language_prediction_against_brute_force(llm):
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet")
    langs, profiles = language_id.learn(docs)
    for lang, p in zip(langs, profiles):  # all labelled rows are in the sample at this size
        texts = [r.text for r in docs.filter((F.col("lang") == lang) & F.col("text").isNotNull() & ~language_id.held_out(F.col("doc_id"))).collect()]
        assert p == plain_ranks("\n".join(texts))[:language_id.PROFILE]
    got = language_id.predict(docs, langs, profiles).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in got:
        want = plain_language(r.text, langs, profiles)
        assert r.lang_pred == want[0] and abs(r.score - want[1]) < 1e-12


def test_language_labels_have_no_cap(llm):
    """700 labels, each learned, in three blocks; ties go to the smaller name, also across blocks."""
    random.seed(31)
    abc = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:03d}": " ".join("".join(random.choices(abc, k=6)) for _ in range(12)) for k in range(700)}
    own["l699"] = own["l001"]
    df = llm.createDataFrame([(None, t, lang) for lang, t in own.items()], "doc_id long, text string, lang string")
    langs, profiles = language_id.learn(df)
    assert langs == sorted(own) and len(language_id.Model(langs, profiles).blocks) == 3
    assert language_id.predict(df, langs, profiles).select("lang_pred").distinct().count() == 699
    model = language_id.Model(langs, [np.array(p) for p in profiles])
    for lang, text in own.items():
        assert model.predict(text)[0] == ("l001" if lang == "l699" else lang)


def test_sample_draws_rows_of_one_repeated_id(llm):
    """Rows that share a doc_id are drawn one by one, so the sample is bounded there too."""
    rows = [(None, f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} {'uvwxyz'[i % 6] * (1 + i // 100)}", "aa") for i in range(2000)]
    langs, profiles = language_id.learn(llm.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=100)
    assert langs == ["aa"] and 0 < len(profiles[0]) <= language_id.PROFILE


def test_huge_text_is_cut_in_one_pass():
    from factlake.llm.token_counts import _cut
    body = "".join(chr(0x61 + i % 26) if i % 7 else "é" for i in range(10_007))
    batch = pa.RecordBatch.from_pydict({"key": ["k", "s"], "body": [body, "short"]})
    rows = [r for out in _cut(100, 8, rows=16)(iter([batch])) for r in out.to_pylist()]
    mine = [r for r in rows if r["key"] == "k"]
    assert [r["no"] for r in mine] == list(range(100)) and {r["n"] for r in mine} == {100}
    assert "".join(r["piece"][:100] for r in mine[:-1]) + mine[-1]["piece"] == body
    assert all(a["piece"][100:] == b["piece"][:8] for a, b in zip(mine, mine[1:]))
    assert [r["piece"] for r in rows if r["key"] == "s"] == ["short"]
