"""Secret scans by assignment-aware lexing.

Three fixed patterns give the base spans: ``assign`` (a sensitive name, a separator and a
value), ``access`` (key ids of one fixed prefix) and ``hex`` (long lower-case hex runs).
On top, lines with ``=`` or ``:`` are lexed into name-literal pairs of source and
configuration syntax (``name = "literal"``, ``"name": "literal"``, ``name: literal``,
``export NAME=literal``, ``name := literal``, ``"name" => literal``, ``name: type = literal``,
``a["name"] = literal``, ``a.b = c = literal``).  The words of a subscript target's whole path count, and
all targets of a chain take the value.  Constants propagate: a name assigned from
another name, from a ``+`` chain of literals and names, or from ``$NAME`` and ``${NAME}`` (bare or in
double quotes) takes the literals those names hold at that point of the text.  A literal is scored by the sensitive words of every name it
reaches and by its own shape; literals at or above ``THRESHOLD`` add ``literal`` spans
(their own place, quotes excluded).

Offsets are code points, end exclusive.  Null and empty texts have no spans.  Each row is
judged by itself, so repeated rows repeat their result; a literal equal in span to a base
span of kind ``assign``'s value is still listed under ``literal``.  Texts of any length are
scanned whole; per-text memory is the text plus its assignments.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns and lower limits of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "literal")

# Possessive runs, each entered only at its start: lexing is linear, whatever the length of a name.
NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
INDEX = r"(?:\[[ \t]*+[0-9]*+[ \t]*+\])*+"
QUOTED = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'"""
SHELL = r"\$\{[A-Za-z_][A-Za-z0-9_]*+\}"
VALUE = (rf"""(?P<value>(?:{QUOTED}|(?:{SHELL}|[A-Za-z0-9_./+=@%$!#~^&*-])+)"""
         rf"""(?:[ \t]*\+[ \t]*(?:{QUOTED}|{SHELL}|{NAME}))*)""")
PAIR = re.compile(
    rf"""(?P<q>["']?)(?<![A-Za-z0-9_.-])[0-9.-]*+(?P<name>{NAME})(?P=q)"""
    rf"""(?:(?P<sub>[ \t]*+\]){INDEX}[ \t]*+(?::=|=>|=(?![=>~]))|{INDEX}[ \t]*+(?P<sep>:=|=>|[:=](?![=>])))[ \t]*+{VALUE}""")
# What may stand between a target and its value, matched where the value seems to start: a further target, or a type.
GENERIC = r"(?:[\[<][A-Za-z0-9_.,|&\[\]<>?* \t]*+)?+"
THEN = rf"""(?:[ \t]++=(?![=>~])[ \t]*+|=(?=["'])){VALUE}"""
CHAIN = re.compile(rf"""(?P<name>\$?{NAME})(?P<path>(?:\[[ \t]*+(?:"[^"\\\n]*+"|'[^'\\\n]*+'|[$A-Za-z0-9_.-]*+)[ \t]*+\])*+){THEN}""")
TYPED_THEN = rf"""(?:(?:[ \t]++|(?<=[ \t]))=(?![=>~])[ \t]*+|=(?=["'])){VALUE}"""  # GENERIC takes the spaces after it
TYPED = re.compile(rf"(?:&(?:'[a-z_]++[ \t]++)?+(?:mut[ \t]++)?+)?+[A-Za-z_][A-Za-z0-9_.]*+{GENERIC}[?!*]*+(?:[ \t]*+\|[ \t]*+[A-Za-z_][A-Za-z0-9_.]*+{GENERIC})*+{TYPED_THEN}")
PATH = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.[]\"'>$-")
SHELL_REF = re.compile(r"\$(?:\{([A-Za-z_][A-Za-z0-9_]*+)\}|([A-Za-z_][A-Za-z0-9_]*+))")
PART = re.compile(r"""(?P<s>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<w>[^\s"']+)""")
IDENT = re.compile(rf"{NAME}\Z")
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# Weights of the words of a target name (fixed values).
SENSITIVE = {"password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3,
             "credentials": 3, "private": 2, "auth": 2, "key": 1, "access": 1, "api": 1, "signing": 1, "encryption": 1, "bearer": 2}
THRESHOLD = 4.0
PLACEHOLDER = re.compile(r"(?i)\A(?:true|false|null|none|yes|no|on|off|changeme|example|placeholder|x+|\*+|\$\{?.*|<.*)\Z")


def name_weight(name: str) -> int:
    return min(4, sum(SENSITIVE.get(p.lower(), 0) for p in NAME_PARTS.findall(name)))


def literal_weight(value: str) -> float:
    """0 for what cannot be a secret, else 1 to 3 by length, mixture of classes and entropy."""
    if len(value) < MIN_VALUE or any(c.isspace() for c in value) or PLACEHOLDER.match(value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = any(c.isdigit() for c in value) + any(c.islower() for c in value) + any(c.isupper() for c in value) + any(not c.isalnum() for c in value)
    return 1.0 + min(1.0, entropy / 4) + (0.5 if classes >= 2 else 0) + (0.5 if n >= 16 else 0)


def _targets(text: str):
    """(names bound, names that weigh, match that has the value) of each assignment."""
    at = 0
    while m := PAIR.search(text, at):
        begin = m.start("name")
        if m["sub"] or text[begin - 1:begin] in (".", ">"):  # the path before it, back to the last assignment
            begin = m.start()
            while begin > at and text[begin - 1] in PATH:
                begin -= 1
        path = text[begin:m.end("name")]
        bound, weighs = [path if m["sub"] else m["name"]], [path]
        typed = TYPED.match(text, m.start("value")) if m["sep"] == ":" else None
        m = typed or m
        while more := CHAIN.match(text, m.start("value")):
            m = more
            bound.append(m["name"].removeprefix("$") + m["path"])
            weighs.append(bound[-1])
        at = m.end()
        yield bound, weighs, m


def lex(text: str):
    """(names bound, names that weigh, parts) of each assignment; a part is ('lit', start, end),
    ('ref', name, start, end) or ('in', name), a reference inside a literal."""
    for bound, weighs, m in _targets(text):
        at, parts = m.start("value"), []
        for p in PART.finditer(m["value"]):
            if p["s"] is not None:
                a, b, inner = at + p.start() + 1, at + p.end() - 1, p["s"][1:-1]
                shell = p["s"][0] == '"' and "$" in inner
            elif p["w"] != "+":
                a, b, inner = at + p.start(), at + p.end(), p["w"]
                shell = "$" in inner
                if IDENT.match(inner):
                    parts.append(("ref", inner, a, b))
                    continue
            else:
                continue
            whole = SHELL_REF.fullmatch(inner) if shell else None
            if whole:
                parts.append(("ref", whole[1] or whole[2], a, b))
            else:
                parts.append(("lit", a, b))
                parts += [("in", r[1] or r[2]) for r in SHELL_REF.finditer(inner)] if shell else []
        yield bound, weighs, parts


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or through constants.

    Every assignment is a node that points to its own literals and to the assignments its names held
    at that point.  Weights flow back from the last assignment to the first, so each literal
    gets the greatest weight it reaches in one pass over the parts."""
    nodes: list[tuple[list[tuple[int, int]], list[int]]] = []
    weight: list[int] = []
    holds: dict[str, int] = {}
    for bound, weighs, parts in lex(text):
        literals, refs = [], []
        for p in parts:
            if p[0] == "lit":
                literals.append((p[1], p[2]))
            elif p[1] in holds:
                refs.append(holds[p[1]])
            elif p[0] == "ref":
                literals.append((p[2], p[3]))  # a bare word that names no constant is a literal itself
        for name in bound:
            holds[name] = len(nodes)
        nodes.append((literals, refs))
        weight.append(max(name_weight(name) for name in weighs))
    out = []
    for k in range(len(nodes) - 1, -1, -1):
        if not weight[k]:
            continue
        for r in nodes[k][1]:
            weight[r] = max(weight[r], weight[k])
        for a, b in nodes[k][0]:
            v = literal_weight(text[a:b])
            if v and weight[k] + v >= THRESHOLD:
                out.append((a, b))
    return sorted(out)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def all_spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, added literal spans)."""
    if not text:
        return [], []
    base = base_spans(text)
    added = [(a, b, "literal") for a, b in literal_spans(text)] if ":" in text or "=" in text else []
    return base, added


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of base spans, all spans listed."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))

    def run(batches):
        for b in batches:
            counts, digests, spans = {k: [] for k in KINDS}, [], []
            for text in b.column(1).to_pylist():
                base, added = all_spans(text)
                n = Counter(k for _, _, k in base)
                for k in KINDS[:3]:
                    counts[k].append(n[k])
                counts["literal"].append(len(added))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(base + added))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS[:3]), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(counts["literal"], pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])
    return narrow.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlaps merged) replaced by ``mask``."""
    at, schema = docs.columns.index("text"), docs.schema

    def one(text):
        base, added = all_spans(text)
        out, end = [], 0
        for a, b, _ in sorted(base + added):
            if a >= end:
                out += [text[end:a], mask]
            end = max(end, b)
        return "".join([*out, text[end:]]) if out else text

    def run(batches):
        for b in batches:
            cols = list(b.columns)
            cols[at] = pa.array([one(t) for t in cols[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
    return docs.mapInArrow(run, schema)
