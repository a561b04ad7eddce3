"""Fill-in-middle transformation over a Roaring-style set of token boundaries.

A text is cut into tokens (a run of non-space characters with the ASCII white space before it, or
trailing white space).  The places of the tokens' last characters form a compressed set of
containers, one for every 65,536 code points: sorted arrays for sparse containers, bitmaps with a rank
directory for dense ones, runs where those are smaller.  Cumulative cardinalities lead to the
container of the k-th boundary, a local select to its place, so both cut offsets come from
two selects.  A container is built from its own stretch of the text, so working memory does not
grow with the text beyond two bytes a boundary.

Cuts and form follow from the first four 8-digit groups of the sha-256 of ``seed:doc_id``:
whole-document decisions that do not depend on order, partitioning or retries.

Defined results: null text is empty; empty texts and texts that contain a marker stay plain
(prefix_chars and middle_chars null).  A null doc_id has the empty string as its decimal form.
Repeated rows repeat their result; extra columns are not read.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factlake.llm.common import let

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
SPAN = 1 << 16       # code points of one container
ARRAY_LIMIT = 4_096  # boundaries up to which a container is an array
ROWS = 256           # rows of one output batch


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """65,536 bits with the number of set bits before each 64-bit word."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(SPAN, dtype=np.uint8)
        bits[values] = 1
        self.bytes = np.packbits(bits, bitorder="little")
        per_word = bits.reshape(-1, 64).sum(axis=1)
        self.before = np.concatenate(([0], np.cumsum(per_word)[:-1]))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.bytes[8 * word:8 * word + 8], bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])


class RunContainer:
    """Starts of runs of consecutive values with the number of values before each."""

    def __init__(self, starts: np.ndarray, before: np.ndarray):
        self.starts, self.before = starts, before

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(values: np.ndarray):
    """The smallest container for sorted values below 65,536."""
    first = np.flatnonzero(np.diff(values, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(values), SPAN // 8):
        return RunContainer(values[first].astype(np.uint16), first.astype(np.uint32))
    return ArrayContainer(values.astype(np.uint16)) if len(values) <= ARRAY_LIMIT else BitmapContainer(values)


class BoundarySet:
    """Places of the last characters of a text's tokens."""

    def __init__(self, text: str):
        sizes, self.containers = [], []
        for at in range(0, len(text), SPAN):
            values = token_ends(text[at:at + SPAN], text[at + SPAN:at + SPAN + 1])
            self.containers.append(container(values) if len(values) else None)
            sizes.append(len(values))
        self.before = list(accumulate(sizes, initial=0))

    def __len__(self) -> int:
        return self.before[-1]

    def cut(self, k: int) -> int:
        """Code points in the first ``k`` tokens."""
        if k == 0:
            return 0
        at = bisect_right(self.before, k - 1) - 1
        return at * SPAN + self.containers[at].select(k - 1 - self.before[at]) + 1


def token_ends(piece: str, following: str) -> np.ndarray:
    """Places in ``piece`` where a token ends; ``following`` is the next character or empty."""
    codes = np.frombuffer((piece + following).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (codes == 32) | (codes - np.uint32(9) <= 4)
    n = len(piece)
    after = space[1:] if following else np.append(space[1:], True)
    ends = ~space[:n] & after
    if not following:
        ends[n - 1] = True
    return np.flatnonzero(ends)


def groups(doc_id: int | None, seed: int = SEED) -> list[int]:
    """The first four 8-digit groups of the digest of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def transform_text(doc_id: int | None, text: str, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = BoundarySet(text)
    n = len(ends)
    h1, h2, h3, h4 = groups(doc_id, seed)
    if not text or h3 % 100 >= fim or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends.cut(first), ends.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT) -> DataFrame:
    """Per document: doc_id, n (tokens), form, prefix_chars, middle_chars and the transformed text ``output``."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                ids = part.column(0).to_pylist()
                made = [transform_text(i, t or "", seed, fim, spm) for i, t in zip(ids, part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([ids, *zip(*made)], kinds)], names=names)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The source text, from the output and its form alone (each marker occurs once)."""
    def after(c: Column, head: Column) -> Column:
        return F.substr(c, F.length(head) + len(MIDDLE) + 1)

    def split_at(c: Column, marker: str, build) -> Column:
        return let(F.substring_index(c, marker, 1), lambda head: build(head, after(c, head)))
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    psm = split_at(body, SUFFIX, lambda prefix, rest: split_at(rest, MIDDLE, lambda suffix, middle: F.concat(prefix, middle, suffix)))
    spm = split_at(body, PREFIX, lambda suffix, rest: split_at(rest, MIDDLE, lambda prefix, middle: F.concat(prefix, middle, suffix)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the cuts and the digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS s,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents
), h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT *, length(array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '')) AS a, length(array_to_string(u[1:greatest(h1 % (n + 1), h2 % (n + 1))], '')) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT doc_id, n, form, t, coalesce(a, 0) AS a, coalesce(b, 0) - coalesce(a, 0) AS m FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN m END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, a + m + 1) || '<M>' || substr(t, a + 1, m)
    ELSE '<S>' || substr(t, a + m + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, m) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
