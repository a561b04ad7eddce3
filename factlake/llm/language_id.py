"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent letter n-grams (1 to ``N_MAX``, words padded by a space, lower
case) in order of falling count, ties by code point.  Each language has a profile of its
``PROFILE`` most frequent n-grams; a document is compared by the out-of-place distance: for each of
its ``DOC_TOP`` most frequent n-grams the difference of ranks, or ``PROFILE`` if the language's
profile lacks it.  The smallest distance wins, ties go to the smaller name.

Profiles are learned on a bounded sample: per language about ``TRAIN_PER_LANG`` labelled rows,
taken by a hash of doc_id and text, in one pass with pre-aggregated counts.  Texts are used whole.
Every label found is learned; the driver and the broadcast model hold ``PROFILE`` n-grams a label.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is
everything when no labelled row exists.  Each row is predicted from its text alone, so
repeated rows agree.  A null doc_id counts as the text '' for the fold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

N_MAX = 3
PROFILE = 400
DOC_TOP = 300
TRAIN_PER_LANG = 3_000
LANG_BLOCK = 256  # languages compared at once: bounds the rank matrix, however many labels there are
SPACE = 32

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of the words of a text (21 bits a character)."""
    if not text:
        return np.zeros(0, np.int64)
    cp = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return np.zeros(0, np.int64)
    c = np.full(len(cp) + 2, SPACE, dtype=np.int64)
    c[1:-1] = np.where(letter, cp, SPACE)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE)
    c = c[keep]
    word = c != SPACE
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    return np.concatenate((c[word], two, three[word[1:-1]]))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent codes, most frequent first, ties by code."""
    uniq, n = counted(codes)
    return uniq[np.argsort(-n, kind="stable")[:top]]


class Profiles:
    def __init__(self, langs: list[str], profiles: list[np.ndarray]):
        self.langs = langs
        self.codes = np.unique(np.concatenate(profiles)) if profiles else np.zeros(0, np.int64)
        self.ranks = np.full((len(langs), len(self.codes)), -1, dtype=np.int64)
        for k, p in enumerate(profiles):
            self.ranks[k, np.searchsorted(self.codes, p)] = np.arange(len(p))

    def closest(self, doc: np.ndarray) -> tuple[int, str]:
        """The smallest out-of-place distance of ranked codes, and its language (ties: the first)."""
        at = np.minimum(np.searchsorted(self.codes, doc), len(self.codes) - 1)
        ranks = np.where(self.codes[at] == doc, self.ranks[:, at], -1)
        distance = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(doc)))).sum(axis=1)
        best = int(np.argmin(distance))
        return int(distance[best]), self.langs[best]


class Model:
    """Profiles of all languages, in blocks of ``LANG_BLOCK`` in order of their names."""

    def __init__(self, langs: list[str], profiles: list[np.ndarray]):
        order = sorted(range(len(langs)), key=langs.__getitem__)
        cuts = [order[k:k + LANG_BLOCK] for k in range(0, len(order), LANG_BLOCK)]
        self.blocks = [Profiles([langs[i] for i in cut], [profiles[i] for i in cut]) for cut in cuts]

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ngrams(text)
        if len(codes) == 0 or not self.blocks:
            return "und", 0.0
        doc = ranked(codes, DOC_TOP)
        distance, lang = min(block.closest(doc) for block in self.blocks)
        return lang, float(max(0.0, 1.0 - distance / (PROFILE * len(doc))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> tuple[list[str], list[list[int]]]:
    """Language names and profiles, from rows (doc_id, text, lang) outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [], []
    share = F.create_map([F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_lang / n))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(draw < share[F.col("lang")]).select("lang", "text")

    def run(batches):
        for b in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, []).append(ngrams(text))
            for lang, parts in by.items():
                codes, n = counted(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["lang", "code", "n"])
    counts = sample.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= PROFILE).select("lang", "code", "rank").collect()
    langs = sorted({r.lang for r in top})
    return langs, [[r.code for r in sorted((r for r in top if r.lang == lang), key=lambda r: r.rank)] for lang in langs]


def predict(docs: DataFrame, langs: list[str], profiles: list[list[int]]) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.  Only the text decides."""
    model = docs.sparkSession.sparkContext.broadcast((langs, profiles))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text"))

    def run(batches):
        names, lists = model.value
        fitted = Model(names, [np.array(p, dtype=np.int64) for p in lists])
        for b in batches:
            got = [fitted.predict(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, per_lang: int = TRAIN_PER_LANG) -> DataFrame:
    return predict(docs, *learn(docs, per_lang))
