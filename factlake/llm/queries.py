"""Registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import factlake
from factlake.llm import (bpe_codec, chat_format, decontaminate, fill_in_middle, jaccard_forest, language_id, line_templates,
                          piece_codec, prefix_trie, quality_lines, secret_scan, suffix_dedup, token_counts)
from factlake.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(factlake.__file__).parent
    fd, path = tempfile.mkstemp(prefix="factlake-", suffix=".zip")
    with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_language_id")
def op1(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@register("op2_suffix_dedup")
def op2(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@register("op3_word_bpe")
def op3(spark, sf_dir):
    import public_tokenizers

    ranks = bpe_codec.load_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    return bpe_codec.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@register("op4_line_frequency", quality_lines.ORACLE)
def op4(spark, sf_dir):
    return quality_lines.quality(table(spark, sf_dir, "documents"))


@register("op5_line_templates", line_templates.ORACLE)
def op5(spark, sf_dir):
    return line_templates.line_dedup(table(spark, sf_dir, "documents"))


@register("op6_chat_format", chat_format.ORACLE)
def op6(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.format_conversations(conversations.unionByName(chat_format.conflict_case(spark)))


@register("op7_decontamination", decontaminate.ORACLE)
def op7(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_secret_scan")
def op8(spark, sf_dir):
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


@register("op9_jaccard_forest", jaccard_forest.ORACLE)
def op9(spark, sf_dir):
    return jaccard_forest.links(table(spark, sf_dir, "documents"))


@register("op10_token_counts")
def op10(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@register("op11_fill_in_middle", fill_in_middle.ORACLE)
def op11(spark, sf_dir):
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


@register("op12_piece_codec")
def op12(spark, sf_dir):
    return piece_codec.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@register("op13_prefix_trie", prefix_trie.ORACLE)
def op13(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
