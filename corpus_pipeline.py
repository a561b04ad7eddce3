"""The corpus pipeline: documents that pass quality rules, without recurring lines, copies and
benchmark passages, as tokens.

Each stage works on all its predecessor kept, is written as Parquet and read again.  All
stages but the last return the columns of ``documents`` (n_chars follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.llm import bpe_codec, decontaminate, jaccard_forest, line_templates, quality_lines
from factlake.llm.common import table, written
from factlake.llm.queries import register, ship, tokenizer_file


#: Characters numbered together in the last stage: what one task holds beside its words.
BLOCK_CHARS = 16 << 20


def _sized(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in df.columns else df


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines too frequent on their host are cut."""
    return _sized(quality_lines.filtered(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go, all but the first."""
    return _sized(line_templates.deduplicated(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    ship(spark)
    return jaccard_forest.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out."""
    ship(spark)
    return _sized(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded bytes."""
    import public_tokenizers

    ship(spark)
    ranks = bpe_codec.load_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    out = bpe_codec.encode_decode(docs, ranks, public_tokenizers.PATTERN, block_chars=BLOCK_CHARS)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]

#: SQL has no byte-pair merges: tests hold the rows against a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


register("pipeline", ORACLE_SQL)(run)
