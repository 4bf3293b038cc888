"""A corpus from raw documents to token ids: five stages, each on all that the one before kept.

Null and empty texts end at the first stage; repeated rows are copies, of which
the second keeps one; an empty table gives no rows; null ids are kept; other
columns travel along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm.common import documents
from skyloom.llm.exact_dedup import drop_copies
from skyloom.llm.language_id import label_languages
from skyloom.llm.mixing import take_mix
from skyloom.llm.ngram_join import keep_one
from skyloom.llm.piece_bpe import encode_documents
from skyloom.session import scratch_path
from skyloom.sources.lake import remove_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go; the others carry the predicted one."""
    return label_languages(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every taken document, as digests."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixture", mixture), ("encode", encode)]

#: The near-duplicate and mixing stages are iterative; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the table of a stage is removed once that of the next is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
