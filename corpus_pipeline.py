"""Corpus pipeline: language identification, line deduplication, near
duplicates, decontamination, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; it is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, langid, linededup, packing, simhash
from quarry.llm.common import staged, table, unused

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter, or unlike every learned one) go."""
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines with a letter or a digit go, however short, and near ones
    from ``linededup.MIN_CHARS`` on; the earliest stays; a document of which no word is
    left goes with them.  ``n_chars`` follows the text."""
    counts = tuple(unused(docs, c) for c in linededup.COUNTS)
    kept = linededup.dedup_lines(docs, counts, every_line=True)
    changed = F.col(counts[0]) + F.col(counts[1]) > 0
    left = kept.where(~changed | F.regexp_like("text", F.lit("[^\\x20\\x09-\\x0D]")))
    return left.select(*[F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(left[c]).alias(c)
                         if c == "n_chars" else left[c] for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece, with its ids."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("packing", pack),
]

#: Classifiers, connected components and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
