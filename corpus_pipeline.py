"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from specimen.llm import langid, line_dedup, minhash_dedup, mixing, packing
from specimen.llm.common import documents, prepare, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    prepare(spark)
    return langid.keep_identified(docs, langid.fit(langid.training_rows(docs)))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay in one; ``text`` and ``n_chars`` are renewed."""
    prepare(spark)
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    prepare(spark)
    return minhash_dedup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their mixing weights: every document at least once, documents
    of small sources repeated."""
    prepare(spark)
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    prepare(spark)
    return packing.digest(packing.pack(docs))


STAGES = [("language_id", language_id), ("line_dedup", drop_lines), ("near_dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: None: hashes, darts and tokenizers are not in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
