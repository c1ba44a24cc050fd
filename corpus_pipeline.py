"""Pipeline over ``documents``: language ID, toxicity, near-dedup, best-fit packing.

Each stage works on all that its predecessor kept. The filtering stages return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnow.llm import crf, dart, langid, packing
from winnow.llm.queries import learn_toxicity, tokenizer_file
from winnow.llm.shared import kept, ready, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; narrow margins and texts without letters go."""
    ready(spark)
    return langid.with_language(docs, langid.learn_dictionaries(docs))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the field learns from their labelled ones."""
    return crf.without_toxic(docs, learn_toxicity(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each near-duplicate group, null ones last."""
    return dart.first_of_groups(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    ready(spark)
    pieces = packing.pieces_of(docs, tokenizer_file("word_bpe_49k.json"))
    return packing.pack(kept(pieces, "pieces"))


STAGES = [
    ("language ID", identify_language),
    ("toxicity", remove_toxic),
    ("MinHash near-dedup", remove_near_duplicates),
    ("best-fit packing", pack),
]

# Compressors, fitted models and bin packing are beyond SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
