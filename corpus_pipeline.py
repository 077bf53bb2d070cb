"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All
but the last return the columns of documents, and further columns, whatever their names, as
they were.  One rule holds in all of them: a row is told by its id and its text.  Rows without
an id, and rows of one id with different texts, are judged each by its own text; rows equal in
id and text stay or go together; null, empty and blank texts are clean and stay.  No rows give
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerweave.llm.common import load
from offerweave.llm.decontam import decontaminate
from offerweave.llm.linededup import without_repeated_lines
from offerweave.llm.neardup import one_of_each
from offerweave.llm.packing import pack
from offerweave.llm.toxicity import without_toxic
from offerweave.plans.scratch import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the factorization machine rejects go; ids and sources are no inputs."""
    return without_toxic(docs, load(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by many sites go, however short, but for their first occurrence.

    A null source is the empty source; null ids come last among occurrences.  Rows of which
    nothing is left go.
    """
    return without_repeated_lines(docs, min_words=None)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Rows without an id go if their group has a row with one.
    """
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark item go; null and blank items are held by none."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences with the place of every piece; null texts are a closing id alone, and every row is packed."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The classifier, MinHash and the tokenizer are outside SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written before the next stage reads it."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
