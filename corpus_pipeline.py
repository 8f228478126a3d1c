"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, tokenisation.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run``
writes each stage's rows to the shared folder as Parquet and reads them back as the next one's
``docs``. All stages but the last return the columns of ``documents``. An empty table passes all
stages; null texts and repeated rows are treated as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.llm import bpe, mixing, pii, rules, simhash
from opsmart.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules reject go."""
    return rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one of smallest id."""
    return simhash.one_of_each(docs, simhash.RADIUS, simhash.SHINGLE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def mixing_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix; none is dropped.

    Files do not keep an order of rows; ``tokens`` gives every row its place again.
    """
    return mixing.ordered(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of what they decode to, with its
    ``source`` and its place in the mix (``position``, ``in_ratio``).

    The place is a function of the rows, whatever their order; it also tells rows without ``doc_id``
    apart, so it is the key by which the digests come back.
    """
    named = docs.select("doc_id", "source", F.struct("text").alias("own"))
    placed = stored(mixing.mixed(named, content=F.xxhash64("own.text")), "pipeline-places")
    digests = bpe.digests(placed.select(F.col("position").alias("doc_id"), "own.text"))
    return (
        digests.withColumnRenamed("doc_id", "position")
        .join(placed.select("position", "doc_id", "source", "in_ratio"), "position")
        .select("doc_id", *[c for c in digests.columns if c != "doc_id"], "source", "position", "in_ratio")
    )


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing_order),
    ("tokens", tokens),
]

#: SQL can express neither the learned rules nor the fingerprints and the tokeniser.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
