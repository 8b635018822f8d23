"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civiframe.llm.op01_language_id import keep_identified
from civiframe.llm.op04_simhash import keep_one_of_group
from civiframe.llm.op05_mixing import mixed_documents
from civiframe.llm.op06_lines import dedup_lines
from civiframe.llm.op09_packing import packing
from civiframe.llm.tables import read
from civiframe.session import Staged


#: Documents handed to a Python worker at once, so that workers stay small beside the executor's heap.
BATCH_ROWS = 1000


def bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters go."""
    bounded(spark)
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one, exactly or nearly."""
    return dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    bounded(spark)
    return keep_one_of_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as the mixture takes them: parts, whole, or repeated."""
    bounded(spark)
    return mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in sequences of at most 2048 tokens."""
    bounded(spark)
    return packing(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("packing", sequence_packing),
]

#: SimHash, seeded blocks and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    work = Staged(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        after = work.put(stage(spark, docs, sf_dir), name)
        work.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
