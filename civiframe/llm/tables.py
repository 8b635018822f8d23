"""Reading the provided tables and naming columns without clashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(stem: str) -> str:
    """A column name that no table has."""
    return f"_{stem}_{uuid.uuid4().hex[:8]}"


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
