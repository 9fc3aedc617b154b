"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata.session import materialise, shared_folder  # noqa: F401

#: The white space that separates words and is stripped from line keys.
SPACES = " \t\n\x0b\x0c\r"


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text; null has none."""
    return text.split() if text else []


def lower_ascii(col):
    """A-Z to a-z, every other character unchanged."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*columns) if columns else df
