"""JSON documents (SRC-4) and Parquet unions with drifting schemas (SRC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_docs(spark: SparkSession, paths, schema=None) -> DataFrame:
    """JSON files holding either an array of objects or one object; nested
    arrays (e.g. assignment histories) arrive as array<struct>."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths)


def read_parquet_merged(spark: SparkSession, paths, unify: dict[str, list[str]] | None = None,
                        cast: dict[str, str] | None = None) -> DataFrame:
    """Union of parquet files with different columns (``mergeSchema``).

    ``unify`` folds equivalent columns (e.g. ``{"dias": ["DIAS", "dias"]}``) into
    one typed column with ``coalesce(try_cast(..))``; only one of them is kept."""
    df = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
    for out, variants in (unify or {}).items():
        present = [c for c in df.columns if c in variants]
        typ = (cast or {}).get(out, "string")
        if present:
            val = F.coalesce(*[F.col(f"`{c}`").cast("string").try_cast(typ) for c in present])
            keep = [F.col(f"`{c}`") for c in df.columns if c not in present]
            df = df.select(*keep, val.alias(out))     # one typed column; never both spellings
    return df
