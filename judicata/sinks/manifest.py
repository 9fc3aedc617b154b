"""Manifest upsert by ``id`` (SNK-3): new entries win, others are kept.

Both batches are unioned and reduced by one aggregate per id (``max_by`` on
batch priority, then ``order``), so duplicate ids inside a batch resolve to the
last entry, there is no join, and a hot id stays partial-aggregated.  Writing goes to a fresh version folder,
never in place, so a failed run leaves the previous manifest intact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Union of both batches, then one aggregate per id keeping the entry with the
    largest (batch priority, ``order``): new beats old, the last new entry beats
    earlier ones, untouched old entries stay.  No join, partial-aggregated."""
    u = old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in u.columns if c not in (key, "_p")]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(F.col("_p"), F.col(order)))
    return u.groupBy(key).agg(best.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def write_version(df: DataFrame, base: str, version: str) -> str:
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def _files(spark: SparkSession, path: str):
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return path_of, path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())


def manifest_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a manifest; one whose switch was cut short is put back first."""
    path_of, fs = _files(spark, path)
    if not fs.exists(path_of(path)) and fs.exists(path_of(path + ".last")):
        fs.rename(path_of(path + ".last"), path_of(path))
    return fs.exists(path_of(path))


def replace_manifest(merged: DataFrame, path: str) -> None:
    """The new version is complete before it takes the old one's place."""
    spark = merged.sparkSession
    path_of, fs = _files(spark, path)
    merged.write.mode("overwrite").parquet(path + ".next")
    fs.delete(path_of(path + ".last"), True)
    if fs.exists(path_of(path)):
        fs.rename(path_of(path), path_of(path + ".last"))
    fs.rename(path_of(path + ".next"), path_of(path))
