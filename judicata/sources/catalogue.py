"""Open-data catalogue documents (SRC-9), landed file lists (SRC-10) and
latest-snapshot selection (SRC-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESOURCES = T.ArrayType(T.StructType([T.StructField("name", T.StringType()),
                                      T.StructField("url", T.StringType()),
                                      T.StructField("format", T.StringType())]))


def csv_resources(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Resources of landed ``package_show`` answers whose URL ends in .csv (any case).

    ``result`` may be an object or a list holding one object."""
    raw = F.get_json_object(F.col(text_col), "$.result")
    obj = F.when(F.trim(raw).startswith("["), F.get_json_object(raw, "$[0]")).otherwise(raw)
    res = F.from_json(F.get_json_object(obj, "$.resources"), RESOURCES)
    x = docs.select(F.get_json_object(obj, "$.name").alias("dataset"), F.explode_outer(res).alias("r"))
    x = x.select("dataset", "r.name", "r.url", "r.format")
    return x.where(F.lower(F.trim(F.col("url"))).endswith(".csv"))


def landed_files(spark: SparkSession, listed: DataFrame | None, root: str, glob: str = "*") -> DataFrame:
    """Union of the catalogue's file list and the files found on disk, de-duplicated by path.

    The disk listing uses ``binaryFile`` without its content column, so no file
    body is read."""
    disk = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
            .load(root).select("path"))
    out = disk if listed is None else listed.select("path").unionByName(disk)
    return out.dropDuplicates(["path"])


def latest_snapshots(files: DataFrame, dataset: str = "dataset", snapshot: str = "snapshot") -> DataFrame:
    """Only the newest snapshot of each dataset (cumulative snapshots must never be
    concatenated: that double counts years)."""
    mx = files.groupBy(dataset).agg(F.max(snapshot).alias(snapshot))
    return files.join(mx, [dataset, snapshot], "left_semi")
