"""Incremental arrival of snapshot files (STR-3).

Datasets publish cumulative snapshots; a newer snapshot replaces the dataset's
slice, it is never appended.  Slices and manifest switch together: a batch writes
its slices into a folder of its own, which nobody reads yet, and then a version of
the manifest that names, for every dataset, the batch that holds its slice.  The
version counts from the moment its ``_SUCCESS`` marker stands, which is one file, so
a reader sees the state before the batch or after it, never a mixture.  Everything
is keyed by the batch id: a batch that is replayed after a crash overwrites what
it had written, and one that had been committed changes nothing.  A snapshot older
than the dataset's current one replaces nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata.sinks.manifest import upsert

MANIFEST = "id string, fecha_corte string, n_registros long, seq long"


def _versions(spark: SparkSession, manifest_path: str) -> list[int]:
    """Batch ids whose manifest is complete, ascending."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    at = path_of(manifest_path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    done = [n for n in names if n.startswith("batch=") and fs.exists(path_of(f"{manifest_path}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("batch=")) for n in done)


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """(id, fecha_corte, n_registros, seq) of the last committed batch; ``seq`` is the batch that holds the slice."""
    done = _versions(spark, manifest_path)
    if not done:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{manifest_path}/batch={done[-1]}")


def read_current(spark: SparkSession, target: str, manifest_path: str, schema, dataset: str = "dataset") -> DataFrame:
    """Rows of the current slice of every dataset."""
    done = _versions(spark, manifest_path)
    if not done:
        return spark.createDataFrame([], schema)
    held = read_manifest(spark, manifest_path).select(F.col("id").alias(dataset), F.col("seq").alias("_batch"))
    batches = [r[0] for r in held.select("_batch").distinct().collect()]        # of a row a dataset
    rows = None
    for b in batches:
        part = spark.read.schema(schema).parquet(f"{target}/batch={b}").withColumn("_batch", F.lit(b).cast("long"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.join(held, [dataset, "_batch"], "left_semi").drop("_batch")


def apply_snapshot_batch(batch: DataFrame, target: str, manifest_path: str, batch_id: int,
                         dataset: str = "dataset", snapshot: str = "snapshot", between: Callable[[], None] | None = None) -> bool:
    """Commit one batch; False if it had been committed before.  ``between`` runs
    after the slices are written and before the manifest is."""
    spark = batch.sparkSession
    done = _versions(spark, manifest_path)
    if done and done[-1] >= batch_id:
        return False
    old = read_manifest(spark, manifest_path)
    newest = batch.groupBy(dataset).agg(F.max(snapshot).alias(snapshot))
    later = newest[snapshot] < old["fecha_corte"]           # an older snapshot that arrives late replaces nothing
    newest = newest.join(old, (newest[dataset] == old["id"]) & later, "left_anti")
    slices = f"{target}/batch={batch_id}"
    batch.join(newest, [dataset, snapshot], "left_semi").write.mode("overwrite").partitionBy(dataset).parquet(slices)
    written = spark.read.schema(batch.schema).parquet(slices)
    entries = written.groupBy(F.col(dataset).cast("string").alias("id")).agg(
        F.max(snapshot).cast("string").alias("fecha_corte"), F.count(F.lit(1)).alias("n_registros"), F.lit(batch_id).cast("long").alias("seq"))
    if between is not None:
        between()
    upsert(old, entries, "id", "seq").write.mode("overwrite").parquet(f"{manifest_path}/batch={batch_id}")
    return True


def drop_superseded(spark: SparkSession, target: str, manifest_path: str, keep_versions: int = 2) -> list[int]:
    """Delete manifests before the last ``keep_versions`` and slice folders that none of those names."""
    done = _versions(spark, manifest_path)
    kept = done[-keep_versions:]
    named = {r[0] for v in kept for r in spark.read.schema(MANIFEST).parquet(f"{manifest_path}/batch={v}").select("seq").distinct().collect()}
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(target).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [v for v in done if v not in kept]
    for v in gone:
        fs.delete(path_of(f"{manifest_path}/batch={v}"), True)
    folders = [s.getPath().getName() for s in fs.listStatus(path_of(target))]
    for v in (int(n.removeprefix("batch=")) for n in folders if n.startswith("batch=")):
        if kept and v < kept[-1] and v not in named:            # a later one may be on its way
            fs.delete(path_of(f"{target}/batch={v}"), True)
    return gone


def start_snapshot_stream(spark, source_dir: str, schema, target: str, manifest_path: str, checkpoint: str,
                          fmt: str = "parquet", trigger_once: bool = True):
    stream = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True).load(source_dir)
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
               .foreachBatch(lambda df, bid: apply_snapshot_batch(df, target, manifest_path, bid) and None))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
