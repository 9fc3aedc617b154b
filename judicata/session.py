"""Session construction and lineage cutting.

The session is built with AQE (coalescing, skew-join splitting and runtime
broadcast conversion) so that join strategies are chosen from measured sizes,
not guessed ones.  Nothing here sets a machine-local directory on a cluster:
the checkpoint folder is read from ``spark.checkpoint.dir`` and only filled in
when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conservative defaults; a cluster's spark-defaults win because we only set
# keys through the builder (getOrCreate keeps an existing session's conf).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Static (plan-time) broadcast decisions rest on compressed file sizes, a
    # guess that can be 5-10x below the in-memory size.  Keep that guess for tiny
    # inputs only, and let AQE broadcast data-derived sides after measuring them
    # (runtime shuffle statistics), falling back to sort-merge join when large.
    "spark.sql.autoBroadcastJoinThreshold": str(1 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 << 20),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state off-heap in RocksDB (large keyed state; required by transformWithState)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "judicata",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage configured by the operator;
    we never invent one there.  Only in local mode with no setting do we make a
    scratch folder (tests)."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for the cluster")
        d = tempfile.mkdtemp(prefix="judicata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shared_folder(spark: SparkSession, prefix: str = "run") -> str:
    """A new folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two consumers need the same costly rows, and to cut lineage: the
    files survive a lost executor, and later stages reread them instead of
    recomputing the work before them."""
    path = shared_folder(df.sparkSession)
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
