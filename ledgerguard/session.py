"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Spark settings the operators are designed around.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting handles hot keys
# that survive our own pre-aggregation.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",   # checkpoints go with the frames that read them
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of executors, ~100 TB input).  Shuffle
# partitions start high and AQE coalesces them toward the advisory size, so a
# stage never has too few tasks for the data; skewed partitions above the
# threshold are split at run time; scans make ~512 MB input splits.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "256m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
}


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 * 1024 ** 2, minimum: int = 8) -> int:
    """Initial shuffle partition count for an expected shuffle volume (AQE then
    coalesces small partitions and splits skewed ones)."""
    return max(minimum, int(shuffle_bytes // target_bytes) + 1)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerguard", extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    """Session with the library's defaults; ``cluster=True`` adds CLUSTER_CONF
    (``master`` is then left to spark-submit)."""
    builder = SparkSession.builder.appName(app_name)
    if not cluster:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    else:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is.  Only
    when it is unset (local tests) do we create a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints and stream "
                               "sinks must survive the loss of any machine")
        # local mode only (tests): a private scratch folder on this machine
        configured = tempfile.mkdtemp(prefix="ledgerguard-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str = "table"):
    """``df`` written as Parquet to the checkpoint folder and read again.  It cuts the lineage like a
    checkpoint, but is compressed, and later passes read only their columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
