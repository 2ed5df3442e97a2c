"""Session construction and lineage cutting.

Library code never creates its own SparkSession; callers pass one in. `build_session`
is for scripts, tests and the bench. Checkpoints always go to the shared folder the
cluster names in `spark.checkpoint.dir`; a private folder is created only for a
local master where nothing is configured.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Checkpoint files of finished jobs are removed when their DataFrames are collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "orebridge",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """SparkSession with the settings the library is tested under."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder, set on the context if only the conf names it.

    Order: the context's folder, then `spark.checkpoint.dir`, then (local master only)
    a private temporary folder. A cluster without the setting is an error: a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/ABFS) so checkpoints survive executor loss")
        configured = tempfile.mkdtemp(prefix="orebridge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise `df` to the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints (shared storage) for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"



def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of `df` (for file scans: the bytes of the files read)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def size_shuffle_partitions(spark: SparkSession, *inputs: DataFrame,
                            target_partition_bytes: int = 256 << 20,
                            expansion: float = 3.0) -> int:
    """Raise `spark.sql.shuffle.partitions` so that a shuffle of all inputs lands in
    partitions of about `target_partition_bytes` (file bytes x `expansion` for the
    decoded rows). Never lowers the setting; AQE coalesces partitions that turn out
    small. Returns the value in force."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = sum(input_bytes(df) for df in inputs)
    needed = int(total * expansion // target_partition_bytes) + 1
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
        return needed
    return current
