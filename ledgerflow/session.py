"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so dates never shift, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast
# conversion from measured sizes).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are broadcast only when the planner's size estimate (or the
    # measured size under AQE) is below this bound; never by hint.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


#: Rows of a looked-up table from which it is never broadcast: about 85 MB in the driver for the lookups of the star.
BROADCAST_ROWS = 400_000


def build_session(master: str | None = None, app: str = "ledgerflow",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session. Only a local-mode session
    without that setting (unit tests) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def has_many_rows(df: DataFrame) -> bool:
    """Whether a stored table has more than ``BROADCAST_ROWS`` rows (counted from the footers of Parquet files)."""
    return df.count() > BROADCAST_ROWS


def looked_up(df: DataFrame, many_rows: bool) -> DataFrame:
    """``df`` as the looked-up side of a join.  The planner estimates a side by the size of its compressed files, which
    can be a hundredth of what the driver and every executor would hold of it; a side of many rows is joined by shuffle
    and sort whatever the estimate."""
    return df.hint("merge") if many_rows else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
