"""Session helpers: settings the jobs rely on and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(cpus: int | str = "*", app_name: str = "trialmill") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # exact percentiles use object aggregation; the default falls back to sorting at 128 keys per task
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "8192")
        .config("spark.driver.memory", os.environ.get("TRIALMILL_DRIVER_MEMORY", "8g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        # keyed stream state with lists needs it
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the cluster's shared checkpoint folder, so lost executors can be replaced.

    The folder named in ``spark.checkpoint.dir`` is used. Only where it is unset in a local session (tests)
    a temporary one is made; on a cluster its executors could not read that, so this raises there.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
        if not folder and context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="trialmill-checkpoint-"))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names, which driver and executors share.

    Only a local session without that setting gets a temporary folder.
    """
    top = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not top:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="trialmill-shared-")
        spark.conf.set(CHECKPOINT_CONF, top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
