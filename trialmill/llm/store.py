"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only a local session without that setting gets a temporary folder."""
    top = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="trialmill-shared-")
        spark.conf.set(CHECKPOINT_CONF, top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark deletes a query's shuffle files when it has ended; of use where the result is written down.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, keep_shuffles: bool = True) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there and lost executors cost nothing.

    With ``keep_shuffles`` false the shuffle files behind the rows are deleted as soon as they are written.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    if not keep_shuffles:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes what :func:`saved` wrote, after its last use."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
