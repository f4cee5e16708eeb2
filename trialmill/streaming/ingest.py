"""Continuous ingest of report documents into the stored history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trialmill.sinks import tables
from trialmill.sinks.history import HistoryStore

#: Files of one micro-batch, so that a first run over a long history comes in batches as well.
FILES_PER_TRIGGER = 10_000


def report_stream(spark: SparkSession, root: str, files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """Stream of report files: pipeline_run_id (parent folder), artifact_text, doc."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "report.json")
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return reader.load(root).select(
        folder.alias("pipeline_run_id"),
        F.col("value").alias("artifact_text"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )


def store_batch(batch: DataFrame, folder: str) -> None:
    """Append the runs of one micro-batch that are not stored yet; a repeated batch adds nothing."""
    docs = batch.withColumn("doc", F.try_parse_json("artifact_text"))
    tables.store_runs(tables.report_runs(docs), tables.report_trials(docs), folder)


def ingest_stream(
    reports: DataFrame, folder: str, checkpoint: str, once: bool = False, watermark: str = "7 days"
) -> StreamingQuery:
    """Exactly once per run id: the stream's checkpoint resumes where it stopped, repeats inside the
    watermark are dropped from state, and older ones by the anti-join with the stored table."""
    unique = reports.withWatermark("arrived_at", watermark).dropDuplicatesWithinWatermark(["pipeline_run_id"])
    writer = unique.writeStream.foreachBatch(lambda batch, _: store_batch(batch, folder)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def ingest_history(reports: DataFrame, store: HistoryStore, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Stores each micro-batch in the partitioned history, all tables of it or nothing, exactly once.

    A batch is known by the stream's id, which its checkpoint keeps, and its number: one that was committed before
    the checkpoint noted it is left out when it comes again, one that was not committed is written anew. No state
    is kept per run; repeats in other batches meet the history's own filters.
    """

    def put(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        docs = batch.withColumn("doc", F.try_parse_json("artifact_text"))
        store.store({"evaluation_runs": tables.report_runs(docs), "trials": tables.report_trials(docs)}, f"{stream}-{number}")

    writer = reports.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
