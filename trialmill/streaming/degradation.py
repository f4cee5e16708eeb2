"""Continuous degradation and score variance: one row per run as it arrives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from trialmill.operators.history import DEGRADATION_THRESHOLD, VARIANCE_WINDOW

RECENT = StructType(
    [StructField("at", TimestampType()), StructField("run_id", StringType()), StructField("score", DoubleType())]
)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = (
    "submission_name string, eval_engine string, current_run_id string, previous_run_id string, "
    "current_score double, previous_score double, ratio double, degraded boolean, "
    "score_variance double, run_count int, late boolean"
)


class DegradationProcessor(StatefulProcessor):
    """Per submission and engine: the newest runs, at most five, in time order.

    Runs may arrive in any order. One that is older than the newest known is reported as late, compared with the
    run before it, and takes its place in the state, so that runs that follow have the predecessor and the variance
    that the batch gives them. Of runs older than all in a full state the predecessor is not known any more. A run
    without a score has no ratio and counts in no variance.
    """

    def __init__(self, threshold: float = DEGRADATION_THRESHOLD, window: int = VARIANCE_WINDOW):
        self.threshold = threshold
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", RECENT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one micro-batch of one submission; its size is set by the source's trigger options
        known = list(self.recent.get()) if self.recent.exists() else []
        runs = pd.concat(
            [
                pd.DataFrame([tuple(r) for r in known], columns=["at", "run_id", "score"]).assign(new=False),
                *(pd.DataFrame({"at": r["created_at"], "run_id": r["pipeline_run_id"], "score": r["treatment_pass_rate"], "new": True}) for r in rows),
            ][0 if known else 1 :]
        )
        runs["at"] = pd.to_datetime(runs["at"])
        runs = runs.sort_values(["at", "run_id"], ignore_index=True)
        score = runs["score"].astype(float).to_numpy()
        before = np.concatenate([[np.nan], score[:-1]])
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(before == 0, np.where(np.isnan(score), np.nan, np.where(score == 0, 0.0, np.inf)), score / before)
        windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(self.window - 1, np.nan), score]), self.window)
        count = (~np.isnan(windows)).sum(axis=1)
        mean = np.nansum(windows, axis=1) / np.maximum(count, 1)
        spread = np.nansum((windows - mean[:, None]) ** 2, axis=1)
        newest_known = runs.index[~runs["new"]].max() if known else -1
        out = pd.DataFrame(
            {
                "submission_name": key[0], "eval_engine": key[1], "current_run_id": runs["run_id"], "previous_run_id": runs["run_id"].shift(1),
                "current_score": score, "previous_score": before, "ratio": ratio, "degraded": ratio < self.threshold,
                "score_variance": np.where(count > 1, spread / np.maximum(count - 1, 1), 0.0), "run_count": count.astype("int32"),
                "late": np.asarray(runs.index < newest_known),
            }
        )
        for name in ("previous_run_id", "current_score", "previous_score", "ratio"):
            out[name] = out[name].astype(object).where(out[name].notna(), None)
        last = runs.tail(self.window)
        state = zip(last["at"].dt.to_pydatetime(), last["run_id"], last["score"].astype(float), strict=True)
        self.recent.put([(at, run_id, None if x != x else x) for at, run_id, x in state])
        yield out[runs["new"]].reset_index(drop=True)

    def close(self) -> None:
        pass


def degradation_stream(runs: DataFrame, threshold: float = DEGRADATION_THRESHOLD) -> DataFrame:
    """Streaming counterpart of :func:`trialmill.operators.history.degradation` by engine.

    ``runs``: submission_name, eval_engine, pipeline_run_id, created_at (timestamp), treatment_pass_rate. The session
    must keep its state in RocksDB (``spark.sql.streaming.stateStore.providerClass``), as :func:`build_session` sets it.
    """
    if runs.sparkSession.conf.get(PROVIDER) != STATE_STORE:
        raise ValueError(f"set {PROVIDER} to {STATE_STORE}")
    return runs.groupBy("submission_name", "eval_engine").transformWithStateInPandas(
        statefulProcessor=DegradationProcessor(threshold),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None",
    )
