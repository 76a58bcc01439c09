"""Run log: what ran, when, with what result."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.constants import REQUIRED_STAGES, RUN_LOG_SCHEMA
from parcelight.sinks import append_rows
from parcelight.sources.tables import LeadTables

SUMMARY_COLUMNS = [
    "stage", "status", "records_in", "records_out", "duration_secs",
    "error_message", "created_at",
]


def new_run_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("RUN_%Y%m%d_%H%M%S")


def _newest(df: DataFrame):
    """Order of log rows; a sequence number, where there is one, decides ties."""
    order = [F.col("created_at")]
    if "id" in df.columns:
        order.append(F.col("id"))
    return order


def log_stage(
    tables: LeadTables,
    run_id: str,
    stage: str,
    status: str,
    records_in: int = 0,
    records_out: int = 0,
    duration_secs: float = 0.0,
    pipeline_mode: str | None = None,
    run_mode: str | None = None,
    error_message: str | None = None,
) -> None:
    """Appends one row; few rows become few files (:func:`~parcelight.sinks.compact`). Its sequence number orders rows of equal times; the
    clock in nanoseconds, as one process logs a run."""
    row = (
        time.time_ns(), run_id, stage, status, records_in, records_out,
        round(float(duration_secs), 2), pipeline_mode, run_mode, error_message,
        dt.datetime.now(),
    )
    append_rows(tables.spark.createDataFrame([row], RUN_LOG_SCHEMA), tables, "pipeline_log")


def log_stage_error(
    tables: LeadTables, run_id: str, stage: str, error: Exception | str, **modes
) -> None:
    log_stage(tables, run_id, stage, "failed", error_message=str(error), **modes)


def latest_status(log: DataFrame) -> DataFrame:
    """Newest status of every (run, stage)."""
    newest = F.struct(*_newest(log), F.col("status"))
    return log.groupBy("run_id", "stage").agg(
        F.max_by("status", newest).alias("status")
    )


def stage_status(log: DataFrame, run_id: str, stage: str) -> str | None:
    wanted = (F.col("run_id") == run_id) & (F.col("stage") == stage)
    row = latest_status(log.where(wanted)).first()
    return row["status"] if row else None


def last_run(log: DataFrame) -> DataFrame:
    """One row: the run of the newest log entry (NULL for an empty log)."""
    newest = F.struct(*_newest(log), F.col("run_id"))
    return log.agg(F.max_by("run_id", newest).alias("run_id"))


def run_summary(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of one run (by default the last) in time order."""
    wanted = F.lit(run_id) if run_id else last_run(log).scalar()
    return (
        log.where(F.col("run_id") == wanted)
        .orderBy(*_newest(log))
        .select(*SUMMARY_COLUMNS)
    )


def run_completion(log: DataFrame, mode: str) -> DataFrame:
    """For every run: whether each stage the mode requires last completed."""
    required = REQUIRED_STAGES[mode]
    done = F.col("stage").isin(*required) & (F.col("status") == "completed")
    return (
        latest_status(log)
        .groupBy("run_id")
        .agg((F.count_if(done) == len(required)).alias("complete"))
    )


def is_complete(log: DataFrame, run_id: str, mode: str) -> bool:
    row = run_completion(log.where(F.col("run_id") == run_id), mode).first()
    return bool(row and row["complete"])


def resume_run_id(tables: LeadTables, mode: str, fresh: bool = False) -> str:
    """Id for the next run: an incomplete training run is taken up again,
    scoring and a fresh start always get a new id."""
    if fresh or mode == "PREDICT":
        return new_run_id()
    log = tables.read("pipeline_log")
    last = last_run(log).first()["run_id"]
    if last is None or is_complete(log, last, mode):
        return new_run_id()
    return last
