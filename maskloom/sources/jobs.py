"""Job snapshots and call logs in and out, and what retention removes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom import schemas as C


def read_job_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Jobs as read from their JSON, documents nested; a job without a mode is a redact job."""
    return with_defaults(spark.read.schema(C.JOB).json(path))


def with_defaults(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("mode", F.coalesce("mode", F.lit("redact")))


def flatten_jobs(jobs: DataFrame) -> DataFrame:
    """One row per job document; a job without documents keeps one row with none."""
    return jobs.select(
        "job_id", F.col("status").alias("job_status"), "retention", "mode", "created_at",
        F.explode_outer("documents").alias("document"),
    ).select(
        "job_id", "job_status", "retention", "mode", "created_at",
        F.col("document.id").alias("document_id"), "document.file_name", "document.status",
        "document.page_count", "document.error_message",
    )


def read_call_log(spark: SparkSession, path: str) -> DataFrame:
    """Call records, one JSON line each."""
    return spark.read.schema(C.CALL_LOG).json(path)


def call_log_lines(log: DataFrame) -> DataFrame:
    """Call records as JSON lines; fields without a value are left out."""
    return log.select(F.to_json(F.struct("*")).alias("value"))


def write_call_log(log: DataFrame, path: str) -> None:
    call_log_lines(log).write.mode("errorifexists").text(path)


def _ended(created_at: Column, now: Column, days: int) -> Column:
    return created_at + F.make_interval(days=F.lit(days)) < now


def expire_outputs(artifacts: DataFrame, now: Column, days: int = C.RETENTION_DAYS) -> DataFrame:
    """Adds ``expired`` to (job_id, kind, retention, created_at, processed_at) artifacts.

    Kind is original, masks or output. Ephemeral jobs lose the original and the masks once
    processed and the output after ``days``; studio jobs keep all three.
    """
    ephemeral = F.coalesce("retention", F.lit("ephemeral")) == "ephemeral"
    gone = F.when(F.col("kind") == "output", _ended(F.col("created_at"), now, days)).otherwise(
        F.col("processed_at").isNotNull() & (F.col("processed_at") <= now)
    )
    return artifacts.withColumn("expired", F.coalesce(ephemeral & gone, F.lit(False)))


def keep_outputs(artifacts: DataFrame, deleted_jobs: DataFrame, now: Column, days: int = C.RETENTION_DAYS) -> DataFrame:
    """The next snapshot: without expired artifacts and without the jobs a user deleted."""
    live = expire_outputs(artifacts, now, days).where(~F.col("expired")).drop("expired")
    return live.join(deleted_jobs.select("job_id").distinct(), "job_id", "left_anti")
