"""Load and maintenance logs, and the reports over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import zero_to_null
from lakeops.operators.writes import append
from lakeops.sources.control import LOAD_STATUS_SCHEMA, MAINT_LOG_SCHEMA
from lakeops.sources.snapshot import CommitResult, Lake


def load_status_rows(results: DataFrame) -> DataFrame:
    """Log rows from step results.

    ``results`` has target, prev_version, new_version, rows_inserted, rows_updated, rows_deleted, status and the run
    columns (etl_date, jobname, jobrunid, jobid, taskrunid, taskname, userid, notebook, start_ts, end_ts). A failed
    step is logged with zero counts, previous version 0 and no new version.
    """
    parts = F.split("target", r"\.")
    failed = F.col("status") == "FAILED"

    def unless_failed(name: str):
        return F.when(failed, F.lit(0)).otherwise(F.col(name))

    return results.select(
        F.uuid().alias("etls_log_id"),
        F.col("etl_date").cast("date").alias("etls_load_date"),
        F.get(parts, 0).alias("etls_catalog"),
        F.get(parts, 1).alias("etls_schema"),
        F.get(parts, 2).alias("etls_table_name"),
        unless_failed("prev_version").cast("bigint").alias("etls_prev_ver"),
        zero_to_null(unless_failed("new_version")).cast("bigint").alias("etls_new_ver"),
        *[
            unless_failed(f"rows_{kind}").cast("bigint").alias(f"etls_rows_{kind}")
            for kind in ("inserted", "updated", "deleted")
        ],
        F.col("jobname").alias("etls_jobname"),
        F.col("jobrunid").alias("etls_jobrunid"),
        F.col("jobid").alias("etls_jobid"),
        F.col("taskrunid").alias("etls_taskrunid"),
        F.col("taskname").alias("etls_taskname"),
        F.col("notebook").alias("etls_notebook"),
        F.col("userid").alias("etls_run_by"),
        F.col("end_ts").alias("etls_end_timestamp"),
        F.col("start_ts").alias("etls_start_timestamp"),
        F.col("status").alias("etls_status"),
    ).select(*LOAD_STATUS_SCHEMA.names)


def log_load(lake: Lake, log_table: str, results: DataFrame) -> CommitResult:
    """Append the log rows of a run in one write."""
    return append(load_status_rows(results), lake.table(log_table))


def maintenance_rows(spark: SparkSession, events: Iterable[tuple]) -> DataFrame:
    """Events of one maintenance run as a DataFrame (a few rows per table looked after)."""
    return spark.createDataFrame(
        list(events),
        "operation STRING, catalog_name STRING, schema_name STRING, table_name STRING, status STRING, "
        "error_message STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, file_count_before INT, file_count_after INT",
    )


def maintenance_log_rows(events: DataFrame, run: dict[str, str]) -> DataFrame:
    """Log rows from maintenance events and the ids of the run."""
    stamped = {
        "tml_uuid": F.uuid(),
        "tml_timestamp": F.current_timestamp(),
        "tml_run_by": F.lit(run.get("run_by", "")),
        "tml_start_ts": F.col("start_ts"),
        "tml_end_ts": F.col("end_ts"),
        **{
            f"tml_{key}": F.lit(run.get(key, ""))
            for key in ("job_id", "job_name", "job_run_id", "task_run_id", "task_name")
        },
    }
    plain = ("operation", "catalog_name", "schema_name", "table_name", "status", "error_message")
    counts = ("file_count_before", "file_count_after")
    columns = {
        **stamped,
        **{f"tml_{name}": F.col(name) for name in plain},
        **{f"tml_{name}": F.col(name).cast("int") for name in counts},
    }
    return events.select(*[columns[f.name].alias(f.name) for f in MAINT_LOG_SCHEMA.fields])


def log_maintenance(lake: Lake, log_table: str, events: DataFrame, run: dict[str, str]) -> CommitResult:
    return append(maintenance_log_rows(events, run), lake.table(log_table))


def run_summary(log: DataFrame, job_run_id: str, task_run_id: str) -> DataFrame:
    """Maintenance log rows of one job run and task run, by time."""
    mine = (F.col("tml_job_run_id") == job_run_id) & (F.col("tml_task_run_id") == task_run_id)
    return log.where(mine).orderBy("tml_timestamp")


def load_report(log: DataFrame) -> DataFrame:
    """Rows moved and failures per load date and table."""
    return log.groupBy("etls_load_date", "etls_catalog", "etls_schema", "etls_table_name").agg(
        F.count(F.lit(1)).alias("steps"),
        *[F.sum(f"etls_rows_{kind}").alias(f"rows_{kind}") for kind in ("inserted", "updated", "deleted")],
        F.count_if(F.col("etls_status") == "FAILED").alias("failures"),
    )
