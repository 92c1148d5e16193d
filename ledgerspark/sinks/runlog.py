"""Run log: one row per load of the trusted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sinks.tables import append_table, read_or_empty

RUN_LOG_DDL = (
    "run_at timestamp, silver_status string, table_name string, rows_written bigint, "
    "write_mode string, months array<int>, was_skipped boolean, skip_reason string"
)


def run_record(
    spark: SparkSession,
    *,
    status: str,
    table_name: str,
    write_mode: str,
    rows_written: int = 0,
    months: Sequence[int] = (),
    skip_reason: str | None = None,
) -> DataFrame:
    row = (
        status,
        table_name,
        rows_written,
        write_mode,
        list(months),
        status == "skipped",
        skip_reason,
    )
    ddl = RUN_LOG_DDL.removeprefix("run_at timestamp, ")
    return spark.createDataFrame([row], ddl).select(F.current_timestamp().alias("run_at"), "*")


def append_run(record: DataFrame, root: str) -> None:
    append_table(record, root)


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, root, RUN_LOG_DDL)
