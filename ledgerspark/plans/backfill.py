"""Month-level backfill planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.operators.coverage import backfill_plan, loaded_months, month_range
from ledgerspark.sinks.runlog import read_run_log
from ledgerspark.sources.bronze import bronze_months


def plan_backfill(
    spark: SparkSession, start: str, end: str, bronze_dir: str, run_log_dir: str
) -> DataFrame:
    """(status, month) rows for an inclusive ``YYYY-MM`` range. Reads only.

    Statuses: requested, available, selected, not_available, latest_loaded.
    """
    return backfill_plan(
        month_range(spark, start, end),
        bronze_months(spark, bronze_dir),
        loaded_months(read_run_log(spark, run_log_dir)),
    )
