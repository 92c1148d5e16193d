"""Day coverage, missing days, backfill planning and run summaries."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.calendar import UNDATED, month_id

PLAN_STATUSES = ("requested", "available", "selected", "not_available", "latest_loaded")


def day_coverage(df: DataFrame) -> DataFrame:
    """Sorted days seen in each month. A month has at most 31, so the set stays small."""
    return df.groupBy("year", "month").agg(F.sort_array(F.collect_set("day")).alias("days"))


def missing_days(coverage: DataFrame, as_of: date | None = None) -> DataFrame:
    """Days of each observed month that were not seen.

    The current month is only expected up to ``as_of`` (default: today).
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    first = F.make_date("year", "month", F.lit(1))
    is_current = (F.col("year") == F.year(today)) & (F.col("month") == F.month(today))
    limit = F.when(is_current, F.dayofmonth(today)).otherwise(F.dayofmonth(F.last_day(first)))
    expected = F.sequence(F.lit(1), limit)
    return coverage.where(F.col("year").isNotNull()).select(
        "year", "month", F.array_except(expected, F.col("days")).alias("missing_days")
    )


def parse_month(text: str) -> date:
    """``YYYY-MM`` to the first day of the month."""
    match = re.fullmatch(r"\s*(\d+)-(\d+)\s*", text)
    if match is None:
        raise ValueError(f"{text!r} is not a month such as 2024-07.")
    year, month = int(match[1]), int(match[2])
    if not 1 <= month <= 12:
        raise ValueError(f"{text!r} names month {month}, but a year has twelve.")
    return date(year, month, 1)


def months_between(start: Column, end: Column) -> Column:
    """Array of month starts from ``start`` to ``end``, both included; empty if reversed."""
    first, last = F.trunc(start, "MM"), F.trunc(end, "MM")
    step = F.expr("INTERVAL 1 MONTH")
    return F.when(first <= last, F.sequence(first, last, step)).otherwise(
        F.array().cast("array<date>")
    )


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per month of an inclusive ``YYYY-MM`` range."""
    first, last = parse_month(start), parse_month(end)
    if first > last:
        raise ValueError(
            f"Backfill range start {first:%Y-%m} must be before or equal to {last:%Y-%m}."
        )
    return spark.range(1).select(
        F.explode(months_between(F.lit(first), F.lit(last))).alias("month")
    )


def available_months(bronze: DataFrame) -> DataFrame:
    """Valid months present in a (year, month) partitioned dataset."""
    return (
        bronze.where(F.col("month").between(1, 12) & F.col("year").isNotNull())
        .select(F.make_date("year", "month", F.lit(1)).alias("month"))
        .distinct()
    )


def loaded_months(run_log: DataFrame) -> DataFrame:
    """Months covered by the latest run. Invalid months are skipped."""
    months = run_log.agg(F.max_by("months", "run_at").alias("months"))
    month = F.col("month_id") % 100
    return (
        months.select(F.explode("months").alias("month_id"))
        .where((F.col("month_id") != UNDATED) & month.between(1, 12))
        .select(F.make_date((F.col("month_id") / 100).cast("int"), month, F.lit(1)).alias("month"))
        .distinct()
    )


def backfill_plan(requested: DataFrame, available: DataFrame, loaded: DataFrame) -> DataFrame:
    """(status, month) rows for the five lists of a plan. Read-only."""
    lists = {
        "requested": requested,
        "available": available,
        "selected": requested.intersect(available),
        "not_available": requested.subtract(available),
        "latest_loaded": loaded,
    }
    plan = None
    for status in PLAN_STATUSES:
        part = lists[status].select(
            F.lit(status).alias("status"), F.date_format("month", "yyyy-MM").alias("month")
        )
        plan = part if plan is None else plan.unionByName(part)
    return plan


def has_new_data() -> Column:
    """Whether a run-log row wrote data; an unknown row count (-1) counts as data."""
    return (
        F.col("silver_status").eqNullSafe(F.lit("completed"))
        & ~F.coalesce(F.col("was_skipped"), F.lit(False))
        & F.coalesce(F.col("rows_written") != 0, F.lit(False))
    )


def run_summary(run_log: DataFrame) -> DataFrame:
    return run_log.select(
        "run_at",
        has_new_data().alias("has_new_data"),
        F.coalesce("rows_written", F.lit(0)).cast("bigint").alias("rows_written"),
        "silver_status",
        "table_name",
    )


def pending_month_ids(pending: DataFrame) -> list[int]:
    """Month ids of a pending table; bounded by the number of calendar months."""
    rows = pending.select(month_id(F.col("year"), F.col("month")).alias("m")).distinct().collect()
    return sorted(row["m"] for row in rows)


# --- coverage of many feeds as bits ------------------------------------------------------


def month_bits(months: DataFrame, feed: str, month: str = "month") -> DataFrame:
    """feed, year, bits: bit 0 is January. One row per feed and year, combined on the map side.

    Rows without a month say nothing about coverage; a null feed is a feed of its own.
    """
    bit = F.expr(f"shiftleft(1, month(`{month}`) - 1)")
    return (
        months.where(F.col(month).isNotNull())
        .groupBy(F.col(feed).alias("feed"), F.year(month).alias("year"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def range_bits(ranges: DataFrame, feed: str, first: str = "first", last: str = "last") -> DataFrame:
    """feed, year, bits of all months from ``first`` to ``last``, which are one row per year.

    Reversed ranges have none. Ranges of a feed may overlap.
    """
    rows = ranges.where(F.trunc(first, "MM") <= F.trunc(last, "MM")).select(
        F.col(feed).alias("feed"),
        F.explode(F.sequence(F.year(first), F.year(last))).alias("year"),
        F.col(first).alias("first"),
        F.col(last).alias("last"),
    )
    low = F.when(F.year("first") == F.col("year"), F.month("first")).otherwise(F.lit(1))
    high = F.when(F.year("last") == F.col("year"), F.month("last")).otherwise(F.lit(12))
    rows = rows.withColumns({"low": low, "high": high})
    return rows.groupBy("feed", "year").agg(
        F.bit_or(F.expr("shiftleft(1, high) - shiftleft(1, low - 1)")).alias("bits")
    )


def months_of_bits(bits: DataFrame) -> DataFrame:
    """feed, month (its first day) for every bit that is set."""
    month = F.expr("explode(filter(sequence(1, 12), m -> (bits & shiftleft(1, m - 1)) <> 0))")
    return bits.select("feed", "year", month.alias("m")).select(
        "feed", F.make_date("year", "m", F.lit(1)).alias("month")
    )


def backfill_bits(requested: DataFrame, available: DataFrame, loaded: DataFrame) -> DataFrame:
    """feed, year and the bits of the five lists of a plan, for all feeds at once.

    The inputs are feed, year, bits. They are added up by one aggregate, so there is no join
    and no set operation: what is selected or not available follows from two words by AND.
    """
    sides = {"requested": requested, "available": available, "latest_loaded": loaded}
    rows = None
    for name, side in sides.items():
        part = side.select(
            "feed", "year",
            *[(F.col("bits") if c == name else F.lit(0)).cast("int").alias(c) for c in sides],
        )
        rows = part if rows is None else rows.unionByName(part)
    plan = rows.groupBy("feed", "year").agg(*(F.bit_or(c).alias(c) for c in sides))
    return plan.select(
        "feed", "year", "requested", "available",
        F.expr("requested & available").alias("selected"),
        F.expr("requested & ~available").alias("not_available"),
        "latest_loaded",
    )


def backfill_plans(requested: DataFrame, available: DataFrame, loaded: DataFrame) -> DataFrame:
    """(feed, status, month) rows: :func:`backfill_plan` of every feed, from bits."""
    lists = backfill_bits(requested, available, loaded).select(
        "feed", "year",
        F.explode(
            F.array(*(F.struct(F.lit(c).alias("status"), F.col(c).alias("bits")) for c in PLAN_STATUSES))
        ).alias("list"),
    )
    month = F.expr("explode(filter(sequence(1, 12), m -> (list.bits & shiftleft(1, m - 1)) <> 0))")
    return lists.select("feed", "year", "list.status", month.alias("m")).select(
        "feed", "status", F.date_format(F.make_date("year", "m", F.lit(1)), "yyyy-MM").alias("month")
    )
