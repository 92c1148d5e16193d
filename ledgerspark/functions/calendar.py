"""Calendar expressions over dates and zone-free timestamps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names, in the order dayofweek() counts.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Month id of rows without an event time.
UNDATED = 0


def day_name(value: Column) -> Column:
    # get(), not element_at(): the latter returns an element for a NULL index in ANSI mode.
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return F.get(names, F.dayofweek(value) - 1)


def is_festive_season(value: Column) -> Column:
    """December, or the first seven days of January."""
    return (F.month(value) == 12) | ((F.month(value) == 1) & (F.dayofmonth(value) <= 7))


def add_calendar_features(df: DataFrame, time_column: str) -> DataFrame:
    value = F.col(time_column)
    return df.withColumns(
        {
            "day_name": day_name(value),
            "week_of_year": F.weekofyear(value),
            "is_festive_season": is_festive_season(value),
        }
    )


def month_start(value: Column) -> Column:
    return F.trunc(F.to_date(value), "MM")


def date_key(value: Column) -> Column:
    """``YYYYMMDD`` as BIGINT."""
    number = F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)
    return number.cast("bigint")


def month_id(year: Column, month: Column) -> Column:
    """``YYYYMM`` as INT; ``UNDATED`` when there is no event time."""
    return F.coalesce(year * 100 + month, F.lit(UNDATED)).cast("int")


def month_predicate(
    months: Iterable[int], year: str = "year", month: str = "month"
) -> Column | None:
    """Literal filter on partition columns for a set of month ids, or None when empty.

    One term per year, so the filter stays short; Spark prunes partitions with it.
    """
    by_year: dict[int, list[int]] = {}
    for value in sorted(set(months)):
        by_year.setdefault(value // 100, []).append(value % 100)
    predicate = None
    for year_value, month_values in by_year.items():
        if year_value == UNDATED:
            term = F.col(year).isNull()
        else:
            term = F.col(year).isNotNull() & (F.col(year) == year_value)
            term = term & F.col(month).isin(month_values)
        predicate = term if predicate is None else predicate | term
    return predicate
