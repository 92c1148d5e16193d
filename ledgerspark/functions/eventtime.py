"""Event-time parsing. All results are TIMESTAMP_NTZ: no zone is ever applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text forms a payload event time may take.
US_SECONDS = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"
US_MINUTES = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2})(:\d{1,2})?$"
ISO_BASIC = r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2}))?$"
ISO_LIKE = r"^\d{4}-\d{1,2}-\d{1,2}(?:$|[T ]\d)"
NAME_DASHED = r"(?<!\d)(\d{4})_(\d{2})_(\d{2})(?!\d)"
NAME_COMPACT = r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)"


def _cast_iso(text: Column) -> Column:
    # try_cast gives NULL for impossible dates, with ANSI mode on or off.
    return text.try_cast(T.TimestampNTZType())


def try_parse_strict(text: Column) -> Column:
    """``MM/dd/yyyy HH:mm:ss`` to a timestamp, NULL for anything else.

    Rewrites to ISO order and casts, which needs no formatter object per row.
    """
    iso = F.regexp_replace(text, US_SECONDS, "$3-$1-$2 $4:$5:$6")
    return F.when(text.contains("/"), _cast_iso(iso))


def parse_strict(text: Column) -> Column:
    """Like :func:`try_parse_strict`, but a non-null bad value fails the job."""
    parsed = try_parse_strict(text)
    message = F.concat(F.lit("Unsupported event time value: "), text)
    failure = F.raise_error(message).cast(T.TimestampNTZType())
    # Coalesced, so that each text is parsed once.
    return F.coalesce(parsed, F.when(text.isNotNull(), failure))


def parse_lenient(text: Column) -> Column:
    """Any supported form (US order, ISO with or without zone) or NULL.

    A zone suffix is dropped: the wall clock as written is what counts.
    """
    trimmed = F.trim(text)
    us = F.regexp_replace(trimmed, US_MINUTES, "$3-$1-$2 $4:$5$6")
    basic_date = F.regexp_replace(trimmed, ISO_BASIC, "$1-$2-$3")
    basic_time = F.regexp_replace(trimmed, ISO_BASIC, "$1-$2-$3 $4:$5:$6")
    return (
        F.when(trimmed.contains("/"), _cast_iso(us))
        .when(trimmed.rlike(ISO_LIKE), _cast_iso(trimmed))
        .when(
            trimmed.rlike(ISO_BASIC),
            F.when(F.length(trimmed) == 8, _cast_iso(basic_date)).otherwise(
                _cast_iso(basic_time)
            ),
        )
    )


def add_event_time(df: DataFrame, time_column: str, new_column: str) -> DataFrame:
    """Parse ``time_column`` strictly and add ``year``, ``month`` and ``day``."""
    parsed = df.withColumn(new_column, parse_strict(F.col(time_column)))
    event_time = F.col(new_column)
    return parsed.withColumns(
        {
            "year": F.year(event_time),
            "month": F.month(event_time),
            "day": F.dayofmonth(event_time),
        }
    )


def file_name_date(name: Column, extension: str = ".json") -> Column:
    """Date in a file name as struct(year, month, day), NULL when there is none.

    ``YYYY_MM_DD`` wins over ``YYYYMMDD``; the numbers are not checked.
    """
    base = F.element_at(F.split(name, "/"), -1)
    if extension:
        stem = F.when(
            base.endswith(extension),
            F.substring(base, F.lit(1), F.length(base) - len(extension)),
        ).otherwise(base)
    else:
        stem = base

    def parts(pattern: str) -> Column:
        return F.struct(
            *[
                F.regexp_extract(stem, pattern, index).cast("int").alias(part)
                for index, part in enumerate(("year", "month", "day"), start=1)
            ]
        )

    return F.when(stem.rlike(NAME_DASHED), parts(NAME_DASHED)).when(
        stem.rlike(NAME_COMPACT), parts(NAME_COMPACT)
    )
