"""Parquet datasets partitioned by (year, month): append and partition rebuild."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import fs
from ledgerspark.functions.calendar import UNDATED, month_id, month_predicate
from ledgerspark.session import COMPRESSION, shuffle_cleanup

PARTITION_COLUMNS = ("year", "month")
# Fixed value: the folder name Spark gives a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Written:
    """What a write did, observed while it ran: no second scan."""

    rows: int
    months: frozenset[int]


def by_month(df: DataFrame) -> DataFrame:
    """Gather rows of a month for writing, without forcing a month into one task.

    REBALANCE lets AQE split large months into files of the advisory size and pack small
    ones together.
    """
    return df.hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])


def _write(df: DataFrame, root: str, mode: str, rebalance: bool) -> Written:
    seen = Observation()
    observed = (by_month(df) if rebalance else df).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(month_id(F.col("year"), F.col("month"))).alias("months"),
    )
    writer = observed.write.mode(mode).partitionBy(*PARTITION_COLUMNS)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with shuffle_cleanup(df.sparkSession):
        writer.parquet(root, compression=COMPRESSION)
    return Written(seen.get["rows"], frozenset(seen.get["months"] or ()))


def append_months(df: DataFrame, root: str, *, rebalance: bool = True) -> Written:
    """Add files to the months of ``df``. Empty input adds nothing.

    ``rebalance=False`` saves the shuffle when the input is already laid out by month.
    """
    return _write(df, root, "append", rebalance)


def month_folder(root: str, value: int) -> str:
    if value == UNDATED:
        return f"{root}/year={NULL_FOLDER}/month={NULL_FOLDER}"
    return f"{root}/year={value // 100}/month={value % 100}"


def drop_months(spark: SparkSession, root: str, months: Iterable[int]) -> None:
    for value in months:
        folder = month_folder(root, value)
        if fs.exists(spark, folder):
            fs.delete(spark, folder)


def move_months(spark: SparkSession, source: str, root: str, months: Iterable[int]) -> None:
    """Move the files of some months to another dataset, by renaming: no row is written again.

    Every write names its files anew, so they stand beside those that are there.
    """
    for value in months:
        files = fs.glob(spark, f"{month_folder(source, value)}/part-*")
        folder = month_folder(root, value)
        if files:
            fs.make_folder(spark, folder)
        for path in files:
            fs.rename(spark, path, f"{folder}/{path.rsplit('/', 1)[1]}")


def rebuild_months(
    df: DataFrame, root: str, months: Iterable[int] = (), *, rebalance: bool = True
) -> Written:
    """Replace the months present in ``df``; others stay.

    ``months`` names all months being rebuilt: one of them without rows is removed, which
    a dynamic overwrite alone would leave as it was.
    """
    written = _write(df, root, "overwrite", rebalance)
    drop_months(df.sparkSession, root, set(months) - written.months)
    return written


def has_data(spark: SparkSession, root: str) -> bool:
    return bool(fs.glob(spark, f"{root}/year=*/month=*"))


def read_months(
    spark: SparkSession,
    root: str,
    months: Iterable[int] | None = None,
    fields: Iterable[T.StructField] | None = None,
) -> DataFrame:
    """The dataset, or only some of its months (pruned at planning time).

    With ``fields``, the columns besides year and month; files that lack one give null.
    """
    reader = spark.read
    if fields is not None:
        parts = [T.StructField(c, T.IntegerType()) for c in PARTITION_COLUMNS]
        reader = reader.schema(T.StructType([*fields, *parts]))
    # The cast matters only where every month is undated and Spark sees text.
    df = reader.parquet(root)
    df = df.withColumns({c: F.col(c).cast("int") for c in PARTITION_COLUMNS})
    if months is None:
        return df
    predicate = month_predicate(months)
    return df.where(F.lit(False) if predicate is None else predicate)
