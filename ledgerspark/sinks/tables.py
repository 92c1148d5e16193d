"""Path tables with whole-table replace, append and upsert.

A table is a folder of versions ``v=<n>``. A version counts once its marker exists, and
the highest one is the table, so a write that dies half-way leaves the old table as it
was. Readers change nothing.

A table written with ``by_month=True`` keeps its files under ``data``, by year, month and
the write that made them; a version's marker lists which writes make up each month. A write
that touches some months adds their files and publishes a marker that names the other months
as they were: readers see the old table or the new one. Several writers may write such a
table at once. Each adds its files, then creates the marker of the next version, which never
overwrites one. A writer that finds the version taken looks at what was published since it
read the table: appends always follow, writes that replace other months follow too, and those
that replace a month which has changed take their files back with :class:`WriteConflict`.
Tables that are not kept by month take one writer at a time, as any plain Parquet folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import fs
from ledgerspark.functions.calendar import UNDATED, month_id, month_predicate
from ledgerspark.operators.merge import (
    repeated_merge_keys,
    require_merge_keys,
    upsert_rows,
)
from ledgerspark.session import COMPRESSION, materialized, shuffle_cleanup
from ledgerspark.sinks import months as month_sink

MARKER = "_published"
DATA = "data"
WRITE = "write_id"
WRITE_MODES = ("replace", "append", "upsert")


class WriteConflict(RuntimeError):
    """Another writer has published a change of the same months since the table was read."""


def _number(path: str) -> int:
    return int(path.rstrip("/").rsplit("v=", 1)[1])


def _versions(spark: SparkSession, root: str) -> list[str]:
    found = fs.glob(spark, f"{root}/v=*/{MARKER}")
    return sorted((path.rsplit("/", 1)[0] for path in found), key=_number)


def table_exists(spark: SparkSession, root: str) -> bool:
    return bool(_versions(spark, root))


def current_path(spark: SparkSession, root: str) -> str:
    versions = _versions(spark, root)
    if not versions:
        raise ValueError(f"Table {root} does not exist.")
    return versions[-1]


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the version that readers see; 0 without a table."""
    versions = _versions(spark, root)
    return _number(versions[-1]) if versions else 0


def roll_back(spark: SparkSession, root: str, version: int) -> None:
    """Take back all versions after the given one (0: the table goes)."""
    for path in fs.glob(spark, f"{root}/v=*"):
        if _number(path) > version:
            fs.delete(spark, path)


def _marker(spark: SparkSession, path: str) -> dict:
    return json.loads(fs.read_text(spark, f"{path}/{MARKER}") or "{}")


def month_writes(spark: SparkSession, root: str) -> dict[int, list[str]] | None:
    """Month -> the writes it consists of; None if the table is not kept by month."""
    months = _marker(spark, current_path(spark, root)).get("months")
    return None if months is None else {int(m): writes for m, writes in months.items()}


def _months_of_write(writes: dict[int, list[str]]) -> dict[str, list[int]]:
    months: dict[str, list[int]] = {}
    for month, names in writes.items():
        for name in names:
            months.setdefault(name, []).append(month)
    return months


def source_of(spark: SparkSession, root: str) -> tuple[str, Column]:
    """Folder of the current version's files, and a filter for those that belong to it."""
    writes = month_writes(spark, root)
    if writes is None:
        return current_path(spark, root), F.lit(True)
    terms = [
        (F.col(WRITE) == name) & month_predicate(months)
        for name, months in sorted(_months_of_write(writes).items())
    ]
    return f"{root}/{DATA}", reduce(or_, terms, F.lit(False))


def current_files_sql(spark: SparkSession, root: str) -> str:
    """The filter of :func:`source_of` as SQL text, for a catalog view."""
    writes = month_writes(spark, root)
    if writes is None:
        return "TRUE"
    month = f"coalesce(year * 100 + month, {UNDATED})"
    terms = [
        f"({WRITE} = '{name}' AND {month} IN ({', '.join(map(str, sorted(months)))}))"
        for name, months in sorted(_months_of_write(writes).items())
    ]
    return " OR ".join(terms) or "FALSE"


def read_table(spark: SparkSession, root: str) -> DataFrame:
    marker = _marker(spark, current_path(spark, root))
    if marker.get("months") == {} and "schema" in marker:
        # No file to take the columns from.
        return spark.createDataFrame([], T.StructType.fromJson(marker["schema"]))
    folder, belongs = source_of(spark, root)
    reader = spark.read
    if "schema" in marker:
        # Files of older writes may lack fields that later ones added.
        schema = T.StructType.fromJson(marker["schema"])
        own = [f for f in schema.fields if f.name not in month_sink.PARTITION_COLUMNS]
        parts = [T.StructField(c, T.IntegerType()) for c in month_sink.PARTITION_COLUMNS]
        reader = reader.schema(T.StructType([*own, *parts, T.StructField(WRITE, T.StringType())]))
    rows = reader.parquet(folder)
    if WRITE not in rows.columns:
        return rows
    # The casts matter only where every month is undated and Spark sees text.
    rows = rows.withColumns({c: F.col(c).cast("int") for c in ("year", "month")})
    return rows.where(belongs).drop(WRITE)


def read_or_empty(spark: SparkSession, root: str, ddl: str) -> DataFrame:
    if table_exists(spark, root):
        return read_table(spark, root)
    return spark.createDataFrame([], ddl)


def _next_path(spark: SparkSession, root: str) -> str:
    taken = [_number(path) for path in fs.glob(spark, f"{root}/v=*")]
    return f"{root}/v={max(taken, default=0) + 1}"


def _add_files(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append ``df`` to a folder; the rows are counted while they are written."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    with shuffle_cleanup(df.sparkSession):
        observed.write.mode("append").partitionBy(*partition_by).parquet(path, compression=COMPRESSION)
    return seen.get["rows"]


def _publish(spark: SparkSession, path: str, **marker) -> bool:
    """Create a version's marker; False if another writer has published that version."""
    return fs.create_text(spark, f"{path}/{MARKER}", json.dumps(marker))


def _commit_months(
    df: DataFrame,
    root: str,
    base: int,
    rows: int,
    name: str,
    added: Iterable[int],
    replaced: Iterable[int] | None = (),
    guarded: Iterable[int] = (),
) -> None:
    """Publish one write: its months, and those whose older content goes (None: all).

    ``base`` is the version that the write's content was made from. Versions published since
    are taken along unless they changed a replaced or ``guarded`` month; a version that is not
    there any more may have changed anything. A write that conflicts takes its files back.
    """
    spark, added = df.sparkSession, sorted(added)
    replaced = None if replaced is None else set(replaced)
    guarded = {*guarded, *(replaced or ())}
    while True:
        current = current_version(spark, root)
        for number in range(base + 1, current + 1):
            changed = _marker(spark, f"{root}/v={number}").get("changed")
            if replaced is None or (guarded and (changed is None or guarded & set(changed))):
                _remove_write(spark, root, name)
                raise WriteConflict(f"Version {number} of {root} changed months that this write is based on.")
        before = month_writes(spark, root) if current else {}
        if before is None and replaced is not None:
            raise ValueError(f"Table {root} is not kept by month.")
        kept = {} if replaced is None else {m: w for m, w in before.items() if m not in replaced}
        months = kept | {m: [*kept.get(m, ()), name] for m in added}
        schema = json.loads(df.schema.json())
        if current != base:
            known = {f["name"] for f in schema["fields"]}
            others = _marker(spark, f"{root}/v={current}").get("schema", {"fields": []})["fields"]
            schema["fields"] += [f for f in others if f["name"] not in known]
        changed = None if replaced is None else sorted(replaced | set(added))
        path = f"{root}/v={current + 1}"
        if _publish(spark, path, rows=rows, months=months, schema=schema, changed=changed):
            return


def _remove_write(spark: SparkSession, root: str, name: str) -> None:
    for folder in fs.glob(spark, f"{root}/{DATA}/year=*/month=*/{WRITE}={name}"):
        fs.delete(spark, folder)


def _write_months(
    df: DataFrame, root: str, rebalance: bool
) -> tuple[int, set[int], str]:
    """Add the files of one write; rows, months and the write's name."""
    name = f"w{uuid.uuid4().hex}"
    seen = Observation()
    rows = (month_sink.by_month(df) if rebalance else df).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(month_id(F.col("year"), F.col("month"))).alias("months"),
    )
    # Only partitions of this write are overwritten, and there are none. Unlike an append, this
    # has a staging folder of its own, so writers do not remove each other's unfinished files.
    writer = rows.withColumn(WRITE, F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with shuffle_cleanup(df.sparkSession):
        writer.partitionBy(*month_sink.PARTITION_COLUMNS, WRITE).parquet(f"{root}/{DATA}", compression=COMPRESSION)
    return seen.get["rows"], set(seen.get["months"] or ()), name


def replace_table(
    df: DataFrame,
    root: str,
    *,
    by_month: bool = False,
    rebalance: bool = True,
    partition_by: Sequence[str] = (),
    keep_if_empty: bool = True,
) -> int:
    """Write a new version and make it current. Returns the number of rows.

    Empty input leaves the old table in place, unless ``keep_if_empty`` is off.
    ``partition_by`` (few values only) lays the files out without a shuffle, and so does
    ``by_month`` with ``rebalance`` off, for input that already is laid out by month.
    """
    spark = df.sparkSession
    if by_month:
        base = current_version(spark, root)
        rows, months, name = _write_months(df, root, rebalance)
        if rows or not keep_if_empty:
            _commit_months(df, root, base, rows, name, months, replaced=None)
        return rows
    path = _next_path(spark, root)
    rows = _add_files(df, path, partition_by)
    if rows == 0 and keep_if_empty:
        fs.delete(spark, path)
        return 0
    if not _publish(spark, path, rows=rows):
        raise WriteConflict(f"{path} was published by another writer.")
    return rows


def replace_months(
    df: DataFrame,
    root: str,
    months: Iterable[int],
    *,
    rebalance: bool = True,
    base: int | None = None,
) -> int:
    """Make ``df`` the content of the named months; others keep their files.

    A month without rows becomes empty. A missing table is created. ``base`` is the version
    that ``df`` was read from (default: the one that is current now); if another writer has
    changed one of the months since, the write is undone with :class:`WriteConflict`.
    """
    spark = df.sparkSession
    if base is None:
        base = current_version(spark, root)
    if table_exists(spark, root) and month_writes(spark, root) is None:
        raise ValueError(f"Table {root} is not kept by month.")
    wanted = set(months)
    rows, found, name = _write_months(df, root, rebalance)
    if found - wanted:
        raise ValueError(f"Rows of months that are not replaced: {sorted(found - wanted)}.")
    _commit_months(df, root, base, rows, name, found, wanted)
    return rows


# A month that consists of more writes than this is compacted by the append that adds one.
MOST_WRITES = 64


def append_table(
    df: DataFrame,
    root: str,
    *,
    by_month: bool = False,
    rebalance: bool = True,
    most_writes: int = MOST_WRITES,
) -> int:
    """Add rows to the current version, or create the table.

    A month table compacts the months that have gathered more than ``most_writes`` writes, so
    that neither its marker nor its reads grow with the number of appends.
    """
    spark = df.sparkSession
    if not table_exists(spark, root):
        return replace_table(df, root, by_month=by_month, rebalance=rebalance)
    writes = month_writes(spark, root)
    if writes is None:
        return _add_files(df, current_path(spark, root))
    base = current_version(spark, root)
    rows, found, name = _write_months(df, root, rebalance)
    if rows:
        _commit_months(df, root, base, rows, name, found)
        compact_table(spark, root, most_writes)
    return rows


def compact_table(spark: SparkSession, root: str, most_writes: int = 1) -> list[int]:
    """Make one write of each month that consists of more than ``most_writes``.

    The new files are published with one marker, in the sizes that REBALANCE gives them;
    other months keep theirs. The marker and the filter of a read then have one name per
    compacted month, however many appends there were. Returns the months; none if another
    writer changed one of them meanwhile, which then stay as they are.
    """
    base = current_version(spark, root)
    writes = month_writes(spark, root)
    if writes is None:
        raise ValueError(f"Table {root} is not kept by month.")
    months = sorted(m for m, names in writes.items() if len(names) > most_writes)
    if months:
        try:
            rows = read_table(spark, root).where(month_predicate(months))
            replace_months(rows, root, months, base=base)
        except WriteConflict:
            return []
    return months


# How often an upsert starts anew because another writer changed its months.
TRIES = 5


def upsert_table(
    df: DataFrame,
    root: str,
    keys: Sequence[str],
    *,
    by_month: bool = False,
    rebalance: bool = True,
    stored_source: bool = False,
) -> int:
    """Replace rows with equal keys and add the rest. Returns the number of source rows.

    A missing table is created. Repeated keys in the source are an error. An upsert of a month
    table whose months another writer changes meanwhile is made anew. The source is
    written once before it is used several times, unless ``stored_source`` says that it
    already comes straight from files. ``rebalance`` off says that it is laid out by month.
    """
    require_merge_keys(df, keys)
    if stored_source:
        return _upsert(df, root, list(keys), by_month, rebalance)
    with materialized(df, "upsert-source") as source:
        return _upsert(source, root, list(keys), by_month, True)


def _upsert(source: DataFrame, root: str, keys: list[str], by_month: bool, rebalance: bool) -> int:
    spark = source.sparkSession
    repeated = repeated_merge_keys(source, keys).limit(1).collect()
    if repeated:
        raise ValueError(f"The source repeats the merge key {repeated[0].asDict()}.")
    if not table_exists(spark, root):
        return replace_table(source, root, by_month=by_month, rebalance=rebalance)
    rows = source.count()
    if rows == 0:
        return 0
    if month_writes(spark, root) is None:
        replace_table(upsert_rows(read_table(spark, root), source, keys), root)
        return rows
    for attempt in range(1, TRIES + 1):
        try:
            _upsert_months(source, root, keys, rebalance)
            break
        except WriteConflict:
            if attempt == TRIES:
                raise
    return rows


def _upsert_months(source: DataFrame, root: str, keys: list[str], rebalance: bool) -> None:
    """Replace the months that hold a key of the source; to others its rows are only added.

    Only months of which some rows stay are read in full: keys alone tell which ones these are.
    """
    spark = source.sparkSession
    base = current_version(spark, root)
    target = read_table(spark, root)
    months = target.select(*keys, month_id(F.col("year"), F.col("month")).alias("_m"))
    found = (
        months.join(source.select(*keys).withColumn("_hit", F.lit(True)), keys, "left")
        .groupBy("_m")
        .agg(F.count("_hit").alias("hits"), F.count(F.lit(1)).alias("n"))
        .where("hits > 0")
        .collect()
    )
    replaced = {row["_m"] for row in found}
    lacks = set(target.columns) - set(source.columns)
    # Columns that the source lacks are taken from the rows that go.
    partly = {row["_m"] for row in found if lacks or row["hits"] < row["n"]}
    if partly or lacks:
        kept = target.where(month_predicate(partly)) if partly else target.limit(0)
        rows = upsert_rows(kept, source, keys)
    else:
        rows = source.select(*target.columns)
    written, added, name = _write_months(rows, root, rebalance or bool(partly))
    # The months of the source as well: another writer may have added its keys there.
    _commit_months(rows, root, base, written, name, added, replaced, guarded=added)
    compact_table(spark, root, MOST_WRITES)


def write_table(
    df: DataFrame,
    root: str,
    mode: str = "replace",
    keys: Sequence[str] = (),
    *,
    by_month: bool = False,
    rebalance: bool = True,
    stored_source: bool = False,
) -> int:
    """Write with one of the three modes; returns the number of rows written."""
    if mode == "replace":
        return replace_table(df, root, by_month=by_month, rebalance=rebalance)
    if mode == "append":
        return append_table(df, root, by_month=by_month, rebalance=rebalance)
    if mode == "upsert":
        return upsert_table(
            df, root, keys, by_month=by_month, rebalance=rebalance, stored_source=stored_source
        )
    raise ValueError(f"Unsupported write mode {mode!r}; use one of {', '.join(WRITE_MODES)}.")


# Files that no version names yet may be those of another writer for so long.
IN_FLIGHT_SECONDS = 24 * 3600


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2, in_flight: float = 0) -> None:
    """Remove all but the newest versions and the files that none of those name.

    Where other writers may be at work, ``in_flight`` seconds keep the files that no version
    has named; those of the removed versions always go.
    """
    versions = _versions(spark, root)
    named = set()
    for path in versions[:-keep]:
        named |= {n for names in _marker(spark, path).get("months", {}).values() for n in names}
        fs.delete(spark, path)
    used = set()
    for path in versions[-keep:]:
        for month, names in _marker(spark, path).get("months", {}).items():
            used |= {f"{month_sink.month_folder(DATA, int(month))}/{WRITE}={n}" for n in names}
    for folder in fs.glob(spark, f"{root}/{DATA}/year=*/month=*/{WRITE}=*"):
        if folder.endswith(tuple(used)):
            continue
        if folder.rsplit("=", 1)[1] in named or fs.age_seconds(spark, folder) >= in_flight:
            fs.delete(spark, folder)
