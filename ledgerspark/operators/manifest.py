"""Incremental ingestion as joins between a manifest and the current listing.

Both sides have one row per landing file:
``path, size_bytes, modified_at, content_digest, file_date, months``, where ``months`` is
an array of ``YYYYMM`` ids and 0 stands for rows without an event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.calendar import UNDATED
from ledgerspark.functions.eventtime import file_name_date, parse_lenient

STATE_COLUMNS = (
    "path",
    "size_bytes",
    "modified_at",
    "content_digest",
    "file_date",
    "months",
)
STATE_DDL = (
    "path string, size_bytes bigint, modified_at timestamp, content_digest string, "
    "file_date int, months array<int>"
)


def payload_times(values: Column) -> Column:
    """Event times of a file's records (array of text), or NULL if any is unreadable.

    Blank and missing values are skipped; one bad value discards the whole payload.
    """
    texts = F.filter(values, lambda v: F.length(F.trim(v)) > 0)
    times = F.transform(texts, parse_lenient)
    return F.when(
        (F.size(times) > 0) & ~F.exists(times, lambda t: t.isNull()),
        times,
    )


def add_file_coverage(
    files: DataFrame, values: str, path: str = "path", extension: str = ".json"
) -> DataFrame:
    """Add ``file_date`` (YYYYMMDD) and ``months``; drops the ``values`` column.

    ``values`` holds the event-time texts of the file's records. The payload decides; the
    date in the file name is the fallback; neither is an error. Records with a NULL event
    time add the undated month.
    """
    times = F.col("_times")
    seen = files.withColumn("_times", payload_times(F.col(values))).withColumns(
        {
            "_first": F.array_min(times),
            "_months": F.array_distinct(F.transform(times, lambda v: F.year(v) * 100 + F.month(v))),
            "_undated": F.coalesce(F.exists(values, lambda v: v.isNull()), F.lit(False)),
        }
    )
    return _dated(seen, path, extension).drop("_times", values)


def add_record_coverage(
    files: DataFrame, records: DataFrame, value: str, extension: str = ".json"
) -> DataFrame:
    """Like :func:`add_file_coverage`, from one row per record (``path`` and ``value``).

    Times are combined on the map side, so a file of any number of records is one row per
    task, and no task holds all of them.
    """
    text = F.when(F.length(F.trim(value)) > 0, F.col(value))
    # Each text is parsed once: an aggregate would evaluate it for each of its functions.
    timed = records.select("path", F.col(value).isNull().alias("_null"), text.alias("_text"), parse_lenient(text).alias("_time"))
    seen = timed.select(
        "path", "_null", "_time",
        (F.year("_time") * 100 + F.month("_time")).alias("_month"),
        (F.col("_text").isNotNull() & F.col("_time").isNull()).alias("_wrong"),
    ).groupBy("path").agg(
        F.min("_time").alias("_first"),
        F.collect_set("_month").alias("_months"),
        F.count_if("_wrong").alias("_bad"),
        F.bool_or("_null").alias("_undated"),
    )
    # One unreadable value discards the whole payload.
    first = F.when(F.coalesce("_bad", F.lit(0)) == 0, F.col("_first"))
    joined = files.join(seen, "path", "left").withColumns(
        {"_first": first, "_undated": F.coalesce("_undated", F.lit(False))}
    )
    return _dated(joined, "path", extension).drop("_bad")


def _dated(files: DataFrame, path: str, extension: str) -> DataFrame:
    """``file_date`` and ``months`` from the first time (null: no readable payload), the months
    of the payload and whether a record has no time."""
    first, named = F.col("_first"), F.col("_named")
    failure = F.raise_error(
        F.concat(F.lit("No parseable date in the name or records of "), F.col(path))
    ).cast("int")
    named_month = named["year"] * 100 + named["month"]
    dated = F.when(first.isNotNull(), F.col("_months")).otherwise(F.array(named_month))
    undated = F.when(F.col("_undated"), F.array(F.lit(UNDATED))).otherwise(
        F.array().cast("array<int>")
    )
    first_day = F.year(first) * 10000 + F.month(first) * 100 + F.dayofmonth(first)
    file_date = (
        F.when(first.isNotNull(), first_day)
        .when(named.isNotNull(), named_month * 100 + named["day"])
        .otherwise(failure)
    )
    return (
        files.withColumn("_named", file_name_date(F.col(path), extension))
        .withColumns(
            {"file_date": file_date, "months": F.array_sort(F.array_union(dated, undated))}
        )
        .drop("_first", "_months", "_undated", "_named")
    )


def new_files(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose path is not in the manifest."""
    return current.join(manifest.select("path"), "path", "left_anti")


def known_digests(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """Digests already ingested. A manifest row without one counts with its current one."""
    now = current.select("path", F.col("content_digest").alias("_now"))
    return (
        manifest.select("path", "content_digest")
        .join(now, "path", "left")
        .select(F.coalesce("content_digest", "_now").alias("content_digest"))
        .where(F.col("content_digest").isNotNull())
        .distinct()
    )


def first_copies(candidates: DataFrame) -> DataFrame:
    """One file per content: the first by date, then path. NULL digests are all kept.

    ``min`` of a struct combines on the map side, so no task ever holds all the copies
    of one content.
    """
    columns = candidates.columns
    order = ["file_date", "path"]
    rest = [c for c in columns if c not in (*order, "content_digest")]
    # Without a digest the path itself is the group, so every such file is its own first.
    group = F.coalesce(F.col("content_digest"), F.concat(F.lit("path:"), F.col("path")))
    return (
        candidates.groupBy(group.alias("_content"))
        .agg(F.min(F.struct(*order, *rest, "content_digest")).alias("_first"))
        .select(*[F.col(f"_first.{c}").alias(c) for c in columns])
    )


def unseen_files(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """New files with new content, one per content.

    Copies are reduced to one before the join, so a content with many copies is one row.
    """
    fresh = first_copies(new_files(current, manifest))
    seen = known_digests(current, manifest)
    return fresh.join(seen, "content_digest", "left_anti").select(*current.columns)


def without_content_of(files: DataFrame, others: DataFrame) -> DataFrame:
    """Files whose content none of ``others`` holds now. A NULL digest equals nothing."""
    taken = others.select("content_digest").distinct()
    return files.join(taken, "content_digest", "left_anti").select(*files.columns)


def without_copies_of(files: DataFrame, holders: DataFrame) -> DataFrame:
    """Files that hold their content themselves, or whose content no holder has."""
    own = files.join(holders.select("path"), "path", "left_semi")
    others = files.join(holders.select("path"), "path", "left_anti")
    return own.unionByName(without_content_of(others, holders))


def ignored_duplicates(
    current: DataFrame, manifest: DataFrame, unseen: DataFrame
) -> DataFrame:
    """New paths that only repeat content already taken."""
    return new_files(current, manifest).join(unseen.select("path"), "path", "left_anti")


def changed_files(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """Known paths with other content, with the months they held before.

    Digests decide when both are known, size and modification time otherwise.
    """
    old = manifest.select(
        "path",
        F.col("size_bytes").alias("_size"),
        F.col("modified_at").alias("_modified"),
        F.col("content_digest").alias("_digest"),
        F.col("months").alias("old_months"),
    )
    both_known = F.col("content_digest").isNotNull() & F.col("_digest").isNotNull()
    differs = F.when(both_known, F.col("content_digest") != F.col("_digest")).otherwise(
        ~F.col("size_bytes").eqNullSafe(F.col("_size"))
        | ~F.col("modified_at").eqNullSafe(F.col("_modified"))
    )
    return current.join(old, "path").where(differs).select(*current.columns, "old_months")


def changed_or_new(changed: DataFrame, unseen: DataFrame) -> DataFrame:
    """Both kinds; a path is either known or new, so no row repeats."""
    return changed.select(*unseen.columns).unionByName(unseen)


def impacted_months(changed: DataFrame) -> DataFrame:
    """Months of changed files, both those they hold now and those they held before."""
    months = F.array_union("months", F.coalesce("old_months", F.array().cast("array<int>")))
    return changed.select(F.explode(months).alias("month_id")).distinct()


def files_touching(current: DataFrame, months: DataFrame) -> DataFrame:
    """Files with rows in any of the given months.

    The distinct months are broadcast: there are at most 12 for each of 9999 years. That
    keeps a month most files belong to out of a shuffle.
    """
    distinct = F.broadcast(months.select("month_id").distinct())
    touching = (
        current.select("path", F.explode("months").alias("month_id"))
        .join(distinct, "month_id", "left_semi")
        .select("path")
    )
    return current.join(touching, "path", "left_semi")


def files_to_read(current: DataFrame, impacted: DataFrame, unseen: DataFrame) -> DataFrame:
    """New files, and all files that touch an impacted month."""
    touching = files_touching(current, impacted).select("path")
    wanted = touching.unionByName(unseen.select("path")).distinct()
    return current.join(wanted, "path", "left_semi")


def merge_manifest(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """Current states replace old ones; files that disappeared are kept."""
    kept = manifest.join(current.select("path"), "path", "left_anti")
    return kept.unionByName(current.select(*manifest.columns))
