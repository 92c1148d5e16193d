"""One query per operator, over the driver tables.

Dates and timestamps are returned as text and totals as DOUBLE, so that results compare
equal across engines.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import fs
from ledgerspark.functions import eventtime
from ledgerspark.functions.calendar import add_calendar_features
from ledgerspark.functions.money import to_eur
from ledgerspark.operators import checks, coverage, manifest, marts, merge, quality
from ledgerspark.plans.ingest import (
    IngestConfig,
    read_drift,
    read_manifest,
    read_pending,
    run_bronze,
    run_ingest,
)
from ledgerspark.plans.warehouse import (
    LAYERS,
    WarehouseConfig,
    build_warehouse,
    check_warehouse,
    publish_views,
)
from ledgerspark.session import materialize, materialized, scratch_folder, scratch_path
from ledgerspark.sinks import months as month_sink
from ledgerspark.sinks import tables
from ledgerspark.sinks.report import export_report, read_report
from ledgerspark.sinks.runlog import append_run, read_run_log
from ledgerspark.sources import landing
from ledgerspark.sources.bronze import bronze_months
from ledgerspark.sources.ranges import open_file, open_new_file, scan_ranges
from ledgerspark.sources.relations import read_relation
from ledgerspark.schema import RAW_SCHEMA
from ledgerspark.testbed import tables as t

AS_OF = date(2001, 6, 15)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def comparable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as DOUBLE, arrays as comma lists."""

    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), ",")
        return col.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def staged(spark, sf_dir) -> DataFrame:
    return quality.stage(t.trusted(spark, sf_dir))


def classified(spark, sf_dir) -> DataFrame:
    return quality.classify(staged(spark, sf_dir))


def accepted(spark, sf_dir) -> DataFrame:
    return quality.accepted(classified(spark, sf_dir))


def rejected(spark, sf_dir) -> DataFrame:
    return quality.rejected(classified(spark, sf_dir))


def with_month(df: DataFrame, column: str = "created_at_timestamp") -> DataFrame:
    value = F.col(column)
    return df.withColumns({"year": F.year(value), "month": F.month(value)})


def month_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("amount").cast("decimal(38,10)"), 2).cast("double").alias("amount"),
    )


# --- marts -----------------------------------------------------------------------------


@query
def monthly_partner_premiums(spark, sf_dir):
    return comparable(marts.monthly_partner_premiums(accepted(spark, sf_dir)))


@query
def monthly_partner_premiums_by_currency(spark, sf_dir):
    return comparable(marts.monthly_partner_premiums_by_currency(accepted(spark, sf_dir)))


@query
def eur_mart_from_currency_totals(spark, sf_dir):
    totals = marts.currency_totals(accepted(spark, sf_dir))
    return comparable(marts.eur_from_totals(totals))


@query
def dim_partner(spark, sf_dir):
    return marts.dim_partner(accepted(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return comparable(marts.dim_date(accepted(spark, sf_dir)))


@query
def fct_transaction(spark, sf_dir):
    # Both read them: stored, they are classified once.
    rows = materialize(accepted(spark, sf_dir), "accepted")
    return comparable(marts.fct_transaction(rows, marts.dim_partner(rows)))


# --- staging and quality ---------------------------------------------------------------


@query
def staging_surrogate_key(spark, sf_dir):
    return comparable(staged(spark, sf_dir))


@query
def transaction_quality(spark, sf_dir):
    return comparable(classified(spark, sf_dir))


@query
def accepted_transactions(spark, sf_dir):
    return comparable(accepted(spark, sf_dir))


@query
def rejected_transactions(spark, sf_dir):
    return comparable(rejected(spark, sf_dir))


@query
def unclassified_transactions(spark, sf_dir):
    return comparable(quality.unclassified(classified(spark, sf_dir)))


@query
def null_amount_rejected(spark, sf_dir):
    strict = quality.classify(staged(spark, sf_dir), null_amount="reject")
    return strict.groupBy("is_rejected", "rejection_reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# --- scalar functions ------------------------------------------------------------------


@query
def parse_event_time(spark, sf_dir):
    rows = t.transactions(spark, sf_dir).select("created_at", "amount")
    return comparable(eventtime.add_event_time(rows, "created_at", "parsed"))


@query
def time_features(spark, sf_dir):
    rows = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return comparable(add_calendar_features(rows, "o_orderdate"))


@query
def event_time_features(spark, sf_dir):
    rows = t.table(spark, sf_dir, "events").select("event_id", "ts")
    return comparable(add_calendar_features(rows, "ts")).drop("ts")


@query
def fx_normalize(spark, sf_dir):
    return t.transactions(spark, sf_dir).select(
        "transaction_id",
        "currency",
        "amount",
        to_eur(F.col("amount"), F.col("currency")).alias("amount_eur"),
    )


@query
def filename_date(spark, sf_dir):
    day = F.col("o_orderdate")
    name = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit("in/premium_transaction_"), F.date_format(day, "yyyy_MM_dd")),
        )
        .when(
            F.col("o_orderstatus") == "O",
            F.concat(
                F.lit("in/premium_transactions_data_"),
                F.date_format(day, "yyyyMMdd"),
                F.lit("_copy"),
            ),
        )
        .otherwise(
            F.concat(F.lit("in/premium_transaction_"), F.col("o_orderkey") + 1000000000)
        )
    )
    named = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(name, F.lit(".json")).alias("path")
    )
    found = eventtime.file_name_date(F.col("path"))
    return named.select(
        "o_orderkey",
        found["year"].alias("year"),
        found["month"].alias("month"),
        found["day"].alias("day"),
    )


# --- coverage and planning -------------------------------------------------------------


@query
def day_coverage(spark, sf_dir):
    rows = with_month(t.trusted(spark, sf_dir))
    return comparable(coverage.day_coverage(rows))


@query
def missing_days(spark, sf_dir):
    rows = with_month(t.trusted(spark, sf_dir))
    # Every row takes part; rows of even days count as undated, which makes the gaps.
    odd = F.col("day") % 2 == 1
    rows = rows.withColumns({c: F.when(odd, F.col(c)) for c in ("year", "month", "day")})
    return comparable(coverage.missing_days(coverage.day_coverage(rows), AS_OF))


@query
def month_range(spark, sf_dir):
    spans = (
        t.transactions(spark, sf_dir)
        .groupBy("charged_partner")
        .agg(
            F.min("created_at_timestamp").cast("date").alias("first"),
            F.max("created_at_timestamp").cast("date").alias("last"),
        )
    )
    months = coverage.months_between(F.col("first"), F.col("last"))
    return comparable(spans.select("charged_partner", F.explode(months).alias("month")))


@query
def available_months(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    rows = with_month(t.transactions(spark, sf_dir))
    month_sink.append_months(rows, root)
    return comparable(bronze_months(spark, root))


def _order_runs(spark, sf_dir) -> DataFrame:
    """orders as a run log: one run per priority, covering the months of its orders."""
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    status = F.when(F.min("o_orderpriority").startswith("5"), "skipped").otherwise("completed")
    return (
        t.table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.timestamp_seconds(F.max("o_orderkey")).alias("run_at"),
            status.alias("silver_status"),
            F.min("o_orderpriority").alias("table_name"),
            F.count(F.lit(1)).alias("rows_written"),
            F.lit("replace").alias("write_mode"),
            F.collect_set(month).alias("months"),
        )
        .drop("o_orderpriority")
        .withColumn("was_skipped", F.col("silver_status") == "skipped")
        .withColumn(
            "skip_reason", F.when(F.col("was_skipped"), "no_pending_bronze_partitions")
        )
    )


@query
def backfill_plan(spark, sf_dir):
    span = t.table(spark, sf_dir, "orders").agg(
        F.add_months(F.min("o_orderdate").cast("date"), -3).alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    )
    months = coverage.months_between(F.col("first"), F.col("last"))
    requested = span.select(F.explode(months).alias("month"))
    available = coverage.available_months(with_month(t.transactions(spark, sf_dir)))
    loaded = coverage.loaded_months(_order_runs(spark, sf_dir))
    return coverage.backfill_plan(requested, available, loaded)


@query
def run_summary(spark, sf_dir):
    root = scratch_path(spark, "run-log")
    append_run(_order_runs(spark, sf_dir), root)
    summary = coverage.run_summary(read_run_log(spark, root))
    return summary.withColumn("run_at", F.unix_timestamp("run_at"))


# --- manifest --------------------------------------------------------------------------


@query
def payload_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    last = (
        F.when(F.col("o_orderstatus") == "P", "not a date")
        .when(F.col("o_orderstatus") == "O", F.date_format(F.date_add(day, 40), "yyyy-MM-dd"))
        .otherwise(F.lit(None))
    )
    files = t.table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("premium_transaction_"), F.col("o_orderkey"), F.lit("_2024_02_29.json")
        ).alias("path"),
        F.array(
            F.date_format(day, "MM/dd/yyyy HH:mm"),
            F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"),
            last,
        ).alias("values"),
    )
    return comparable(manifest.add_file_coverage(files, "values"))


@query
def content_dedupe(spark, sf_dir):
    return manifest.first_copies(t.landing_files(spark, sf_dir)).select(
        "path", "content_digest", "file_date"
    )


@query
def changed_files(spark, sf_dir):
    current, known = t.landing_files(spark, sf_dir), t.manifest(spark, sf_dir)
    changed = manifest.changed_files(current, known)
    unseen = manifest.unseen_files(current, known)
    new_paths = unseen.select("path", F.lit(True).alias("is_new"))
    return (
        manifest.changed_or_new(changed, unseen)
        .join(new_paths, "path", "left")
        .select("path", F.coalesce("is_new", F.lit(False)).alias("is_new"))
    )


@query
def ignored_duplicates(spark, sf_dir):
    current, known = t.landing_files(spark, sf_dir), t.manifest(spark, sf_dir)
    unseen = manifest.unseen_files(current, known)
    return manifest.ignored_duplicates(current, known, unseen).select("path", "content_digest")


@query
def impacted_months(spark, sf_dir):
    current, known = t.landing_files(spark, sf_dir), t.manifest(spark, sf_dir)
    return manifest.impacted_months(manifest.changed_files(current, known))


@query
def impacted_files(spark, sf_dir):
    current, known = t.landing_files(spark, sf_dir), t.manifest(spark, sf_dir)
    impacted = manifest.impacted_months(manifest.changed_files(current, known))
    unseen = manifest.unseen_files(current, known)
    return manifest.files_to_read(current, impacted, unseen).select("path", "file_date")


@query
def manifest_merge(spark, sf_dir):
    current, known = t.landing_files(spark, sf_dir), t.manifest(spark, sf_dir)
    newer = manifest.unseen_files(current, known)
    merged = manifest.merge_manifest(known, newer)
    return comparable(merged.drop("modified_at"))


# --- checks ----------------------------------------------------------------------------


@query
def check_not_null(spark, sf_dir):
    return comparable(checks.not_null(staged(spark, sf_dir), "charged_partner"))


@query
def check_unique(spark, sf_dir):
    return checks.unique(staged(spark, sf_dir), "transaction_id")


@query
def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(staged(spark, sf_dir), "currency", checks.CURRENCIES)


@query
def check_relationships(spark, sf_dir):
    """Ids of all rows against the ids of the accepted ones: rejected ids are orphans."""
    parents = accepted(spark, sf_dir).select("transaction_id")
    rows = staged(spark, sf_dir)
    return checks.relationships(rows, "transaction_id", parents, "transaction_id")


@query
def check_unique_combination(spark, sf_dir):
    return checks.unique_combination(
        staged(spark, sf_dir), ["transaction_id", "charged_partner"]
    )


@query
def check_row_counts(spark, sf_dir):
    rows = classified(spark, sf_dir)
    return checks.row_counts_match(
        staged(spark, sf_dir), quality.accepted(rows), quality.rejected(rows)
    )


@query
def check_no_overlap(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return checks.no_overlap(
        rows.where(F.col("status") == "processed"),
        rows.where(F.col("status") != "processed"),
        "transaction_id",
    )


# --- sinks -----------------------------------------------------------------------------


@query
def bronze_append(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    rows = with_month(t.transactions(spark, sf_dir))
    month_sink.append_months(rows.where(F.col("status") == "processed"), root)
    month_sink.append_months(rows.where(F.col("status") != "processed"), root)
    return month_totals(month_sink.read_months(spark, root))


@query
def bronze_rebuild(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    rows = with_month(t.transactions(spark, sf_dir))
    month_sink.append_months(rows, root)
    corrected = rows.where((F.col("year") == 1997) & (F.col("currency") == "EUR"))
    corrected = corrected.where(F.col("month") != 5)
    month_sink.rebuild_months(corrected, root, [199700 + m for m in range(1, 13)])
    return month_totals(month_sink.read_months(spark, root))


def _event_rows(spark, sf_dir) -> DataFrame:
    return t.table(spark, sf_dir, "events")


def _event_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Stored events (all but errors) and an update: clicks doubled, errors added."""
    rows = _event_rows(spark, sf_dir)
    stored = rows.where(F.col("event_type") != "error")
    update = rows.where(F.col("event_type").isin("click", "error")).withColumn(
        "value", F.col("value") * 2
    )
    return stored, update


@query
def table_replace(spark, sf_dir):
    root = scratch_path(spark, "events")
    stored, update = _event_sides(spark, sf_dir)
    tables.write_table(stored, root, "replace")
    tables.write_table(update, root, "replace")
    tables.write_table(update.where(F.col("event_type") == "none"), root, "replace")
    return comparable(tables.read_table(spark, root))


@query
def table_append(spark, sf_dir):
    root = scratch_path(spark, "events")
    stored, update = _event_sides(spark, sf_dir)
    tables.write_table(stored, root, "append")
    tables.write_table(update, root, "append")
    return comparable(tables.read_table(spark, root))


@query
def table_upsert(spark, sf_dir):
    root = scratch_path(spark, "events")
    stored, update = _event_sides(spark, sf_dir)
    tables.write_table(stored, root, "upsert", ["event_id"])
    tables.write_table(update, root, "upsert", ["event_id"])
    return comparable(tables.read_table(spark, root))


@query
def table_upsert_by_month(spark, sf_dir):
    """Upsert into a month-partitioned table; some rows move to another month."""
    root = scratch_path(spark, "orders")
    rows = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    stored = rows.where(F.col("o_orderstatus") != "P")
    moved = F.when(
        F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 1 MONTH")
    ).otherwise(F.col("o_orderdate"))
    update = (
        rows.where((F.col("o_orderstatus") != "O") & (F.year("o_orderdate") == 1997))
        .withColumn("o_orderdate", moved)
        .withColumn("o_totalprice", -F.col("o_totalprice"))
    )
    for part in (stored, update):
        tables.write_table(
            with_month(part, "o_orderdate"), root, "upsert", ["o_orderkey"], by_month=True
        )
    return comparable(tables.read_table(spark, root))


@query
def incremental_merge(spark, sf_dir):
    stored, update = _event_sides(spark, sf_dir)
    return comparable(merge.upsert_rows(stored, update, ["event_id"]))


@query
def report_export(spark, sf_dir):
    target = scratch_path(spark, "gold")
    path = export_report(marts.monthly_partner_premiums(accepted(spark, sf_dir)), target)
    return read_report(spark, path)


# --- files -----------------------------------------------------------------------------


def _json_texts(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _write_lines(df: DataFrame, folder: str) -> list[str]:
    """Write rows as JSON lines that begin with a comma, compressed; the names of the files.

    A task that is tried again writes the same name.
    """
    prefix = f"{fs.qualified(df.sparkSession, folder)}/part"

    def write(batches):
        name = f"{prefix}-{TaskContext.get().partitionId():05d}.lines"
        with open_new_file(name) as target, pa.CompressedOutputStream(target, "zstd") as lines:
            for batch in batches:
                if len(batch):
                    lines.write(f",{_joined(batch.column(0), '\n,')}\n".encode())
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    return sorted(row["name"] for row in _json_texts(df).mapInArrow(write, "name string").collect())


def _joined(texts: pa.Array, separator: str) -> str:
    row = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    return pc.binary_join(row, pa.scalar(separator, texts.type))[0].as_py()


def _join_lines(paths: list[str], name: str) -> None:
    """Write the lines of some files as one JSON array, piece by piece; none give an empty file."""
    opening = b"["
    with open_new_file(name) as target:
        for path in paths:
            with open_file(path) as part, pa.CompressedInputStream(part, "zstd") as lines:
                while chunk := lines.read(8 << 20):
                    # The first line has the bracket where others have a comma.
                    target.write(opening + chunk[1:] if opening else chunk)
                    opening = b""
        if not opening:
            target.write(b"]\n")


def _copy_file(path: str, name: str) -> None:
    with open_file(path) as source, open_new_file(name) as target:
        while chunk := source.read(8 << 20):
            target.write(chunk)


def write_landing(df: DataFrame, directory: str, rows_per_file: int = 0) -> None:
    """Write rows as JSON array files: one per partition, or more of at most ``rows_per_file``.

    Each task writes its files itself, so every byte is written once. A task that is tried again
    writes the same names. No rows give one empty file.
    """
    prefix = f"{fs.qualified(df.sparkSession, directory)}/part-{uuid.uuid4().hex}"

    def write(batches):
        task, made, target, room = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            texts = batch.column(0)
            while len(texts):
                opening = "\n,"
                if target is None:
                    target, room = open_new_file(f"{prefix}-{task:05d}-{made:05d}-c000.txt"), rows_per_file
                    made, opening = made + 1, "["
                piece = texts[:room] if rows_per_file else texts
                target.write((opening + _joined(piece, "\n,")).encode())
                texts, room = texts[len(piece):], room - len(piece)
                if rows_per_file and not room:
                    target.write(b"\n]\n")
                    target.close()
                    target = None
        if target is not None:
            target.write(b"\n]\n")
            target.close()
        yield pa.RecordBatch.from_arrays([pa.array([made])], ["files"])

    made = _json_texts(df).mapInArrow(write, "files bigint").agg(F.sum("files")).first()[0]
    if not made:
        open_new_file(f"{prefix}-c000.txt").close()


def write_landing_file(df: DataFrame, directory: str, copies: int = 1) -> None:
    """Write rows as one JSON array file, or several equal ones.

    All tasks write its lines, compressed; one task joins their bytes, piece by piece. Copies
    are made of that file once the lines are gone.
    """
    spark = df.sparkSession
    names = [f"{fs.qualified(spark, directory)}/part-{uuid.uuid4().hex}.txt" for _ in range(copies)]

    def in_tasks(work: Callable[[int], None], count: int) -> None:
        def run(batches):
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    work(k)
                yield batch

        spark.range(0, count, 1, count).mapInArrow(run, "id bigint").collect()

    with scratch_folder(spark, "landing-lines") as folder:
        lines = _write_lines(df, folder)
        in_tasks(lambda _: _join_lines(lines, names[0]), 1)
    if copies > 1:
        in_tasks(lambda k: _copy_file(names[0], names[k + 1]), copies - 1)


# Landing files of about 8 MB, one range each.
ROWS_PER_FILE = 50_000


def _feed(spark, sf_dir, **options) -> tuple[IngestConfig, str, DataFrame]:
    """An empty feed and the records that belong into its landing folder."""
    root = scratch_path(spark, "feed")
    rows = t.transactions(spark, sf_dir).drop("created_at_timestamp")
    config = IngestConfig(
        landing_dir=f"{root}/landing",
        bronze_dir=f"{root}/bronze",
        trusted_dir=f"{root}/trusted",
        tokens=("part", "c000"),
        extension=".txt",
        schema=RAW_SCHEMA,
        **options,
    )
    return config, root, rows


def deliver(rows: DataFrame, config: IngestConfig) -> None:
    """Add files of moderate size to the landing folder: their number follows the data."""
    write_landing(rows, config.landing_dir, ROWS_PER_FILE)


def _landing_config(spark, sf_dir, **options) -> tuple[IngestConfig, str]:
    config, root, rows = _feed(spark, sf_dir, **options)
    deliver(rows, config)
    return config, root


@query
def incremental_ingest(spark, sf_dir):
    """Two deliveries, appended month by month: cancelled rows arrive later."""
    config, root, rows = _feed(spark, sf_dir, write_mode="upsert", merge_keys=("row_key",))
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("row_key", T.LongType())])
    config = dataclasses.replace(config, schema=schema)
    # A real key per record, as upsert needs one: the transaction ids repeat.
    keyed = rows.withColumn("row_key", F.monotonically_increasing_id())
    with materialized(keyed, "keyed") as keyed:
        deliver(keyed.where(F.col("status") == "processed"), config)
        run_ingest(spark, config, f"{root}/runs")
        deliver(keyed.where(F.col("status") != "processed"), config)
    run_ingest(spark, config, f"{root}/runs")
    trusted = tables.read_table(spark, config.trusted_dir)
    return month_totals(trusted.select("year", "month", "amount"))


@query
def pending_after_ingest(spark, sf_dir):
    config, _ = _landing_config(spark, sf_dir)
    run_bronze(spark, config)
    return comparable(read_pending(spark, config))


@query
def manifest_after_ingest(spark, sf_dir):
    """Months of the manifest, and whether it describes every landing file as it is now."""
    config, _ = _landing_config(spark, sf_dir)
    run_bronze(spark, config)
    known = read_manifest(spark, config)
    now = materialize(
        spark.read.format("binaryFile")
        .load(f"{config.landing_dir}/part-*")
        .select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("content_digest")),
        "files-now",
    )
    wrong = known.join(now, now.columns, "left_anti").count() + now.join(known, now.columns, "left_anti").count()
    months = known.select(F.explode("months").alias("month_id")).distinct()
    return months.withColumn("files_not_described", F.lit(wrong).cast("bigint"))


@query
def json_ingest(spark, sf_dir):
    config, root = _landing_config(spark, sf_dir)
    files = landing.list_files(spark, config.landing_dir, config.tokens, config.extension)
    records = landing.read_records(scan_ranges(files), RAW_SCHEMA)
    parsed = eventtime.add_event_time(
        records.drop("source_file"), "created_at", "created_at_timestamp"
    )
    month_sink.append_months(parsed, config.bronze_dir)
    return month_totals(month_sink.read_months(spark, config.bronze_dir))


@query
def end_to_end_from_files(spark, sf_dir):
    """Landing files to the monthly mart: ingest twice (the rerun adds nothing), build."""
    config, root = _landing_config(spark, sf_dir)
    run_ingest(spark, config, f"{root}/runs")
    run_ingest(spark, config, f"{root}/runs")
    relations = build_warehouse(
        spark, tables.read_table(spark, config.trusted_dir), WarehouseConfig(f"{root}/marts")
    )
    return comparable(relations["monthly_partner_premiums"])


@query
def warehouse_checks(spark, sf_dir):
    """Every promised property, counted over a warehouse built from the transactions."""
    root = scratch_path(spark, "warehouse")
    relations = build_warehouse(spark, t.trusted(spark, sf_dir), WarehouseConfig(root))
    return check_warehouse(relations)


RAW_FIELDS = RAW_SCHEMA.fieldNames()


def bronze_content(spark, config: IngestConfig) -> DataFrame:
    return comparable(month_sink.read_months(spark, config.bronze_dir).select(*RAW_FIELDS, "year", "month", "day"))


def replace_files(spark, paths: list[str], rows: DataFrame, root: str) -> None:
    """Put new content under old names: one file per path, as many as there are paths."""
    draft = f"{root}/corrections"
    write_landing(rows.repartition(len(paths), "transaction_id", "amount", "created_at"), draft)
    parts = fs.glob(spark, f"{draft}/part-*")
    for k, path in enumerate(paths):
        fs.delete(spark, path)
        if k < len(parts):
            fs.rename(spark, parts[k], path)


def landed(spark, config: IngestConfig) -> list[str]:
    return fs.glob(spark, f"{config.landing_dir}/part-*")


def split_feed(spark, sf_dir, **options):
    """A feed, its processed rows and the rest, both stored so that they read the same twice."""
    config, root, rows = _feed(spark, sf_dir, **options)
    rows = materialize(rows, "rows")
    processed = F.col("status") == "processed"
    return config, root, rows.where(processed), rows.where(~processed)


@query
def ingest_correction_with_copies(spark, sf_dir):
    """One run corrects every old file and brings new files, each of them twice."""
    config, root, first, second = split_feed(spark, sf_dir)
    deliver(first, config)
    run_bronze(spark, config)
    corrected = first.withColumn("amount", F.col("amount") * 2)
    replace_files(spark, landed(spark, config), corrected, root)
    for _ in range(2):
        deliver(second, config)
    run_bronze(spark, config)
    return bronze_content(spark, config)


@query
def ingest_after_archiving(spark, sf_dir):
    """Files leave the landing folder before the others are corrected: their rows stay."""
    config, root, first, second = split_feed(spark, sf_dir)
    deliver(first, config)
    run_bronze(spark, config)
    archived = landed(spark, config)
    deliver(second, config)
    run_bronze(spark, config)
    for path in archived:
        fs.delete(spark, path)
    corrected = second.withColumn("amount", F.col("amount") * 2)
    replace_files(spark, landed(spark, config), corrected, root)
    run_bronze(spark, config)
    return bronze_content(spark, config)


@query
def append_second_file_same_month(spark, sf_dir):
    """Append mode with two deliveries for the same months: every row once."""
    config, root, first, second = split_feed(spark, sf_dir, write_mode="append")
    for part in (first, second):
        deliver(part, config)
        run_ingest(spark, config, f"{root}/runs")
    trusted = tables.read_table(spark, config.trusted_dir)
    return comparable(trusted.select(*RAW_FIELDS, "year", "month", "day"))


@query
def schema_drift_report(spark, sf_dir):
    """The second delivery lacks the status and says through which channel it came."""
    config, _, first, second = split_feed(spark, sf_dir, report_drift=True)
    deliver(first, config)
    run_bronze(spark, config)
    deliver(second.drop("status").withColumn("channel", F.lit("branch")), config)
    run_bronze(spark, config)
    rows = month_sink.read_months(spark, config.bronze_dir)
    drift = read_drift(spark, config)
    without = rows.where(F.col("status").isNull()).count()
    return drift.withColumn("rows_without_status", F.lit(without).cast("bigint"))


@query
def ingest_run_log(spark, sf_dir):
    """Two loads and a skip, with months and rows as the log has them."""
    config, root, first, second = split_feed(spark, sf_dir)
    for part in (first, second, None):
        if part is not None:
            deliver(part, config)
        run_ingest(spark, config, f"{root}/runs")
    return read_run_log(spark, f"{root}/runs").select(
        "silver_status", "table_name", "rows_written", "write_mode", "was_skipped", "skip_reason",
        F.array_join(F.array_sort("months").cast("array<string>"), ",").alias("months"),
        F.expr(f"{read_pending(spark, config).count()}L").alias("still_pending"),
    )


@query
def ingest_acknowledged_copies(spark, sf_dir):
    """Copies that arrive later are ignored once, then known: files and contents by run."""
    config, root, first, _ = split_feed(spark, sf_dir)
    deliver(first, config)
    run_bronze(spark, config)
    before = len(landed(spark, config))
    deliver(first, config)
    plans = [run_bronze(spark, config) for _ in range(2)]
    known = read_manifest(spark, config)
    counts = [plan.ignored.count() - expected for plan, expected in zip(plans, (before, 0))]
    rows = month_sink.read_months(spark, config.bronze_dir)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(counts[0]).alias("not_ignored_first"),
        F.lit(counts[1]).alias("ignored_again"),
        F.lit(known.count() - 2 * known.select("content_digest").distinct().count()).alias(
            "files_without_a_copy"
        ),
    )


def _two_builds(spark, sf_dir, incremental: str) -> DataFrame:
    """Accepted rows after a build of the processed rows and one of all rows with late copies."""
    rows = t.trusted(spark, sf_dir)
    processed = rows.where(F.col("status") == "processed")
    late = processed.where(F.col("day") == 1)
    config = WarehouseConfig(scratch_path(spark, "warehouse"), incremental=incremental)
    build_warehouse(spark, processed, config)
    relations = build_warehouse(spark, rows.unionByName(late), config)
    return comparable(
        relations["premium_transactions"].select(
            "transaction_partner_sk", "transaction_id", "amount", "currency", "charged_partner",
            "status", "created_at",
        )
    )


@query
def warehouse_sync_two_builds(spark, sf_dir):
    return _two_builds(spark, sf_dir, "sync")


@query
def warehouse_merge_two_builds(spark, sf_dir):
    return _two_builds(spark, sf_dir, "merge")


@query
def published_views(spark, sf_dir):
    """Rows of every published view of a warehouse, read by name."""
    config = WarehouseConfig(scratch_path(spark, "warehouse"))
    build_warehouse(spark, t.trusted(spark, sf_dir), config)
    layers = {f"{layer}_{uuid.uuid4().hex[:8]}": names for layer, names in LAYERS.items()}
    publish_views(spark, config, layers)
    counts = [
        read_relation(spark, f"{layer}.{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("relation"), "n_rows"
        )
        for layer, names in layers.items()
        for name in names
    ]
    found = materialize(reduce(DataFrame.unionByName, counts), "view-counts")
    for layer in layers:
        spark.sql(f"DROP SCHEMA {layer} CASCADE")
    return found
