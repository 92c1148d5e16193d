"""Landing files to bronze, bronze to the trusted table.

State lives next to the data: the manifest, the pending months, the frozen schema and, for
the time of a bronze write, a note of the months that write may touch. Steps are ordered
so that a crash at any point loses nothing: data, then pending, then manifest; and for the
load: table, then run log, then clearing of pending.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import fs
from ledgerspark.functions.calendar import add_calendar_features, month_id, month_predicate
from ledgerspark.functions.eventtime import add_event_time
from ledgerspark.operators import manifest as m
from ledgerspark.operators.coverage import day_coverage, missing_days, pending_month_ids
from ledgerspark.schema import evolved, load_schema, save_schema, schema_drift
from ledgerspark.session import materialize, scratch_folder
from ledgerspark.sinks.months import append_months, drop_months, move_months
from ledgerspark.sinks.runlog import append_run, run_record
from ledgerspark.sinks.tables import (
    IN_FLIGHT_SECONDS,
    drop_old_versions,
    read_or_empty,
    read_table,
    replace_months,
    replace_table,
    table_exists,
    write_table,
)
from ledgerspark.sources import landing
from ledgerspark.sources.bronze import scan_bronze
from ledgerspark.sources.ranges import RANGE_BYTES, scan_ranges

DRIFT_DDL = "field string, frozen_type string, observed_type string, status string"
PENDING_DDL = "year int, month int, days array<int>"


@dataclass(frozen=True)
class IngestConfig:
    """Folders and options of one feed."""

    landing_dir: str
    bronze_dir: str
    trusted_dir: str
    table_name: str = "premium_transaction"
    tokens: Sequence[str] = ("premium", "transaction")
    extension: str = ".json"
    time_column: str = "created_at"
    timestamp_column: str = "created_at_timestamp"
    # None: infer from the files of the first run, then keep.
    schema: T.StructType | None = None
    write_mode: str = "replace"
    merge_keys: Sequence[str] = field(default_factory=tuple)
    trust_mtime: bool = False
    # Compare the fields of the files to read with the kept schema: one more pass over them.
    report_drift: bool = False
    # Add fields that later files bring to the kept schema, instead of leaving them out. A
    # value that a kept field cannot hold is an error either way.
    evolve_schema: bool = False
    rebalance: bool = True
    # Files are read by ranges of so many bytes; part of a large file's identity, so keep it.
    range_bytes: int = RANGE_BYTES
    # Versions of the trusted table to keep after a load, for readers still on the last one.
    keep_versions: int = 2

    def state(self, name: str) -> str:
        return f"{self.bronze_dir.rstrip('/')}/_state/{name}"


@dataclass(frozen=True)
class BronzePlan:
    """What a bronze run will read. Sets of files are stored frames, months are small."""

    current: DataFrame
    scans: DataFrame  # byte ranges of the files that were opened
    manifest: DataFrame
    unseen: DataFrame
    changed: DataFrame
    ignored: DataFrame
    reread: DataFrame  # other files to read, for the months to rebuild
    impacted: list[int]


def read_manifest(spark: SparkSession, config: IngestConfig) -> DataFrame:
    return read_or_empty(spark, config.state("manifest"), m.STATE_DDL)


def read_pending(spark: SparkSession, config: IngestConfig) -> DataFrame:
    return read_or_empty(spark, config.state("pending"), PENDING_DDL)


def read_drift(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Fields in which the files of the last write differ from the kept schema."""
    return read_or_empty(spark, config.state("drift"), DRIFT_DDL)


def plan_bronze(spark: SparkSession, config: IngestConfig) -> BronzePlan:
    """Compare the landing folder with the manifest. Changes nothing."""
    manifest = read_manifest(spark, config)
    described = landing.describe_directory(
        spark,
        config.landing_dir,
        manifest,
        tokens=config.tokens,
        extension=config.extension,
        time_column=config.time_column,
        trust_mtime=config.trust_mtime,
        range_bytes=config.range_bytes,
    )
    # Joined several times: hash and parse the files once.
    current = materialize(described.current, "landing")
    changed = materialize(m.changed_files(current, manifest), "changed")
    # A new file may also repeat what a changed file holds now.
    fresh = m.unseen_files(current, manifest)
    unseen = materialize(m.without_content_of(fresh, changed), "unseen")
    impacted = _impacted(spark, config, changed, unseen)
    reread = current.limit(0)
    if impacted:
        months = spark.createDataFrame([(v,) for v in impacted], "month_id int")
        to_read = m.files_to_read(current, months, unseen)
        rest = to_read.join(unseen.select("path"), "path", "left_anti")
        # Copies stay ignored in a rebuild: of a new file, and of a file whose rows bronze
        # holds, whether that file is still in the landing folder or not.
        holders = _holders(spark, config, manifest, changed, impacted)
        rest = m.without_copies_of(m.without_content_of(rest, unseen), holders)
        reread = materialize(m.first_copies(rest), "reread")
    return BronzePlan(
        current=current,
        scans=described.scans,
        manifest=manifest,
        unseen=unseen,
        changed=changed,
        ignored=m.ignored_duplicates(current, manifest, unseen),
        reread=reread,
        impacted=impacted,
    )


def _holders(
    spark: SparkSession,
    config: IngestConfig,
    manifest: DataFrame,
    changed: DataFrame,
    impacted: list[int],
) -> DataFrame:
    """Known files, not changed, of which bronze has rows in the months to rebuild.

    Being in the manifest is not enough: an ignored copy is, and has no rows.
    """
    known = manifest.join(changed.select("path"), "path", "left_anti")
    bronze = _scan_bronze(spark, config, impacted)
    if bronze is None:
        return known.limit(0)
    held = bronze.select(F.col("source_file").alias("path")).distinct()
    return materialize(known.join(held, "path", "left_semi"), "holders")


def _impacted(
    spark: SparkSession, config: IngestConfig, changed: DataFrame, unseen: DataFrame
) -> list[int]:
    """Ids of the months to rebuild: a few numbers, whatever the data size."""
    months = {row["month_id"] for row in m.impacted_months(changed).collect()}
    interrupted = _interrupted_months(spark, config)
    if interrupted is not None:
        # The last write died: rebuild whatever it may have touched instead of appending.
        months |= {*interrupted, *_months_of(unseen)}
    return sorted(months)


def _months_of(files: DataFrame) -> list[int]:
    found = files.select(F.explode("months").alias("month_id")).distinct()
    return sorted(row["month_id"] for row in found.collect())


def _interrupted_months(spark: SparkSession, config: IngestConfig) -> list[int] | None:
    text = fs.read_text(spark, config.state("write_in_progress.json"))
    return None if text is None else json.loads(text)


def _schema(spark: SparkSession, config: IngestConfig, scans: DataFrame) -> T.StructType:
    path = config.state("schema.json")
    schema = load_schema(spark, path)
    if schema is None:
        schema = config.schema or landing.observe_schema(scans, config.range_bytes)
        save_schema(spark, path, schema)
    if config.evolve_schema:
        wider = evolved(schema, landing.record_schema(scans, schema, config.range_bytes))
        if wider != schema:
            # Saved before any file has the new fields: older files give null for them.
            save_schema(spark, path, wider)
        return wider
    return schema


def _scan_bronze(spark: SparkSession, config: IngestConfig, months: list[int]) -> DataFrame | None:
    """Bronze rows of some months, with the fields of the kept schema."""
    root = config.bronze_dir.rstrip("/")
    kept = load_schema(spark, config.state("schema.json"))
    if kept is None:
        return scan_bronze(spark, root, months)
    added = [
        T.StructField("source_file", T.StringType()),
        T.StructField(config.timestamp_column, T.TimestampNTZType()),
        T.StructField("day", T.IntegerType()),
    ]
    return scan_bronze(spark, root, months, [*kept.fields, *added])


def _ranges(config: IngestConfig, plan: BronzePlan, files: DataFrame) -> DataFrame:
    """Byte ranges of ``files``; those not opened by the plan are scanned now."""
    scans = plan.scans.join(files.select("path"), "path", "left_semi")
    if config.trust_mtime:
        rest = files.join(plan.scans.select("path"), "path", "left_anti")
        if not rest.isEmpty():
            return scans.unionByName(materialize(scan_ranges(rest, config.range_bytes), "ranges"))
    return scans


def _bronze_rows(config: IngestConfig, scans: DataFrame, schema: T.StructType) -> DataFrame:
    records = landing.read_records(scans, schema, config.range_bytes)
    return add_event_time(records, config.time_column, config.timestamp_column)


def _kept_rows(
    spark: SparkSession, config: IngestConfig, plan: BronzePlan
) -> DataFrame | None:
    """Rows of the months being rebuilt whose file is not read again.

    Rows of files that changed go, and so do those whose content is read from any file.
    """
    bronze = _scan_bronze(spark, config, plan.impacted)
    if bronze is None:
        return None
    taken = plan.reread.select("path", "content_digest").unionByName(
        plan.unseen.select("path", "content_digest")
    )
    gone = taken.select("path").unionByName(plan.changed.select("path"))
    kept = m.without_content_of(plan.manifest.join(gone, "path", "left_anti"), taken)
    files = kept.select(F.col("path").alias("source_file"))
    return bronze.join(files, "source_file", "left_semi").select(*bronze.columns)


def _write_bronze(spark: SparkSession, config: IngestConfig, plan: BronzePlan) -> list[int]:
    """Append new files, rebuild impacted months; returns the months written."""
    sides = {"new": plan.unseen, "reread": plan.reread}
    scans = {side: _ranges(config, plan, files) for side, files in sides.items() if not files.isEmpty()}
    if scans:
        every = reduce(DataFrame.unionByName, scans.values())
        schema = _schema(spark, config, every)
        if config.report_drift:
            found = schema_drift(schema, landing.observe_schema(every, config.range_bytes), spark)
            _replace_state(found, config.state("drift"))
    bronze = config.bronze_dir.rstrip("/")
    if not plan.impacted:
        rows = _bronze_rows(config, scans["new"], schema)
        return sorted(append_months(rows, bronze, rebalance=config.rebalance).months)

    # Parse once into a staging area; nothing in bronze changes if a record is bad. The staged
    # files then become those of bronze.
    with scratch_folder(spark, "bronze-staging") as staging:
        staged = {}
        for side, ranges in scans.items():
            rows = _bronze_rows(config, ranges, schema)
            if side == "reread":
                # Other rows of files read again for an impacted month are already in bronze.
                rows = rows.where(month_predicate(plan.impacted))
            staged[side] = append_months(rows, f"{staging}/{side}", rebalance=config.rebalance).months
        kept = _kept_rows(spark, config, plan)
        if kept is not None:
            staged["kept"] = append_months(kept, f"{staging}/kept", rebalance=False).months
        for month in plan.impacted:
            drop_months(spark, bronze, [month])
            for side, months in staged.items():
                move_months(spark, f"{staging}/{side}", bronze, {month} & months)
        rest = staged.get("new", frozenset()) - set(plan.impacted)
        move_months(spark, f"{staging}/new", bronze, sorted(rest))
    return sorted({*plan.impacted, *rest})


def _planned_months(plan: BronzePlan) -> list[int]:
    return sorted({*plan.impacted, *_months_of(m.changed_or_new(plan.changed, plan.unseen))})


def run_bronze(spark: SparkSession, config: IngestConfig) -> BronzePlan:
    """Bring bronze up to date with the landing folder and mark its months pending."""
    plan = plan_bronze(spark, config)
    in_progress = config.state("write_in_progress.json")
    if plan.impacted or not plan.unseen.isEmpty():
        fs.write_text(spark, in_progress, json.dumps(_planned_months(plan)))
        touched = _write_bronze(spark, config, plan)
        _add_pending(spark, config, touched)
        _save_manifest(plan, config)
        fs.delete(spark, in_progress)
    elif not plan.manifest.isEmpty() and not plan.ignored.isEmpty():
        # Nothing to write, but remember the copies so they are not reported again.
        _save_manifest(plan, config)
    return plan


def _save_manifest(plan: BronzePlan, config: IngestConfig) -> None:
    merged = m.merge_manifest(plan.manifest, plan.current)
    _replace_state(merged, config.state("manifest"))


def _replace_state(df: DataFrame, root: str) -> None:
    replace_table(df, root, keep_if_empty=False)
    drop_old_versions(df.sparkSession, root)


def _add_pending(spark: SparkSession, config: IngestConfig, touched: list[int]) -> None:
    """Union with months still pending; days are those bronze now holds."""
    months = sorted({*touched, *pending_month_ids(read_pending(spark, config))})
    bronze = _scan_bronze(spark, config, months)
    marks = spark.createDataFrame([(v,) for v in months], "m int")
    if bronze is None:
        return
    covered = day_coverage(bronze.select("year", "month", "day")).withColumn(
        "m", month_id(F.col("year"), F.col("month"))
    )
    # A month that lost its last row stays pending, with no days.
    pending = marks.join(covered.select("m", "days"), "m", "left").select(
        F.when(F.col("m") > 0, (F.col("m") / 100).cast("int")).alias("year"),
        F.when(F.col("m") > 0, F.col("m") % 100).alias("month"),
        F.coalesce("days", F.array().cast("array<int>")).alias("days"),
    )
    _replace_state(pending, config.state("pending"))


def pending_gaps(spark: SparkSession, config: IngestConfig, as_of=None) -> DataFrame:
    """Missing days of the pending months."""
    return missing_days(read_pending(spark, config), as_of)


def _clear_pending(spark: SparkSession, config: IngestConfig, loaded: list[int]) -> None:
    done = spark.createDataFrame([(v,) for v in loaded], "m int")
    pending = read_pending(spark, config).withColumn(
        "m", month_id(F.col("year"), F.col("month"))
    )
    rest = pending.join(done, "m", "left_anti").drop("m")
    _replace_state(rest, config.state("pending"))


def _not_loaded(spark: SparkSession, config: IngestConfig, bronze: DataFrame, months: list[int]):
    """Rows of files that the trusted table does not hold yet."""
    if not table_exists(spark, config.trusted_dir):
        return bronze
    loaded = read_table(spark, config.trusted_dir).where(month_predicate(months))
    files = loaded.select("source_file", "year", "month").distinct()
    same = reduce(and_, [bronze[c].eqNullSafe(files[c]) for c in files.columns])
    return bronze.join(files, same, "left_anti")


def run_silver(spark: SparkSession, config: IngestConfig, run_log_dir: str) -> DataFrame:
    """Load pending months into the trusted table; returns the run record.

    All modes read only the pending months. ``replace`` makes them what bronze holds now,
    ``upsert`` merges their rows, ``append`` adds the rows of files that were not loaded
    into the month before (so a corrected file needs one of the other two).
    """
    common = {"table_name": config.table_name, "write_mode": config.write_mode}
    months = pending_month_ids(read_pending(spark, config))
    if not months:
        record = run_record(
            spark, status="skipped", skip_reason="no_pending_bronze_partitions", **common
        )
        append_run(record, run_log_dir)
        return record
    bronze = _scan_bronze(spark, config, months)
    if bronze is None:
        record = run_record(
            spark,
            status="skipped",
            skip_reason="no_bronze_parquet_globs_resolved",
            months=months,
            **common,
        )
        append_run(record, run_log_dir)
        return record
    # Bronze files hold one month each, so the load itself needs no shuffle.
    if config.write_mode == "append":
        bronze = _not_loaded(spark, config, bronze, months)
    trusted = add_calendar_features(bronze, config.timestamp_column)
    if config.write_mode == "replace" and table_exists(spark, config.trusted_dir):
        rows = replace_months(trusted, config.trusted_dir, months, rebalance=False)
    else:
        rows = write_table(
            trusted,
            config.trusted_dir,
            config.write_mode,
            config.merge_keys,
            by_month=True,
            rebalance=False,
            stored_source=True,
        )
    record = run_record(spark, status="completed", rows_written=rows, months=months, **common)
    append_run(record, run_log_dir)
    _clear_pending(spark, config, months)
    drop_old_versions(spark, config.trusted_dir, config.keep_versions, IN_FLIGHT_SECONDS)
    return record


def run_ingest(spark: SparkSession, config: IngestConfig, run_log_dir: str) -> DataFrame:
    """Landing to trusted table; returns the run record of the load."""
    run_bronze(spark, config)
    return run_silver(spark, config, run_log_dir)
