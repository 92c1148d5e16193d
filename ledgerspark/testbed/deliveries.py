"""Queries over several deliveries: incremental relations, and files that come and go."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import fs
from ledgerspark.functions import eventtime
from ledgerspark.functions.calendar import add_calendar_features
from ledgerspark.operators import coverage
from ledgerspark.operators.manifest import STATE_DDL
from ledgerspark.plans.incremental import IncrementalConfig, refresh, relations
from ledgerspark.plans.ingest import read_manifest, run_bronze, run_ingest
from ledgerspark.schema import RAW_SCHEMA
from ledgerspark.session import scratch_path
from ledgerspark.sinks import months as month_sink
from ledgerspark.sinks import tables
from ledgerspark.sources import landing
from ledgerspark.sources.ranges import json_records, scan_ranges
from ledgerspark.testbed import tables as t
from ledgerspark.testbed.queries import (
    RAW_FIELDS,
    bronze_content,
    comparable,
    deliver,
    landed,
    replace_files,
    split_feed,
    with_month,
    write_landing_file,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _trusted(rows: DataFrame) -> DataFrame:
    """Raw rows with event times as rows of the trusted table."""
    time = F.col("created_at_timestamp")
    return add_calendar_features(
        rows.withColumns(
            {
                "created_at": F.date_format(time, "MM/dd/yyyy HH:mm:ss"),
                "year": F.year(time),
                "month": F.month(time),
                "day": F.dayofmonth(time),
            }
        ),
        "created_at_timestamp",
    )


def _three_deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Relations after a refresh for each of three deliveries.

    All processed rows; then the others of 1997 with copies of processed rows of first days
    of that year, dated 40 days later (in other months); then a correction that doubles the
    EUR amounts of May 1996 and takes the other rows of that month away.
    """
    root = scratch_path(spark, "deliveries")
    config = IncrementalConfig(f"{root}/trusted", f"{root}/warehouse")
    rows = t.transactions(spark, sf_dir)
    processed, time = F.col("status") == "processed", F.col("created_at_timestamp")
    of_1997 = F.year(time) == 1997
    tables.write_table(_trusted(rows.where(processed)), config.trusted_dir, by_month=True)
    refresh(spark, config)
    late = rows.where(processed & of_1997 & (F.dayofmonth(time) == 1)).withColumn(
        "created_at_timestamp", time + F.expr("INTERVAL 40 DAYS")
    )
    second = rows.where(~processed & of_1997).unionByName(late)
    tables.append_table(_trusted(second), config.trusted_dir, by_month=True)
    refresh(spark, config)
    may = rows.where(processed & (F.year(time) == 1996) & (F.month(time) == 5) & (F.col("currency") == "EUR"))
    corrected = may.withColumn("amount", F.col("amount") * 2)
    tables.replace_months(_trusted(corrected), config.trusted_dir, [199605])
    refresh(spark, config)
    return relations(spark, config)


@query
def incremental_quality(spark, sf_dir):
    """Every row with its counts and verdict, as a full build would have them."""
    return comparable(_three_deliveries(spark, sf_dir)["premium_transaction_quality"])


@query
def incremental_marts(spark, sf_dir):
    """Both marts, from signed differences of three deliveries."""
    found = _three_deliveries(spark, sf_dir)
    eur = found["monthly_partner_premiums"].withColumn("currency", F.lit(None).cast("string"))
    return comparable(eur.unionByName(found["monthly_partner_premiums_by_currency"]))


@query
def incremental_star(spark, sf_dir):
    """The fact with its partner names and days looked up in the incremental dimensions."""
    found = _three_deliveries(spark, sf_dir)
    return comparable(
        found["fct_transaction"]
        .join(found["dim_partner"], "partner_sk", "left")
        .join(found["dim_date"], "date_sk", "left")
        .select("transaction_sk", "transaction_id", "partner_name", "full_date", "week_of_year", "amount", "status")
    )



# --- files -----------------------------------------------------------------------------

# Small ranges, so that a landing file of test size is read by many tasks.
SMALL_RANGES = 256 << 10


@query
def ingest_removed_copy(spark, sf_dir):
    """Of files that came twice one goes, here the copy and there the original; others are
    corrected in the same months: every row stays once."""
    config, root, first, second = split_feed(spark, sf_dir)
    for rows in (first, first, second):
        deliver(rows, config)
    run_bronze(spark, config)
    known = read_manifest(spark, config)
    pairs = (
        known.groupBy("content_digest")
        .agg(F.sort_array(F.collect_set("path")).alias("paths"))
        .where(F.size("paths") == 2)
        .orderBy(F.col("paths")[0])
        .collect()
    )
    for k, pair in enumerate(pairs):
        fs.delete(spark, pair["paths"][k % 2])
    twice = {path for pair in pairs for path in pair["paths"]}
    others = [path for path in landed(spark, config) if path not in twice]
    replace_files(spark, others, second.withColumn("amount", F.col("amount") * 2), root)
    run_bronze(spark, config)
    return bronze_content(spark, config)


def _one_file(spark, sf_dir, copies: int = 1) -> str:
    """A landing folder with all transactions in one JSON array, or in several equal ones."""
    folder = f"{scratch_path(spark, 'feed')}/landing"
    rows = t.transactions(spark, sf_dir).drop("created_at_timestamp")
    write_landing_file(rows, folder, copies)
    return folder


@query
def split_json_ingest(spark, sf_dir):
    """One JSON array, read by many tasks into bronze: every row."""
    folder = _one_file(spark, sf_dir)
    scans = scan_ranges(landing.list_files(spark, folder, ("part",), ".txt"), SMALL_RANGES)
    records = landing.read_records(scans, RAW_SCHEMA, SMALL_RANGES).drop("source_file")
    bronze = f"{folder}-bronze"
    month_sink.append_months(eventtime.add_event_time(records, "created_at", "created_at_timestamp"), bronze)
    return comparable(month_sink.read_months(spark, bronze).select(*RAW_FIELDS, "year", "month", "day"))


@query
def large_file_manifest(spark, sf_dir):
    """State of one file that many tasks read: months, first date, records, and that a copy of
    it has the same digest."""
    folder = _one_file(spark, sf_dir, copies=2)
    described = landing.describe_directory(
        spark, folder, spark.createDataFrame([], STATE_DDL), tokens=("part",), extension=".txt",
        range_bytes=SMALL_RANGES,
    )
    records = json_records(described.scans, SMALL_RANGES).groupBy("path").agg(F.count(F.lit(1)).alias("n_records"))
    return (
        described.current.join(records, "path")
        .groupBy("content_digest", "file_date", "months", "n_records")
        .agg(F.count(F.lit(1)).alias("n_files"))
        .select("file_date", F.explode("months").alias("month_id"), "n_records", "n_files")
    )


@query
def ordered_file_set(spark, sf_dir):
    """documents as landing files, with their places in source order."""
    return landing.with_positions(t.landing_files(spark, sf_dir)).select("path", "file_date", "position")


@query
def schema_evolution(spark, sf_dir):
    """The second delivery lacks the status and says through which channel it came: the kept
    schema grows, and the rows of both have all fields."""
    config, _, first, second = split_feed(spark, sf_dir, evolve_schema=True)
    deliver(first, config)
    run_ingest(spark, config, f"{config.landing_dir}-runs")
    deliver(second.drop("status").withColumn("channel", F.lit("branch")), config)
    run_ingest(spark, config, f"{config.landing_dir}-runs")
    trusted = tables.read_table(spark, config.trusted_dir)
    return comparable(trusted.select(*RAW_FIELDS, "channel", "year", "month", "day"))


@query
def compacted_table(spark, sf_dir):
    """orders in five appends, one per priority, then compacted: every row, and the writes its
    month consists of."""
    root = scratch_path(spark, "orders")
    time = F.col("o_orderdate")
    rows = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.year(time).alias("year"), F.month(time).alias("month")
    )
    for first in "12345":
        tables.append_table(rows.where(F.col("o_orderpriority").startswith(first)), root, by_month=True)
    tables.compact_table(spark, root)
    writes = [(m, len(names)) for m, names in tables.month_writes(spark, root).items()]
    counts = spark.createDataFrame(writes, "month_id int, n_writes int")
    found = tables.read_table(spark, root).withColumn("month_id", F.col("year") * 100 + F.col("month"))
    return found.join(counts, "month_id", "left").drop("year", "month")


@query
def concurrent_commits(spark, sf_dir):
    """orders appended by two writers at a time, then upserted by two more that change half of
    the orders of every month each: the rows of all four."""
    root = scratch_path(spark, "orders")
    rows = with_month(t.table(spark, sf_dir, "orders"), "o_orderdate")
    rows = rows.select("o_orderkey", "o_totalprice", "o_orderpriority", "year", "month")
    even, price = F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")
    urgent = F.coalesce(F.col("o_orderpriority") < "3", F.lit(False))

    def append(part):
        tables.append_table(part, root, by_month=True)

    def upsert(part):
        tables.upsert_table(part, root, ["o_orderkey"], by_month=True, stored_source=True)

    # The table is there before its writers.
    tables.replace_months(rows.limit(0), root, [])
    for write, parts in (
        (append, (rows.where(urgent), rows.where(~urgent))),
        (upsert, (rows.where(even).withColumn("o_totalprice", price * 2),
                  rows.where(~even).withColumn("o_totalprice", price + 1))),
    ):
        with ThreadPoolExecutor(2) as writers:
            list(writers.map(write, parts))
    return tables.read_table(spark, root)


@query
def bitmap_backfill(spark, sf_dir):
    """The backfill plans of all partners at once: three months before the first one to the
    last; loaded are the months with processed rows."""
    rows = t.transactions(spark, sf_dir).withColumn("month", F.trunc("created_at_timestamp", "MM"))
    spans = rows.groupBy("charged_partner").agg(
        F.add_months(F.min("month"), -3).alias("first"), F.max("month").alias("last")
    )
    return coverage.backfill_plans(
        coverage.range_bits(spans, "charged_partner"),
        coverage.month_bits(rows, "charged_partner"),
        coverage.month_bits(rows.where(F.col("status") == "processed"), "charged_partner"),
    )
