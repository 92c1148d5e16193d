"""Trusted table to quality tables, star schema and monthly marts."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import fs
from ledgerspark.functions.money import RATES_PER_EUR
from ledgerspark.operators import marts, quality
from ledgerspark.operators.checks import run_checks
from ledgerspark.sinks.report import export_report
from ledgerspark.sinks.tables import (
    current_files_sql,
    drop_old_versions,
    read_table,
    replace_table,
    source_of,
    table_exists,
    upsert_table,
)
from ledgerspark.sources.relations import quoted, read_relation

# The schema of each layer and the relations in it.
LAYERS: Mapping[str, tuple[str, ...]] = {
    "staging": ("stg_premium__transactions",),
    "intermediate": (
        "premium_transaction_quality",
        "premium_transactions",
        "premium_rejected_transactions",
    ),
    "analytics": (
        "dim_partner",
        "dim_date",
        "fct_transaction",
        "monthly_partner_premiums",
        "monthly_partner_premiums_by_currency",
    ),
}


# Which views are published, below the warehouse's root.
VIEWS = "_state/views.json"


@dataclass(frozen=True)
class WarehouseConfig:
    """Where the relations live and how the two incremental ones are kept.

    ``sync`` keeps exactly the rows that are accepted now. ``merge`` only adds and
    updates: a row that was accepted once stays, even if a copy of it arrives later.
    """

    root: str
    incremental: str = "sync"
    null_amount: str = "keep"
    rates: Mapping[str, float] = field(default_factory=lambda: dict(RATES_PER_EUR))
    # Versions of each relation to keep after a build, for readers still on the last one.
    keep_versions: int = 2

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def build_warehouse(
    spark: SparkSession, trusted: DataFrame, config: WarehouseConfig
) -> dict[str, DataFrame]:
    """Build all relations and return them by name.

    Every stage is written and read back: later stages start from stored Parquet whose
    size Catalyst knows, and lost executors cost no recomputation of earlier stages.
    """
    if config.incremental not in ("sync", "merge"):
        raise ValueError("incremental must be 'sync' or 'merge'.")
    staged = quality.stage(trusted)
    classified = quality.classify(
        staged, null_amount=config.null_amount, write_counts=True
    )
    # One pass stores accepted, rejected and unclassified rows side by side.
    quality_path = config.table("premium_transaction_quality")
    replace_table(quality.with_verdict(classified), quality_path, partition_by=["verdict"])
    stored = read_table(spark, quality_path)
    accepted_now = quality.accepted(stored.where(F.col("verdict") == "accepted"))
    rejected = quality.rejected(stored.where(F.col("verdict") == "rejected"))

    if config.incremental == "merge":
        path = config.table("premium_transactions")
        key = ["transaction_partner_sk"]
        upsert_table(accepted_now, path, key, by_month=True, stored_source=True)
        accepted = read_table(spark, path).select(*accepted_now.columns)
    else:
        # The accepted verdict of the stored quality table, with no second copy.
        accepted = accepted_now

    def store(name: str, df: DataFrame) -> DataFrame:
        path = config.table(name)
        replace_table(df, path, keep_if_empty=False)
        return read_table(spark, path)

    totals = store("monthly_currency_totals", marts.currency_totals(accepted))
    partners = store("dim_partner", marts.dim_partner(accepted))
    dates = store("dim_date", marts.dim_date(accepted))
    fact = marts.fct_transaction(accepted, partners)
    fact_path = config.table("fct_transaction")
    if config.incremental == "merge" and table_exists(spark, fact_path):
        upsert_table(fact, fact_path, ["transaction_sk"])
    else:
        replace_table(fact, fact_path, keep_if_empty=False)
    relations = {
        "stg_premium__transactions": staged,
        "premium_transaction_quality": stored.drop("verdict"),
        "premium_transactions": accepted,
        "premium_rejected_transactions": rejected,
        "premium_unclassified_transactions": quality.unclassified(
            stored.where(F.col("verdict") == "unclassified")
        ),
        "dim_partner": partners,
        "dim_date": dates,
        "fct_transaction": read_table(spark, fact_path),
        "monthly_partner_premiums": store(
            "monthly_partner_premiums", marts.eur_from_totals(totals, config.rates)
        ),
        "monthly_partner_premiums_by_currency": store(
            "monthly_partner_premiums_by_currency", marts.by_currency_from_totals(totals)
        ),
    }
    # Views move to this build before the versions they may point at go.
    published = _published_layers(spark, config)
    if published:
        publish_views(spark, config, published)
    for name in (*relations, "monthly_currency_totals"):
        drop_old_versions(spark, config.table(name), config.keep_versions)
    return relations


def check_warehouse(relations: Mapping[str, DataFrame]) -> DataFrame:
    """(relation, check, column_name, failures) for every promised property."""
    return run_checks(relations)


def register(relations: Mapping[str, DataFrame]) -> None:
    """Expose relations to Spark SQL as temporary views."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)


def publish_views(
    spark: SparkSession,
    config: WarehouseConfig,
    layers: Mapping[str, tuple[str, ...]] = LAYERS,
) -> None:
    """Point a catalog view ``schema.relation`` at the current version of each relation.

    No data is copied: staging, accepted and rejected rows are selections from the stored
    quality table. Each view switches to a new build in one catalog update. The warehouse
    remembers what is published, and every later build points these views at itself.
    """
    flags = [name for name, _ in quality.rejection_flags().values()]
    verdict_columns = [*quality.COUNT_COLUMNS, *flags, "is_rejected", "rejection_reason"]
    every = [*quality.ACCEPTED_COLUMNS, *verdict_columns]
    selections = {
        "stg_premium__transactions": (quality.BASE_COLUMNS, "TRUE"),
        "premium_transaction_quality": (every, "TRUE"),
        "premium_rejected_transactions": (every, "verdict = 'rejected'"),
    }
    own: dict[str, tuple] = {}
    if config.incremental == "sync":
        selections["premium_transactions"] = (
            quality.ACCEPTED_COLUMNS,
            "verdict = 'accepted'",
        )
    else:
        kept = current_files_sql(spark, config.table("premium_transactions"))
        own["premium_transactions"] = (quality.ACCEPTED_COLUMNS, kept)
    for schema, names in layers.items():
        schema = quoted(schema)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        for name in names:
            columns, condition = selections.get(name) or own.get(name, (["*"], "TRUE"))
            source = "premium_transaction_quality" if name in selections else name
            path, _ = source_of(spark, config.table(source))
            spark.sql(
                f"CREATE OR REPLACE VIEW {schema}.{quoted(name)} AS "
                f"SELECT {', '.join(columns)} FROM parquet.`{path}` WHERE {condition}"
            )


    state = config.table(VIEWS)
    known = _published_layers(spark, config)
    if known != {schema: tuple(names) for schema, names in layers.items()}:
        fs.write_text(spark, state, json.dumps({k: list(v) for k, v in {**known, **layers}.items()}))


def _published_layers(spark: SparkSession, config: WarehouseConfig) -> dict[str, tuple[str, ...]]:
    text = fs.read_text(spark, config.table(VIEWS))
    return {schema: tuple(names) for schema, names in json.loads(text or "{}").items()}


def unpublish_views(spark: SparkSession, config: WarehouseConfig) -> None:
    """Drop the published views and forget them; their schemas stay."""
    for schema, names in _published_layers(spark, config).items():
        for name in names:
            spark.sql(f"DROP VIEW IF EXISTS {quoted(schema)}.{quoted(name)}")
    fs.delete(spark, config.table(VIEWS))


def export_monthly_report(
    spark: SparkSession,
    output_dir: str,
    relation: str = "monthly_partner_premiums",
    *,
    single_file: bool = False,
) -> str:
    """Export a registered monthly mart to CSV; a missing relation is an error."""
    return export_report(read_relation(spark, relation), output_dir, single_file=single_file)
