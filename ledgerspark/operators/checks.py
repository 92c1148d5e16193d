"""Data-quality checks. Each returns its failures; an empty result means it passed.

Failures are counted per offending value where the value repeats, so that no check emits
one row per copy of a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows in which ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their row counts."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts. NULL passes."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null child values without a parent, with their row counts.

    Child rows are counted per value before the join, so a hot value is one row in it.
    """
    children = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("from_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(field).alias("from_field"))
    return children.join(parents, "from_field", "left_anti")


def row_counts_match(base: DataFrame, accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row with the three counts when base != accepted + rejected."""
    sides = {"base": base, "accepted": accepted, "rejected": rejected}
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
        for name, df in sides.items()
    ]
    totals = [
        F.sum(F.when(F.col("side") == name, F.col("n"))).alias(f"{name}_row_count")
        for name in sides
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .agg(*totals)
        .where(
            F.col("base_row_count")
            != F.col("accepted_row_count") + F.col("rejected_row_count")
        )
    )


def no_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides; ``n_pairs`` is how many row pairs share the key.

    Both sides are counted per key first: a key repeated on both sides would otherwise
    multiply its rows.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return (
            df.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("overlapping_key"))
            .agg(F.count(F.lit(1)).alias(name))
        )

    return (
        counted(left, "_left")
        .join(counted(right, "_right"), "overlapping_key")
        .select("overlapping_key", (F.col("_left") * F.col("_right")).alias("n_pairs"))
    )


@dataclass(frozen=True)
class RelationChecks:
    """The checks of one relation."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_combination: Sequence[str] = ()
    accepted_values: Mapping[str, Sequence[str]] = field(default_factory=dict)
    # column -> (parent relation, parent column)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # (base relation, rejected relation)
    row_counts: tuple[str, str] | None = None
    # (other relation, key)
    no_overlap: tuple[str, str] | None = None


# What the warehouse promises about its relations.
CURRENCIES = ("EUR", "GBP")
WAREHOUSE_CHECKS: Mapping[str, RelationChecks] = {
    "stg_premium__transactions": RelationChecks(not_null=["transaction_partner_sk"]),
    "premium_transactions": RelationChecks(
        not_null=[
            "transaction_partner_sk",
            "transaction_id",
            "currency",
            "charged_partner",
            "created_at",
            "amount",
        ],
        unique=["transaction_partner_sk", "transaction_id"],
        accepted_values={"currency": CURRENCIES},
        row_counts=("stg_premium__transactions", "premium_rejected_transactions"),
        no_overlap=("premium_rejected_transactions", "transaction_partner_sk"),
    ),
    "premium_rejected_transactions": RelationChecks(
        not_null=[
            "transaction_partner_sk",
            "transaction_id_occurrences",
            "transaction_partner_sk_occurrences",
            "is_rejected",
            "has_non_positive_amount",
            "rejection_reason",
        ],
    ),
    "dim_partner": RelationChecks(
        not_null=["partner_sk", "partner_name"], unique=["partner_sk", "partner_name"]
    ),
    "dim_date": RelationChecks(
        not_null=["date_sk", "full_date"], unique=["date_sk", "full_date"]
    ),
    "fct_transaction": RelationChecks(
        not_null=["transaction_sk", "transaction_id", "partner_sk", "date_sk", "amount"],
        unique=["transaction_sk"],
        relationships={
            "partner_sk": ("dim_partner", "partner_sk"),
            "date_sk": ("dim_date", "date_sk"),
        },
    ),
    "monthly_partner_premiums": RelationChecks(
        not_null=["partner", "month", "total_premium"],
        unique_combination=["partner", "month"],
    ),
    "monthly_partner_premiums_by_currency": RelationChecks(
        not_null=["partner", "month", "currency", "total_premium"],
        unique_combination=["partner", "month", "currency"],
        accepted_values={"currency": CURRENCIES},
    ),
}


def _labelled(failures: DataFrame, relation: str, check: str, column: str) -> DataFrame:
    return failures.select(
        F.lit(relation).alias("relation"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def _per_column(
    counts: DataFrame, relation: str, check: str, columns: Sequence[str]
) -> DataFrame:
    """One row per column from a one-row aggregate with a count ``_<i>`` for each."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failures"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select(
        F.lit(relation).alias("relation"),
        F.lit(check).alias("check"),
        "e.column_name",
        "e.failures",
    )


def _not_null_pass(df: DataFrame, relation: str, columns: Sequence[str]) -> DataFrame:
    """All NULL checks of a relation from a single aggregate over it."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    return _per_column(counts, relation, "not_null", columns)


def _unique_pass(df: DataFrame, relation: str, columns: Sequence[str]) -> DataFrame:
    """All single-column uniqueness checks of a relation from one scan and one shuffle."""
    values = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    repeated = unique_combination(
        df.select(F.inline(values)).where(F.col("value").isNotNull()), ["i", "value"]
    )
    counts = repeated.agg(
        *[F.count_if(F.col("i") == i).alias(f"_{i}") for i in range(len(columns))]
    )
    return _per_column(counts, relation, "unique", columns)


def _count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures"))


def _sum_rows(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).alias("failures"))


def _relation_results(
    name: str, spec: RelationChecks, relations: Mapping[str, DataFrame]
) -> Iterable[DataFrame]:
    df = relations[name]
    if spec.not_null:
        yield _not_null_pass(df, name, spec.not_null)
    if spec.unique:
        yield _unique_pass(df, name, spec.unique)
    if spec.unique_combination:
        label = ",".join(spec.unique_combination)
        found = unique_combination(df, spec.unique_combination)
        yield _labelled(_count_rows(found), name, "unique_combination", label)
    for column, values in spec.accepted_values.items():
        found = accepted_values(df, column, values)
        yield _labelled(_count_rows(found), name, "accepted_values", column)
    for column, (parent, parent_column) in spec.relationships.items():
        found = relationships(df, column, relations[parent], parent_column)
        yield _labelled(_sum_rows(found, "n_records"), name, "relationships", column)
    if spec.row_counts:
        base, rejected = spec.row_counts
        found = row_counts_match(relations[base], df, relations[rejected])
        yield _labelled(_count_rows(found), name, "row_counts_match", "")
    if spec.no_overlap:
        other, key = spec.no_overlap
        found = no_overlap(df, relations[other], key)
        yield _labelled(_sum_rows(found, "n_pairs"), name, "no_overlap", key)


def run_checks(
    relations: Mapping[str, DataFrame],
    specs: Mapping[str, RelationChecks] = WAREHOUSE_CHECKS,
) -> DataFrame:
    """One row (relation, check, column_name, failures) per check."""
    results = [
        result
        for name, spec in specs.items()
        for result in _relation_results(name, spec, relations)
    ]
    return reduce(DataFrame.unionByName, results)
