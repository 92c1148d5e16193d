"""Accept or reject every transaction, with the reasons.

The two occurrence counts are not windows: a window would bring all rows of one key into
one task. Pairs of keys are counted with map-side combine, only those that hold a repeated
key are kept, and these are joined back once.
"""

from __future__ import annotations

from contextlib import ExitStack
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.keys import pack, surrogate_key, unpack
from ledgerspark.session import materialize, materialized

BASE_COLUMNS = (
    "transaction_partner_sk",
    "transaction_id",
    "created_at_raw",
    "amount",
    "currency",
    "charged_partner",
    "status",
    "created_at",
    "day",
    "day_name",
    "week_of_year",
    "is_festive_season",
)
ACCEPTED_COLUMNS = (*BASE_COLUMNS[:8], "year", "month", *BASE_COLUMNS[8:])
COUNT_COLUMNS = ("transaction_id_occurrences", "transaction_partner_sk_occurrences")


def stage(trusted: DataFrame) -> DataFrame:
    """Rename the event-time columns and add the surrogate key."""
    return trusted.select(
        "transaction_id",
        F.col("created_at").alias("created_at_raw"),
        "amount",
        "currency",
        "charged_partner",
        "status",
        F.col("created_at_timestamp").alias("created_at"),
        "day",
        "day_name",
        "week_of_year",
        "is_festive_season",
        surrogate_key("transaction_id", "charged_partner").alias("transaction_partner_sk"),
    )


def repeated_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    """(first, second, count of first, count of second) where either value repeats, stored.

    One aggregate of the rows by both columns; the counts of each follow from it, so ``df`` is
    read once. The null value of ``first`` is not counted (0). ``second`` is text and shuffled
    packed. Every step is stored, so that its shuffle files go before the next one has its own,
    and repeated values that prove few are broadcast.
    """
    rows = df.select(first, pack(F.col(second)).alias(second))
    counted = rows.groupBy(first, second).agg(F.count(F.lit(1)).alias("n"))
    with ExitStack() as stack:
        pairs = stack.enter_context(materialized(counted, "key-pairs"))

        def repeated(key: str, name: str) -> DataFrame:
            found = (
                pairs.where(F.col(key).isNotNull())
                .groupBy(key)
                .agg(F.sum("n").alias(name))
                .where(F.col(name) > 1)
            )
            return stack.enter_context(materialized(found, "repeated-values"))

        once = F.when(F.col(first).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
        found = (
            pairs.join(repeated(first, "first_count"), first, "left")
            .join(repeated(second, "second_count"), second, "left")
            .where("first_count > 1 OR second_count > 1")
            .select(
                first,
                unpack(F.col(second)).alias(second),
                F.coalesce("first_count", once).alias("first_count"),
                F.coalesce("second_count", F.lit(1).cast("bigint")).alias("second_count"),
            )
        )
        return materialize(found, "repeated-keys")


def own_exchange(aggregated: DataFrame) -> DataFrame:
    """Keep an aggregate from lending its partitioning to a later join.

    AQE splits hot partitions only where both sides of a join are shuffled for the join
    itself. A join straight on top of an aggregate reuses the shuffle of the aggregate,
    and a hot key on its other side would then stay in one task.
    """
    return aggregated.hint("rebalance")


def add_occurrences(staged: DataFrame, *, write_counts: bool = True) -> DataFrame:
    """Row counts per transaction id (0 for a null id) and per surrogate key.

    One join on both keys, so that rows without an id are spread by their surrogate key.
    It carries no hint: the repeated keys are stored, so that Catalyst knows their true size
    before it plans. If it is small, the wide rows are never shuffled; otherwise AQE splits
    the partitions of hot keys. ``write_counts`` has no effect any more: keys that are not
    written keep the shuffle files of their counts until the wide rows are joined.
    """
    return join_occurrences(staged, repeated_pairs(staged, "transaction_id", "transaction_partner_sk"))


def join_occurrences(staged: DataFrame, repeated: DataFrame) -> DataFrame:
    """``staged`` with the counts of ``repeated`` (as from :func:`repeated_pairs`).

    Where that has none, the counts that ``staged`` has stay; without any, a key occurs once
    and a null id never. Surrogate keys are shuffled packed.
    """
    key = "transaction_partner_sk"
    same = F.col("s.transaction_partner_sk").eqNullSafe(F.col("r.transaction_partner_sk")) & F.col(
        "s.transaction_id"
    ).eqNullSafe(F.col("r.transaction_id"))
    once, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ids, keys = COUNT_COLUMNS
    known = ids in staged.columns
    others = [
        unpack(F.col(f"s.{c}")).alias(c) if c == key else F.col(f"s.{c}")
        for c in staged.columns
        if c not in COUNT_COLUMNS
    ]
    return (
        staged.withColumn(key, pack(F.col(key))).alias("s")
        .join(repeated.withColumn(key, pack(F.col(key))).alias("r"), same, "left")
        .select(
            *others,
            F.when(F.col("s.transaction_id").isNull(), none)
            .otherwise(F.coalesce("r.first_count", F.col(f"s.{ids}") if known else once))
            .alias(ids),
            F.coalesce("r.second_count", F.col(f"s.{keys}") if known else once).alias(keys),
        )
    )


def rejection_flags() -> dict[str, tuple[str, Column]]:
    """Reason text -> (flag column, condition), in report order. Conditions are 3-valued."""
    return {
        "null_transaction_id": (
            "has_null_transaction_id",
            F.col("transaction_id").isNull(),
        ),
        "duplicate_transaction_id": (
            "has_duplicate_transaction_id",
            F.col("transaction_id_occurrences") > 1,
        ),
        "duplicate_transaction_partner_key": (
            "has_duplicate_transaction_partner_key",
            F.col("transaction_partner_sk_occurrences") > 1,
        ),
        "missing_partner": ("has_missing_partner", F.col("charged_partner").isNull()),
        "missing_created_at": ("has_missing_created_at", F.col("created_at").isNull()),
        "non_positive_amount": ("has_non_positive_amount", F.col("amount") <= 0),
    }


def classify(
    staged: DataFrame, *, null_amount: str = "keep", write_counts: bool = True
) -> DataFrame:
    """Add counts, calendar parts, flags, ``is_rejected`` and ``rejection_reason``.

    A row whose only fault is a NULL amount has a NULL ``is_rejected`` and is neither
    accepted nor rejected. ``null_amount='reject'`` treats it as a non-positive amount.
    """
    base = staged.select(*BASE_COLUMNS)
    return judge(add_occurrences(base, write_counts=write_counts), null_amount)


def judge(counted: DataFrame, null_amount: str = "keep") -> DataFrame:
    """Flags, verdict and reason of rows that have their counts; see :func:`classify`."""
    if null_amount not in ("keep", "reject"):
        raise ValueError("null_amount must be 'keep' or 'reject'.")
    flags = rejection_flags()
    if null_amount == "reject":
        name, condition = flags["non_positive_amount"]
        flags["non_positive_amount"] = (name, F.coalesce(condition, F.lit(True)))
    return counted.select(
        *BASE_COLUMNS,
        *COUNT_COLUMNS,
        F.year("created_at").alias("year"),
        F.month("created_at").alias("month"),
        *[condition.alias(name) for name, condition in flags.values()],
        reduce(or_, [condition for _, condition in flags.values()]).alias("is_rejected"),
        F.concat_ws(
            ",", *[F.when(condition, reason) for reason, (_, condition) in flags.items()]
        ).alias("rejection_reason"),
    )


def accepted(quality: DataFrame) -> DataFrame:
    return quality.where(~F.col("is_rejected")).select(*ACCEPTED_COLUMNS)


def rejected(quality: DataFrame) -> DataFrame:
    flags = [name for name, _ in rejection_flags().values()]
    return quality.where("is_rejected").select(
        *ACCEPTED_COLUMNS, *COUNT_COLUMNS, *flags, "is_rejected", "rejection_reason"
    )


def unclassified(quality: DataFrame) -> DataFrame:
    """Rows in neither table: the amount is NULL and nothing else is wrong."""
    return quality.where(F.col("is_rejected").isNull()).select(*ACCEPTED_COLUMNS)


def with_verdict(quality: DataFrame) -> DataFrame:
    """Add ``verdict``, a non-null partition column for storing all three groups at once."""
    verdict = (
        F.when(F.col("is_rejected").isNull(), "unclassified")
        .when(F.col("is_rejected"), "rejected")
        .otherwise("accepted")
    )
    return quality.withColumn("verdict", verdict)
