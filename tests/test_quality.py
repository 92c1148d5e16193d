"""Classification rules, the conservation law, and hot keys."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerspark import fs
from ledgerspark.functions.calendar import add_calendar_features
from ledgerspark.operators import marts, quality
from ledgerspark.session import scratch_path

DDL = (
    "transaction_id string, created_at string, amount double, currency string, "
    "charged_partner string, status string, created_at_timestamp timestamp_ntz"
)
NOON = dt.datetime(2024, 3, 5, 12)


def trusted(spark, rows):
    """Rows of (id, partner, amount[, currency[, time]])."""
    full = []
    for row in rows:
        txn, partner, amount, currency, when = (*row, "EUR", NOON)[:5] if len(row) < 5 else row
        full.append((txn, None, amount, currency, partner, "processed", when))
    df = spark.createDataFrame(full, DDL).withColumn("day", F.dayofmonth("created_at_timestamp"))
    return add_calendar_features(df, "created_at_timestamp")


def classify(spark, rows, **options):
    return quality.classify(quality.stage(trusted(spark, rows)), **options)


def reasons(spark, rows, **options):
    result = classify(spark, rows, **options)
    return sorted(
        (r["transaction_id"], r["charged_partner"], r["is_rejected"], r["rejection_reason"])
        for r in result.collect()
    )


def one(spark, row, **options):
    result = classify(spark, [row], **options).first()
    return result["is_rejected"], result["rejection_reason"]


def test_single_faults(spark):
    assert one(spark, ("a", "p", 1.0)) == (False, "")
    assert one(spark, (None, "p", 1.0)) == (True, "null_transaction_id")
    assert one(spark, ("a", None, 1.0)) == (True, "missing_partner")
    assert one(spark, ("a", "p", 1.0, "EUR", None)) == (True, "missing_created_at")
    assert one(spark, ("a", "p", 0.0)) == (True, "non_positive_amount")
    assert one(spark, ("a", "p", -5.0)) == (True, "non_positive_amount")


def test_null_amount_alone_is_neither_accepted_nor_rejected(spark):
    assert one(spark, ("a", "p", None)) == (None, "")
    assert one(spark, ("a", None, None)) == (True, "missing_partner")
    assert one(spark, ("a", "p", None), null_amount="reject") == (True, "non_positive_amount")
    with pytest.raises(ValueError):
        one(spark, ("a", "p", None), null_amount="drop")


def test_duplicates(spark):
    assert reasons(spark, [("a", "p", 1.0), ("a", "q", 1.0)]) == [
        ("a", "p", True, "duplicate_transaction_id"),
        ("a", "q", True, "duplicate_transaction_id"),
    ]
    both = "duplicate_transaction_id,duplicate_transaction_partner_key"
    assert reasons(spark, [("a", "p", 1.0)] * 2) == [("a", "p", True, both)] * 2
    assert [r[3] for r in reasons(spark, [("a-b", "c", 1.0), ("a", "b-c", 1.0)])] == [
        "duplicate_transaction_partner_key",
        "duplicate_transaction_partner_key",
    ]


@pytest.mark.parametrize("write_counts", [False, True])
def test_null_ids_count_zero_but_share_a_key(spark, write_counts):
    rows = classify(spark, [(None, "p", 1.0)] * 2, write_counts=write_counts).collect()
    assert [r["transaction_id_occurrences"] for r in rows] == [0, 0]
    assert [r["transaction_partner_sk_occurrences"] for r in rows] == [2, 2]
    assert rows[0]["rejection_reason"] == (
        "null_transaction_id,duplicate_transaction_partner_key"
    )


ROW = st.tuples(
    st.sampled_from(["a", "b", "a-b", None]),
    st.sampled_from(["p", "b-p", None]),
    st.sampled_from([1.0, 0.0, -1.0, None]),
    st.just("EUR"),
    st.sampled_from([NOON, None]),
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=st.lists(ROW, min_size=1, max_size=12))
def test_matches_brute_force_and_loses_no_row(spark, rows):
    result = classify(spark, rows).collect()
    assert len(result) == len(rows)

    def key(row):
        mark = "_dbt_utils_surrogate_key_null_"
        return f"{mark if row[0] is None else row[0]}-{mark if row[1] is None else row[1]}"

    expected = []
    for row in rows:
        ids = 0 if row[0] is None else sum(other[0] == row[0] for other in rows)
        sks = sum(key(other) == key(row) for other in rows)
        certain = row[0] is None or ids > 1 or sks > 1 or row[1] is None or row[4] is None
        verdict = True if certain else (None if row[2] is None else row[2] <= 0)
        expected.append((row[0], row[1], row[2], ids, sks, verdict))
    actual = [
        (
            r["transaction_id"],
            r["charged_partner"],
            r["amount"],
            r["transaction_id_occurrences"],
            r["transaction_partner_sk_occurrences"],
            r["is_rejected"],
        )
        for r in result
    ]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


def test_no_operator_uses_a_window(spark):
    plan = classify(spark, [("a", "p", 1.0)])._jdf.queryExecution().toString()
    assert "Window" not in plan


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def splitting(spark):
    """The thresholds of a cluster, scaled down to a test; no broadcast may help."""
    before = {name: spark.conf.get(name, None) for name in SPLIT_EARLY}
    for name, value in SPLIT_EARLY.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def skewed(spark, hot_id, hot_partner=None):
    """60,000 rows, a third of them with the hot values."""
    number = F.col("id")
    hot = number % 3 == 0
    partner = F.concat(F.lit("p"), number % 7)
    if hot_partner:
        partner = F.when(hot, hot_partner).otherwise(partner)
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(hot, hot_id).otherwise(number.cast("string")).alias("transaction_id"),
        F.lit(None).cast("string").alias("created_at"),
        F.rand(1).alias("amount"),
        F.lit("EUR").alias("currency"),
        partner.alias("charged_partner"),
        F.lit("processed").alias("status"),
        F.lit(NOON).cast("timestamp_ntz").alias("created_at_timestamp"),
        F.lit(5).alias("day"),
    )
    return quality.stage(add_calendar_features(rows, "created_at_timestamp"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("write_counts", [False, True])
@pytest.mark.parametrize("hot_id", ["hot", None])
def test_hot_keys_are_split_at_run_time(splitting, hot_id, write_counts):
    """A third of the rows share one id or have none: AQE cuts those partitions."""
    staged = skewed(splitting, hot_id, "p")
    counted = quality.classify(staged, write_counts=write_counts).groupBy(
        "transaction_id_occurrences", "transaction_partner_sk_occurrences"
    ).agg(F.count(F.lit(1)), F.sum("amount"))
    found = {(r[0], r[1]): r[2] for r in counted.collect()}
    assert found == {(0 if hot_id is None else 20000, 20000): 20000, (1, 1): 40000}
    plan = final_plan(counted)
    # Without ids there is no repeated id to join, only the shared surrogate key.
    assert plan.count("SortMergeJoin(skew=true)") == 1, plan


def test_counts_hold_no_shuffle_files_while_rows_are_joined(splitting):
    """The counts are stored and their steps removed; rows and repeated keys are shuffled once."""
    before = set(fs.glob(splitting, scratch_path(splitting, "key-pairs").rsplit("-", 1)[0] + "-*"))
    plan = final_plan(quality.classify(skewed(splitting, "hot", "p")))
    after = set(fs.glob(splitting, scratch_path(splitting, "key-pairs").rsplit("-", 1)[0] + "-*"))
    assert after <= before
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_accepted_rows_never_read_the_rows_without_id(spark):
    accepted = quality.accepted(quality.classify(skewed(spark, None)))
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_hot_partner_is_split_in_the_fact_join(splitting):
    staged = skewed(splitting, F.col("id").cast("string"), "hot")
    base = staged.withColumns({"year": F.lit(2024), "month": F.lit(3)})
    fact = marts.fct_transaction(base, marts.dim_partner(base))
    counted = fact.groupBy("partner_sk").agg(F.count(F.lit(1)), F.sum("amount"))
    assert sorted(r[1] for r in counted.collect())[-1] == 20000
    plan = final_plan(counted)
    assert "SortMergeJoin(skew=true)" in plan, plan


def test_star_schema(spark):
    rows = [("a", "p", 1.0), ("b", "p", 2.0), ("c", "q", 3.0, "USD", dt.datetime(2024, 12, 1))]
    accepted = quality.accepted(classify(spark, rows))
    partners = marts.dim_partner(accepted)
    assert sorted(r["partner_name"] for r in partners.collect()) == ["p", "q"]
    assert sorted(r["date_sk"] for r in marts.dim_date(accepted).collect()) == [20240305, 20241201]
    only_p = partners.where("partner_name = 'p'")
    fact = {r["transaction_id"]: r for r in marts.fct_transaction(accepted, only_p).collect()}
    assert len(fact) == 3 and fact["c"]["partner_sk"] is None
    assert fact["a"]["partner_sk"] == fact["b"]["partner_sk"] is not None
    totals = marts.currency_totals(accepted)
    for mart in (marts.monthly_partner_premiums(accepted), marts.eur_from_totals(totals)):
        found = {(r["partner"], str(r["month"])): r["total_premium"] for r in mart.collect()}
        assert found == {("p", "2024-03-01"): 3, ("q", "2024-12-01"): None}
    by_currency = marts.by_currency_from_totals(totals).collect()
    assert {(r["partner"], r["currency"]): r["total_premium"] for r in by_currency} == {
        ("p", "EUR"): 3, ("q", "USD"): 3,
    }
