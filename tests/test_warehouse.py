"""Warehouse build, incremental modes, checks, report and catalog views."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions.calendar import add_calendar_features
from ledgerspark.operators import checks
from ledgerspark.plans.warehouse import (
    WarehouseConfig,
    build_warehouse,
    check_warehouse,
    export_monthly_report,
    publish_views,
    register,
    unpublish_views,
)
from ledgerspark.sinks.report import REPORT_NAME, export_report, read_report
from ledgerspark.sources.relations import quoted, read_relation

DDL = (
    "transaction_id string, created_at string, amount double, currency string, "
    "charged_partner string, status string, created_at_timestamp timestamp_ntz"
)


def trusted(spark, rows):
    full = [
        (txn, None, amount, currency, partner, "processed", dt.datetime(2024, month, 5))
        for txn, partner, amount, currency, month in rows
    ]
    df = spark.createDataFrame(full, DDL).withColumn("day", F.dayofmonth("created_at_timestamp"))
    return add_calendar_features(df, "created_at_timestamp")


FIRST = [("a", "p", 10.0, "EUR", 1), ("b", "q", 20.0, "EUR", 2), ("c", "p", -1.0, "EUR", 2)]
# b now has a copy; d is new.
SECOND = [*FIRST, ("b", "q", 20.0, "EUR", 2), ("d", "r", 5.0, "EUR", 3)]


def failing(relations):
    rows = check_warehouse(relations).where("failures > 0").collect()
    return {(r["relation"], r["check"], r["column_name"]): r["failures"] for r in rows}


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


def test_sync_keeps_what_is_accepted_now(spark, tmp_path):
    config = WarehouseConfig(str(tmp_path))
    first = build_warehouse(spark, trusted(spark, FIRST), config)
    assert ids(first["premium_transactions"]) == ["a", "b"]
    assert failing(first) == {}
    second = build_warehouse(spark, trusted(spark, SECOND), config)
    assert ids(second["premium_transactions"]) == ["a", "d"]
    assert ids(second["fct_transaction"]) == ["a", "d"]
    assert ids(second["premium_rejected_transactions"]) == ["b", "b", "c"]
    assert failing(second) == {}


def test_merge_never_deletes(spark, tmp_path):
    config = WarehouseConfig(str(tmp_path), incremental="merge")
    assert failing(build_warehouse(spark, trusted(spark, FIRST), config)) == {}
    second = build_warehouse(spark, trusted(spark, SECOND), config)
    assert ids(second["premium_transactions"]) == ["a", "b", "d"]
    assert ids(second["fct_transaction"]) == ["a", "b", "d"]
    # The checks say so: b is on both sides, once against two rejected rows.
    assert failing(second) == {
        ("premium_transactions", "row_counts_match", ""): 1,
        ("premium_transactions", "no_overlap", "transaction_partner_sk"): 2,
    }


def test_rebuild_changes_nothing(spark, tmp_path):
    config = WarehouseConfig(str(tmp_path), incremental="merge")

    def contents():
        built = build_warehouse(spark, trusted(spark, SECOND), config)
        return {n: sorted(map(repr, df.collect())) for n, df in built.items()}

    assert contents() == contents()
    with pytest.raises(ValueError):
        build_warehouse(spark, trusted(spark, FIRST), WarehouseConfig(str(tmp_path), "other"))


def test_null_amount_shows_in_the_row_counts(spark, tmp_path):
    rows = [*FIRST, ("n", "p", None, "EUR", 1)]
    kept = build_warehouse(spark, trusted(spark, rows), WarehouseConfig(str(tmp_path / "k")))
    assert ids(kept["premium_unclassified_transactions"]) == ["n"]
    assert failing(kept) == {("premium_transactions", "row_counts_match", ""): 1}
    strict = WarehouseConfig(str(tmp_path / "s"), null_amount="reject")
    assert failing(build_warehouse(spark, trusted(spark, rows), strict)) == {}


def test_unknown_currency_is_visible(spark, tmp_path):
    rows = [*FIRST, ("u", "z", 7.0, "USD", 1)]
    relations = build_warehouse(spark, trusted(spark, rows), WarehouseConfig(str(tmp_path)))
    assert failing(relations) == {
        ("premium_transactions", "accepted_values", "currency"): 1,
        ("monthly_partner_premiums", "not_null", "total_premium"): 1,
        ("monthly_partner_premiums_by_currency", "accepted_values", "currency"): 1,
    }


def test_number_of_checks():
    count = 0
    for spec in checks.WAREHOUSE_CHECKS.values():
        count += len(spec.not_null) + len(spec.unique) + len(spec.accepted_values)
        count += len(spec.relationships) + bool(spec.unique_combination)
        count += bool(spec.row_counts) + bool(spec.no_overlap)
    assert count == 44


def test_single_checks(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("y", None), (None, 1), (None, 2)], "k string, n int")
    assert checks.not_null(df, "k").count() == 2
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [("x", 2)]
    assert [tuple(r) for r in checks.accepted_values(df, "k", ["x"]).collect()] == [("y", 1)]
    assert [tuple(r) for r in checks.unique_combination(df, ["k", "n"]).collect()] == [("x", 1, 2)]
    parent = spark.createDataFrame([("y",), (None,)], "p string")
    orphans = checks.relationships(df, "k", parent, "p").collect()
    assert [tuple(r) for r in orphans] == [("x", 2)]
    assert checks.row_counts_match(df, df, df.where("false")).collect() == []
    assert [tuple(r) for r in checks.row_counts_match(df, df, df).collect()] == [(5, 5, 5)]
    pairs = checks.no_overlap(df, df, "k").collect()
    assert sorted(tuple(r) for r in pairs) == [("x", 4), ("y", 1)]


def test_checks_of_a_relation_need_one_scan_for_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select("id", F.lit("v").alias("v")).write.parquet(path)
    spec = {"t": checks.RelationChecks(not_null=["id", "v"])}
    result = checks.run_checks({"t": spark.read.parquet(path)}, spec)
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [tuple(r)[2:] for r in result.collect()] == [("id", 0), ("v", 0)]


def mart(spark):
    rows = [("b", "2024-01-01", "1.50"), ("a", "2024-01-01", "2.00"), ("Z", "2024-02-01", None)]
    df = spark.createDataFrame(rows, "partner string, month string, total_premium string")
    return df.select(
        "partner", F.col("month").cast("date"), F.col("total_premium").cast("decimal(31,2)")
    )


def test_report_as_one_ordered_file_on_demand(spark, tmp_path):
    for _ in range(2):
        path = export_report(mart(spark), str(tmp_path), single_file=True)
    assert path == f"{tmp_path}/{REPORT_NAME}"
    assert (tmp_path / REPORT_NAME).read_text().splitlines() == [
        "partner,month,total_premium", "Z,2024-02-01,", "a,2024-01-01,2.00", "b,2024-01-01,1.50",
    ]


def test_report_is_a_folder_in_order(spark, tmp_path):
    path = export_report(mart(spark), str(tmp_path))
    assert (tmp_path / REPORT_NAME).is_dir()
    rows = read_report(spark, path).orderBy("position").collect()
    assert [(r["position"], r["partner"]) for r in rows] == [(1, "Z"), (2, "a"), (3, "b")]


def test_views_and_export_by_name(spark, tmp_path):
    config = WarehouseConfig(str(tmp_path / "w"))
    relations = build_warehouse(spark, trusted(spark, SECOND), config)
    register(relations)
    publish_views(spark, config)
    try:
        accepted = read_relation(spark, "intermediate.premium_transactions")
        assert ids(accepted) == ["a", "d"]
        assert accepted.columns == relations["premium_transactions"].columns
        assert read_relation(spark, "staging.stg_premium__transactions").count() == 5
        path = export_monthly_report(
            spark, str(tmp_path / "gold"), "analytics.monthly_partner_premiums", single_file=True
        )
        with open(path, encoding="utf-8") as lines:
            assert lines.read().splitlines()[1:] == ["r,2024-03-01,5.00", "p,2024-01-01,10.00"]
        assert export_monthly_report(spark, str(tmp_path / "gold2"))
    finally:
        for schema in ("staging", "intermediate", "analytics"):
            spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def test_names_are_quoted_part_by_part(spark):
    assert quoted("main.sales . by month") == "`main`.`sales`.`by month`"
    assert quoted("odd`name") == "`odd``name`"
    for name in ("", "a..b", ".a"):
        with pytest.raises(ValueError, match="Not a relation name"):
            quoted(name)
    with pytest.raises(ValueError, match="does not exist"):
        read_relation(spark, "nothing here")
    spark.range(3).createOrReplaceTempView("three_rows")
    assert read_relation(spark, " three_rows ").count() == 3


def test_views_of_a_merged_warehouse_show_its_current_months(spark, tmp_path):
    config = WarehouseConfig(str(tmp_path / "w"), incremental="merge")
    layers = {"merged_layer": ("premium_transactions", "fct_transaction")}
    try:
        for rows in (FIRST, SECOND):
            relations = build_warehouse(spark, trusted(spark, rows), config)
            publish_views(spark, config, layers)
            view = read_relation(spark, "merged_layer.premium_transactions")
            assert ids(view) == ids(relations["premium_transactions"])
    finally:
        spark.sql("DROP SCHEMA IF EXISTS merged_layer CASCADE")


def test_published_views_follow_every_build(spark, tmp_path):
    config = WarehouseConfig(str(tmp_path))
    layers = {"followed": ("dim_partner", "premium_transactions", "stg_premium__transactions")}
    build_warehouse(spark, trusted(spark, FIRST), config)
    publish_views(spark, config, layers)
    try:
        for rows, partners in ((SECOND, ["p", "r"]), (FIRST, ["p", "q"]), (SECOND, ["p", "r"])):
            # More builds than versions are kept, and nobody publishes again.
            build_warehouse(spark, trusted(spark, rows), config)
            assert sorted(r["partner_name"] for r in read_relation(spark, "followed.dim_partner").collect()) == partners
            assert read_relation(spark, "followed.stg_premium__transactions").count() == len(rows)
    finally:
        unpublish_views(spark, config)
        spark.sql("DROP SCHEMA followed CASCADE")
    build_warehouse(spark, trusted(spark, FIRST), config)
    assert not spark.catalog.databaseExists("followed")
