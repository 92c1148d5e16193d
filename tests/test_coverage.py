"""Coverage, planning, run summaries and schema drift."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators import coverage
from ledgerspark.operators import manifest as m
from ledgerspark.schema import RAW_SCHEMA, load_schema, save_schema, schema_drift, storable
from ledgerspark.sinks.runlog import append_run, read_run_log, run_record


def months(spark, names):
    return spark.createDataFrame([(n,) for n in names], "n string").select(
        F.to_date(F.concat("n", F.lit("-01"))).alias("month")
    )


def test_missing_days_of_a_leap_february_and_of_the_running_month(spark):
    february = [(2028, 2, d) for d in range(1, 30) if d not in (7, 29)]
    december = [(2027, 12, 30), (2027, 12, 31)]
    rows = [*february, *december, (2028, 3, 2), (None, None, 4)]
    index = coverage.day_coverage(spark.createDataFrame(rows, "year int, month int, day int"))
    found = coverage.missing_days(index, dt.date(2028, 3, 3)).collect()
    gaps = {(r["year"], r["month"]): r["missing_days"] for r in found}
    assert gaps == {(2028, 2): [7, 29], (2027, 12): list(range(1, 30)), (2028, 3): [1, 3]}


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2027-12", "2028-01", ["2027-12-01", "2028-01-01"]),
        ("2028-02", "2028-02", ["2028-02-01"]),
    ],
)
def test_month_range(spark, start, end, expected):
    found = coverage.month_range(spark, start, end).collect()
    assert [str(r["month"]) for r in found] == expected


@pytest.mark.parametrize(("start", "end"), [("2028-00", "2028-01"), ("2028/01", "2028-01"), ("2028-02", "2028-01")])
def test_month_range_refuses_what_is_no_range(spark, start, end):
    with pytest.raises(ValueError):
        coverage.month_range(spark, start, end)


def by_status(plan):
    found = {}
    for row in plan.collect():
        found.setdefault(row["status"], set()).add(row["month"])
    return found


def test_backfill_plan_over_a_year_end(spark):
    plan = coverage.backfill_plan(
        coverage.month_range(spark, "2027-11", "2028-01"),
        months(spark, ["2027-12", "2028-05"]),
        months(spark, ["2027-11"]),
    )
    assert by_status(plan) == {
        "requested": {"2027-11", "2027-12", "2028-01"},
        "available": {"2027-12", "2028-05"},
        "selected": {"2027-12"},
        "not_available": {"2027-11", "2028-01"},
        "latest_loaded": {"2027-11"},
    }


def test_backfill_plan_without_any_month_at_hand(spark):
    plan = coverage.backfill_plan(
        coverage.month_range(spark, "2028-02", "2028-02"), months(spark, []), months(spark, [])
    )
    assert by_status(plan) == {"requested": {"2028-02"}, "not_available": {"2028-02"}}


def test_run_log_and_summary(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert read_run_log(spark, root).count() == 0
    common = {"table_name": "t", "write_mode": "replace"}
    append_run(run_record(spark, status="completed", rows_written=7, months=[202406], **common), root)
    append_run(run_record(spark, status="completed", rows_written=-1, months=[202407, 0, 202413], **common), root)
    loaded = coverage.loaded_months(read_run_log(spark, root)).collect()
    assert [str(r["month"]) for r in loaded] == ["2024-07-01"]
    append_run(run_record(spark, status="completed", rows_written=0, **common), root)
    append_run(run_record(spark, status="skipped", skip_reason="x", **common), root)
    summary = coverage.run_summary(read_run_log(spark, root)).orderBy("run_at").collect()
    assert [r["has_new_data"] for r in summary] == [True, True, False, False]
    assert coverage.loaded_months(read_run_log(spark, root)).count() == 0


def test_schema_is_stored_and_compared(spark, tmp_path):
    path = str(tmp_path / "schema.json")
    assert load_schema(spark, path) is None
    save_schema(spark, path, RAW_SCHEMA)
    assert load_schema(spark, path) == RAW_SCHEMA
    observed = T.StructType(
        [f for f in RAW_SCHEMA.fields if f.name not in ("status", "amount")]
        + [T.StructField("amount", T.StringType()), T.StructField("x", T.LongType())]
    )
    drift = schema_drift(RAW_SCHEMA, observed, spark).collect()
    assert sorted((r["field"], r["status"]) for r in drift) == [
        ("amount", "retyped"), ("status", "missing"), ("x", "added"),
    ]
    nested = T.StructType([T.StructField("a", T.ArrayType(T.LongType())), T.StructField("b", T.LongType())])
    assert storable(nested).simpleString() == "struct<a:string,b:bigint>"


def files(spark, rows):
    """(path, digest, file_date, months[, size])"""
    full = [
        (p, size[0] if size else 1, dt.datetime(2024, 1, 1), d, when, months)
        for p, d, when, months, *size in rows
    ]
    return spark.createDataFrame(full, m.STATE_DDL)


def paths(df):
    return sorted(r["path"] for r in df.collect())


def test_first_copy_wins_by_date_then_path(spark):
    listing = files(
        spark,
        [("b", "x", 20240101, []), ("a", "x", 20240102, []), ("c", "x", 20240101, []),
         ("n1", None, 20240101, []), ("n2", None, 20240101, [])],
    )
    assert paths(m.first_copies(listing)) == ["b", "n1", "n2"]


def test_change_detection_uses_digests_when_both_are_known(spark):
    old = files(
        spark,
        [("same", "x", 1, [], 1), ("touched", "x", 1, [], 2), ("edited", "x", 1, []),
         ("blind", None, 1, []), ("grown", None, 1, [], 5), ("gone", "g", 1, [])],
    )
    now = files(
        spark,
        [("same", "x", 1, []), ("touched", "x", 1, []), ("edited", "y", 1, []),
         ("blind", "z", 1, []), ("grown", "w", 1, [])],
    )
    assert paths(m.changed_files(now, old)) == ["edited", "grown"]
    merged = {r["path"]: r["content_digest"] for r in m.merge_manifest(old, now).collect()}
    assert merged == {"same": "x", "touched": "x", "edited": "y", "blind": "z", "grown": "w", "gone": "g"}


def test_old_content_of_a_changed_file_is_still_known(spark):
    old = files(spark, [("a", "x", 1, [])])
    now = files(spark, [("a", "y", 1, []), ("copy_of_old", "x", 1, []), ("fresh", "z", 1, [])])
    unseen = m.unseen_files(now, old)
    assert paths(unseen) == ["fresh"]
    assert paths(m.ignored_duplicates(now, old, unseen)) == ["copy_of_old"]


def test_bits_say_what_the_month_lists_say(spark):
    """Random feeds, one of them null: the plans from bits are those of each feed by itself."""
    rng = random.Random(5)
    months = [dt.date(2019 + k // 12, 1 + k % 12, 1) for k in range(40)]
    spans, lists = [], {"available": [], "loaded": []}
    for feed in ("a", "b", "c", None):
        first, last = sorted(rng.choices(range(40), k=2))
        spans.append((feed, months[first], months[last]))
        for rows in lists.values():
            # Any day of a month, and repeated ones, count for the month.
            rows += [(feed, m.replace(day=rng.randint(1, 28))) for m in rng.choices(months, k=25)]
            rows.append((feed, None))
    spans.append(("reversed", months[5], months[2]))
    frames = {k: spark.createDataFrame(v, "feed string, month date") for k, v in lists.items()}
    ranges = spark.createDataFrame(spans, "feed string, first date, last date")
    bits = {k: coverage.month_bits(v, "feed") for k, v in frames.items()}
    found = coverage.backfill_plans(coverage.range_bits(ranges, "feed"), bits["available"], bits["loaded"])
    got = sorted(map(tuple, found.collect()), key=repr)
    expected = []
    for feed, first, last in spans:
        sides = [
            v.where(F.col("feed").eqNullSafe(feed) & F.col("month").isNotNull()).select(F.trunc("month", "MM").alias("month")).distinct()
            for v in frames.values()
        ]
        asked = ranges.where(F.col("feed").eqNullSafe(feed)).select(
            F.explode(coverage.months_between(F.col("first"), F.col("last"))).alias("month")
        )
        plan = coverage.backfill_plan(asked, sides[0], sides[1])
        expected += [(feed, r["status"], r["month"]) for r in plan.collect()]
    assert got == sorted(expected, key=repr) and ("reversed", "requested") not in {x[:2] for x in got}
    assert sorted(r["month"] for r in coverage.months_of_bits(bits["available"]).where("feed = 'a'").collect()) == sorted(
        {m.replace(day=1) for f, m in lists["available"] if f == "a" and m}
    )
    empty = spark.createDataFrame([], "feed string, month date")
    none = coverage.month_bits(empty, "feed")
    assert coverage.backfill_plans(none, none, none).count() == 0
