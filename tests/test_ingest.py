"""Landing-file scenarios: what is read, what is rebuilt, what a crash leaves behind."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import fs
from ledgerspark.plans import ingest
from ledgerspark.plans.backfill import plan_backfill
from ledgerspark.plans.ingest import IngestConfig, plan_bronze, read_manifest, read_pending
from ledgerspark.sinks import months
from ledgerspark.sinks.runlog import read_run_log
from ledgerspark.sinks.tables import read_table, table_exists
from ledgerspark.sources import landing

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("created_at", T.StringType())]
)


class Feed:
    """A landing folder with its bronze, trusted and run-log folders."""

    def __init__(self, spark, root, **options):
        self.spark, self.root = spark, root
        self.landing = root / "landing"
        self.landing.mkdir()
        self.runs = str(root / "runs")
        options.setdefault("schema", SCHEMA)
        self.config = IngestConfig(
            landing_dir=str(self.landing),
            bronze_dir=str(root / "bronze"),
            trusted_dir=str(root / "trusted"),
            **options,
        )

    def put(self, name, rows):
        """Write [(id, created_at), ...] as a JSON array."""
        text = json.dumps([{"id": i, "created_at": c} for i, c in rows])
        return self.put_text(name, text)

    def put_text(self, name, text):
        path = self.landing / name
        path.write_text(text, encoding="utf-8")
        return path

    def bronze(self):
        return ingest.run_bronze(self.spark, self.config)

    def load(self):
        ingest.run_silver(self.spark, self.config, self.runs)
        return self.last_run()

    def last_run(self):
        log = read_run_log(self.spark, self.runs)
        return log.orderBy(F.desc("run_at")).first()

    def ids(self):
        rows = self.spark.read.parquet(self.config.bronze_dir).select("id").collect()
        return sorted(r["id"] for r in rows)

    def trusted_ids(self):
        rows = read_table(self.spark, self.config.trusted_dir).select("id").collect()
        return sorted(r["id"] for r in rows)

    def pending(self):
        rows = read_pending(self.spark, self.config).collect()
        return {(r["year"], r["month"]): r["days"] for r in rows}

    def names(self, frame):
        return sorted(os.path.basename(r["path"]) for r in frame.select("path").collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_new_file_in_an_existing_month_is_appended(feed):
    feed.put("premium_transaction_2031_07_04.json", [(1, "07/04/2031 08:00:00")])
    feed.bronze()
    feed.put("premium_transaction_2031_07_19.json", [(2, "07/19/2031 08:00:00")])
    plan = feed.bronze()
    assert feed.names(plan.unseen) == ["premium_transaction_2031_07_19.json"]
    assert feed.names(plan.reread) == []
    assert feed.ids() == [1, 2]
    assert feed.pending() == {(2031, 7): [4, 19]}


def test_corrected_file_rebuilds_its_month(feed):
    name = "premium_transaction_2031_07_04.json"
    for rows in ([(1, "07/04/2031 08:00:00"), (2, "07/05/2031 08:00:00")], [(3, "07/06/2031 08:00:00")]):
        feed.put(name, rows)
        plan = feed.bronze()
    assert plan.impacted == [203107]
    assert feed.ids() == [3]


def test_second_run_without_changes_parses_and_reads_nothing(feed, monkeypatch):
    for day in (11, 12):
        feed.put(f"premium_transaction_203108{day}.json", [(day, f"08/{day}/2031 00:00:00")])
    feed.bronze()

    def parsed(*args):
        raise AssertionError("an unchanged file was parsed")

    monkeypatch.setattr(landing, "_describe", parsed)
    plan = feed.bronze()
    assert (feed.names(plan.unseen), feed.names(plan.reread), plan.impacted) == ([], [], [])
    assert feed.ids() == [11, 12]


def test_payload_dates_beat_the_file_name(feed):
    feed.put(
        "premium_transaction_20310815.json",
        [(1, "12/31/2030 23:59:59"), (2, "01/01/2031 00:00:00")],
    )
    feed.bronze()
    assert feed.pending() == {(2030, 12): [31], (2031, 1): [1]}
    assert not os.path.exists(f"{feed.config.bronze_dir}/year=2031/month=8")


def test_file_without_a_date_in_its_name_uses_the_payload(feed):
    for row in ((1, "02/28/2031 01:00:00"), (2, "02/28/2031 02:00:00")):
        feed.put("premium_transactions_from_branch.json", [row])
        plan = feed.bronze()
    assert feed.names(plan.reread) == ["premium_transactions_from_branch.json"]
    assert feed.ids() == [2]


def test_changed_file_over_a_year_end_rereads_the_files_of_both_months(feed):
    wide, near, far = (f"premium_transaction_{x}.json" for x in ("wide", "near", "far"))
    feed.put(wide, [(1, "12/31/2030 20:00:00"), (2, "01/01/2031 04:00:00")])
    feed.put(near, [(3, "01/20/2031 00:00:00")])
    feed.put(far, [(4, "03/20/2031 00:00:00")])
    feed.bronze()
    feed.put(wide, [(5, "12/31/2030 20:00:00"), (6, "01/01/2031 04:00:00")])
    plan = feed.bronze()
    assert feed.names(plan.changed) == [wide]
    assert feed.names(plan.reread) == [near, wide]
    assert feed.ids() == [3, 4, 5, 6]


def test_late_copy_is_ignored_and_then_acknowledged(feed):
    rows = [(1, "05/09/2031 00:00:00")]
    feed.put("premium_transaction_20310509.json", rows)
    feed.bronze()
    feed.put("premium_transaction_resent_20310509.json", rows)
    plan = feed.bronze()
    assert feed.names(plan.unseen) == []
    assert feed.names(plan.ignored) == ["premium_transaction_resent_20310509.json"]
    assert feed.names(feed.bronze().ignored) == []
    assert feed.ids() == [1]


def test_copies_that_arrive_together_are_read_once(feed):
    names = [f"premium_transaction_{k}_20310509.json" for k in "abc"]
    for name in names:
        feed.put(name, [(1, "05/09/2031 00:00:00")])
    plan = feed.bronze()
    assert feed.names(plan.unseen) == names[:1]
    assert feed.names(plan.ignored) == names[1:]
    assert feed.ids() == [1]
    assert feed.names(read_manifest(feed.spark, feed.config)) == names


def test_copies_of_a_new_file_next_to_a_correction(feed):
    feed.put("premium_transaction_a_20310501.json", [(1, "05/01/2031 00:00:00")])
    feed.bronze()
    feed.put("premium_transaction_a_20310501.json", [(9, "05/01/2031 00:00:00")])
    for name in ("b", "b_again"):
        feed.put(f"premium_transaction_{name}_20310502.json", [(2, "05/02/2031 00:00:00")])
    plan = feed.bronze()
    assert feed.names(plan.ignored) == ["premium_transaction_b_again_20310502.json"]
    assert feed.ids() == [2, 9]


def test_copies_after_a_crash_of_the_first_run(feed, monkeypatch):
    for name in ("a", "b"):
        feed.put(f"premium_transaction_{name}_20310501.json", [(2, "05/01/2031 00:00:00")])

    def crash(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_save_manifest", crash)
    with pytest.raises(RuntimeError):
        feed.bronze()
    monkeypatch.undo()
    feed.bronze()
    assert feed.ids() == [2]


def test_rows_of_an_archived_file_survive_a_rebuild(feed):
    gone = feed.put("premium_transaction_a_20310501.json", [(1, "05/01/2031 00:00:00")])
    feed.put("premium_transaction_copy_20310501.json", [(1, "05/01/2031 00:00:00")])
    feed.put("premium_transaction_b_20310502.json", [(2, "05/02/2031 00:00:00")])
    feed.bronze()
    gone.unlink()
    for row in (3, 4):
        feed.put("premium_transaction_b_20310502.json", [(row, "05/02/2031 00:00:00")])
        feed.bronze()
        assert feed.ids() == [1, row]


def test_ignored_copy_stays_ignored_in_a_rebuild(feed):
    rows = [(1, "03/06/2025 00:00:00")]
    feed.put("premium_transactions_data_20250306.json", rows)
    feed.put("premium_transactions_data_20250306_copy.json", rows)
    feed.put("premium_transactions_data_20250307.json", [(2, "03/07/2025 00:00:00")])
    feed.bronze()
    feed.put("premium_transactions_data_20250307.json", [(3, "03/07/2025 00:00:00")])
    feed.bronze()
    assert feed.ids() == [1, 3]


def test_unchanged_file_keeps_rows_outside_the_rebuilt_month_once(feed):
    feed.put("premium_transaction_a_20250101.json", [(1, "01/05/2025 00:00:00")])
    feed.put(
        "premium_transaction_b_20250101.json",
        [(2, "01/06/2025 00:00:00"), (3, "02/06/2025 00:00:00")],
    )
    feed.bronze()
    feed.put("premium_transaction_a_20250101.json", [(4, "01/05/2025 00:00:00")])
    feed.bronze()
    assert feed.ids() == [2, 3, 4]


def test_month_that_left_a_changed_file_is_cleared(feed):
    feed.put(
        "premium_transaction_20250101.json",
        [(1, "01/05/2025 00:00:00"), (2, "02/05/2025 00:00:00")],
    )
    feed.bronze()
    feed.put("premium_transaction_20250101.json", [(1, "01/05/2025 00:00:00")])
    plan = feed.bronze()
    assert plan.impacted == [202501, 202502]
    assert feed.ids() == [1]
    assert feed.pending() == {(2025, 1): [5], (2025, 2): []}


def test_rows_without_event_time_survive_a_rebuild(feed):
    feed.put("premium_transaction_a_20250101.json", [(1, "01/05/2025 00:00:00"), (2, None)])
    feed.put("premium_transaction_b_20250101.json", [(3, "01/06/2025 00:00:00"), (4, None)])
    feed.bronze()
    assert (None, None) in feed.pending()
    feed.put("premium_transaction_a_20250101.json", [(5, "01/05/2025 00:00:00"), (6, None)])
    plan = feed.bronze()
    assert plan.impacted == [0, 202501]
    assert feed.ids() == [3, 4, 5, 6]
    feed.load()
    assert feed.trusted_ids() == [3, 4, 5, 6]


def test_bad_payload_value_falls_back_to_the_name_and_then_fails_strictly(feed):
    feed.put(
        "premium_transaction_2025_03_01.json",
        [(1, "03/01/2025 00:00:00"), (2, "yesterday")],
    )
    plan = plan_bronze(feed.spark, feed.config)
    assert plan.unseen.select("file_date", "months").collect() == [(20250301, [202503])]
    with pytest.raises(Exception, match="yesterday"):
        feed.bronze()
    assert read_manifest(feed.spark, feed.config).count() == 0


def test_file_without_any_date_is_an_error(feed):
    feed.put("premium_transaction_feed.json", [(1, None)])
    with pytest.raises(Exception, match="No parseable date"):
        feed.bronze()


def test_missing_landing_folder_is_an_error(spark, tmp_path):
    config = IngestConfig(str(tmp_path / "none"), str(tmp_path / "b"), str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        ingest.run_bronze(spark, config)


def test_other_names_are_not_listed(feed):
    for name in ("Premium_transaction_20250101.json", "premium_20250101.json",
                 "premium_transaction_20250101.csv"):
        feed.put(name, [(1, "01/01/2025 00:00:00")])
    assert landing.list_files(feed.spark, str(feed.landing)).count() == 0
    feed.bronze()
    assert feed.load()["skip_reason"] == "no_pending_bronze_partitions"


def test_single_object_file(feed):
    feed.put_text(
        "premium_transaction_20250101.json", '{"id": 7, "created_at": "01/09/2025 00:00:00"}'
    )
    feed.bronze()
    assert feed.pending() == {(2025, 1): [9]}
    assert feed.ids() == [7]


def test_first_schema_is_inferred_then_kept(spark, tmp_path):
    feed = Feed(spark, tmp_path, schema=None)
    feed.put("premium_transaction_20250101.json", [(1, "01/01/2025 00:00:00")])
    feed.bronze()
    feed.put_text(
        "premium_transaction_20250102.json",
        '[{"id": 2, "created_at": "01/02/2025 00:00:00", "extra": 1}]',
    )
    feed.bronze()
    assert feed.ids() == [1, 2]
    assert "extra" not in spark.read.parquet(feed.config.bronze_dir).columns
    feed.put_text(
        "premium_transaction_20250103.json",
        '[{"id": "text", "created_at": "01/03/2025 00:00:00"}]',
    )
    with pytest.raises(Exception):
        feed.bronze()


def test_trust_mtime_opens_only_files_that_look_different(spark, tmp_path):
    feed = Feed(spark, tmp_path, trust_mtime=True)
    first = feed.put("premium_transaction_20250101.json", [(1, "01/01/2025 00:00:00")])
    feed.bronze()
    stamp = first.stat().st_mtime_ns
    feed.put("premium_transaction_20250101.json", [(2, "01/01/2025 00:00:00")])
    os.utime(first, ns=(stamp, stamp))
    assert feed.bronze().impacted == []
    os.utime(first, ns=(stamp, stamp + 2_000_000_000))
    assert feed.bronze().impacted == [202501]
    assert feed.ids() == [2]


def test_default_sees_a_change_that_keeps_size_and_time(feed):
    first = feed.put("premium_transaction_20250101.json", [(1, "01/01/2025 00:00:00")])
    feed.bronze()
    stamp = first.stat().st_mtime_ns
    feed.put("premium_transaction_20250101.json", [(2, "01/01/2025 00:00:00")])
    os.utime(first, ns=(stamp, stamp))
    feed.bronze()
    assert feed.ids() == [2]


def test_load_writes_the_table_then_clears_pending(feed):
    feed.put("premium_transaction_20250101.json", [(1, "01/01/2025 00:00:00")])
    feed.bronze()
    run = feed.load()
    assert (run["silver_status"], run["rows_written"], run["months"]) == (
        "completed", 1, [202501],
    )
    assert feed.pending() == {}
    again = feed.load()
    assert again["was_skipped"] and again["skip_reason"] == "no_pending_bronze_partitions"
    assert feed.trusted_ids() == [1]


def test_pending_survives_a_failing_run_log(feed, monkeypatch):
    feed.put("premium_transaction_20250101.json", [(1, "01/01/2025 00:00:00")])
    feed.bronze()

    def fail(*args):
        raise OSError("disk full")

    monkeypatch.setattr(ingest, "append_run", fail)
    with pytest.raises(OSError):
        feed.load()
    assert feed.pending() == {(2025, 1): [1]}
    monkeypatch.undo()
    # New data before the retry must not push the older month out of pending.
    feed.put("premium_transaction_20250201.json", [(2, "02/01/2025 00:00:00")])
    feed.bronze()
    assert feed.pending() == {(2025, 1): [1], (2025, 2): [1]}
    feed.load()
    assert feed.trusted_ids() == [1, 2]


@pytest.mark.parametrize("step", ["_write_bronze", "_add_pending", "_save_manifest"])
def test_crash_after_a_bronze_step_is_repaired_by_the_next_run(feed, monkeypatch, step):
    feed.put("premium_transaction_a_20250101.json", [(1, "01/05/2025 00:00:00")])
    feed.put("premium_transaction_b_20250101.json", [(2, "02/05/2025 00:00:00")])
    feed.bronze()
    feed.put("premium_transaction_a_20250101.json", [(3, "01/05/2025 00:00:00")])
    feed.put(
        "premium_transaction_c_20250301.json",
        [(4, "02/06/2025 00:00:00"), (5, "03/01/2025 00:00:00")],
    )
    original = getattr(ingest, step)

    def crash(*args):
        original(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, step, crash)
    with pytest.raises(RuntimeError):
        feed.bronze()
    monkeypatch.undo()
    feed.bronze()
    assert feed.ids() == [2, 3, 4, 5]
    assert set(feed.pending()) >= {(2025, 1), (2025, 2), (2025, 3)}
    assert not fs.exists(feed.spark, feed.config.state("write_in_progress.json"))


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_other_write_modes_read_only_pending_months(spark, tmp_path, mode):
    feed = Feed(spark, tmp_path, write_mode=mode, merge_keys=["id"])
    feed.put("premium_transaction_20250101.json", [(1, "01/01/2025 00:00:00")])
    feed.bronze()
    feed.load()
    feed.put("premium_transaction_20250201.json", [(2, "02/01/2025 00:00:00")])
    feed.bronze()
    assert feed.load()["rows_written"] == 1
    assert feed.trusted_ids() == [1, 2]
    # A second file of February makes the whole month pending again.
    feed.put("premium_transaction_20250202.json", [(3, "02/02/2025 00:00:00")])
    feed.bronze()
    feed.load()
    assert feed.trusted_ids() == [1, 2, 3]


def test_gaps_of_pending_months(feed):
    feed.put("premium_transaction_20280201.json",
             [(i, f"02/{i:02d}/2028 00:00:00") for i in range(3, 28)])
    feed.bronze()
    gaps = ingest.pending_gaps(feed.spark, feed.config, date(2028, 3, 1)).collect()
    assert gaps == [(2028, 2, [1, 2, 28, 29])]


def test_nothing_written_without_files(feed):
    feed.bronze()
    assert not table_exists(feed.spark, feed.config.state("manifest"))


def test_file_names_with_pattern_characters_and_spaces(feed):
    name = "premium_transaction_[1] {a}%20 20250101*.json"
    feed.put(name, [(1, "01/01/2025 00:00:00")])
    feed.put("premium_transaction_1 a%20 20250102x.json", [(2, "01/02/2025 00:00:00")])
    plan = feed.bronze()
    assert name in feed.names(plan.unseen)
    assert feed.ids() == [1, 2]
    feed.put(name, [(3, "01/01/2025 00:00:00")])
    assert len(feed.names(feed.bronze().reread)) == 2
    assert feed.ids() == [2, 3]


def test_backfill_plan_from_bronze_and_run_log(feed):
    feed.put("premium_transaction_20240601.json",
             [(1, "06/01/2024 00:00:00"), (2, "09/01/2024 00:00:00"), (3, None)])
    feed.bronze()
    feed.load()
    plan = plan_backfill(feed.spark, "2024-06", "2024-08", feed.config.bronze_dir, feed.runs)
    found = {}
    for row in plan.collect():
        found.setdefault(row["status"], []).append(row["month"])
    assert {k: sorted(v) for k, v in found.items()} == {
        "requested": ["2024-06", "2024-07", "2024-08"],
        "available": ["2024-06", "2024-09"],
        "selected": ["2024-06"],
        "not_available": ["2024-07", "2024-08"],
        "latest_loaded": ["2024-06", "2024-09"],
    }


def test_new_file_equal_to_a_changed_file_is_a_copy(feed):
    feed.put("premium_transaction_a_20250101.json", [(1, "01/05/2025 00:00:00")])
    feed.bronze()
    corrected = [(2, "01/05/2025 00:00:00")]
    feed.put("premium_transaction_a_20250101.json", corrected)
    feed.put("premium_transaction_b_20250101.json", corrected)
    plan = feed.bronze()
    assert feed.names(plan.ignored) == ["premium_transaction_b_20250101.json"]
    assert feed.ids() == [2]
    # Two known files that become equal are read once as well.
    feed.put("premium_transaction_c_20250101.json", [(3, "01/06/2025 00:00:00")])
    feed.bronze()
    feed.put("premium_transaction_c_20250101.json", corrected)
    feed.bronze()
    assert feed.ids() == [2]


def test_removed_copy_of_an_original_keeps_its_rows(feed):
    """The copy was ignored, so bronze has no rows of it: it holds nothing."""
    rows = [(1, "05/01/2031 00:00:00")]
    feed.put("premium_transaction_a_20310501.json", rows)
    copies = [feed.put(f"premium_transaction_a_copy{k}_20310501.json", rows) for k in range(2)]
    feed.put("premium_transaction_b_20310502.json", [(2, "05/02/2031 00:00:00")])
    feed.bronze()
    for row, copy in zip((99, 100), copies):
        copy.unlink()
        feed.put("premium_transaction_b_20310502.json", [(row, "05/02/2031 00:00:00")])
        feed.bronze()
        assert feed.ids() == [1, row]


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_renamed_original_and_its_copies_are_loaded_once(spark, tmp_path, mode):
    feed = Feed(spark, tmp_path, write_mode=mode)
    rows = [(1, "05/01/2031 00:00:00"), (2, "06/01/2031 00:00:00")]
    first = feed.put("premium_transaction_m_20310501.json", rows)
    other = feed.put("premium_transaction_b_20310502.json", [(3, "05/02/2031 00:00:00")])
    feed.bronze()
    feed.load()
    # Sorts before the original, and stays when that goes.
    feed.put("premium_transaction_c_20310501.json", rows)
    feed.bronze()
    for k, day in enumerate(("05/03", "06/02")):
        if k:
            first.unlink()
        other.unlink()
        other = feed.put(f"premium_transaction_b{k}_20310502.json", [(3, f"{day}/2031 00:00:00"), (4 + k, f"{day}/2031 00:00:00")])
        feed.bronze()
        feed.load()
    # Files that left keep their rows; the copied content is there once.
    assert feed.ids() == [1, 2, 3, 3, 3, 4, 5]
    assert feed.trusted_ids() == [1, 2, 3, 3, 3, 4, 5]


def test_corrected_file_that_becomes_a_copy_of_an_archived_one(feed):
    gone = feed.put("premium_transaction_a_20310501.json", [(1, "05/01/2031 00:00:00")])
    feed.put("premium_transaction_b_20310502.json", [(2, "05/02/2031 00:00:00")])
    feed.bronze()
    text = gone.read_text()
    gone.unlink()
    feed.put_text("premium_transaction_b_20310502.json", text)
    feed.bronze()
    assert feed.ids() == [1]


def test_files_are_read_by_ranges(spark, tmp_path):
    feed = Feed(spark, tmp_path, range_bytes=100)
    rows = [(k, f"05/{1 + k % 28:02d}/2031 00:00:00") for k in range(40)]
    feed.put("premium_transaction_a.json", rows)
    feed.put("premium_transaction_b.json", [(99, "06/01/2031 00:00:00")])
    plan = feed.bronze()
    assert plan.scans.count() > 15
    assert feed.ids() == [*range(40), 99]
    state = {os.path.basename(r["path"]): r for r in read_manifest(feed.spark, feed.config).collect()}
    assert state["premium_transaction_a.json"]["months"] == [203105]
    assert state["premium_transaction_a.json"]["file_date"] == 20310501
    feed.put("premium_transaction_a.json", rows[:39])
    assert feed.names(feed.bronze().changed) == ["premium_transaction_a.json"]
    assert feed.ids() == [*range(39), 99]


def test_malformed_file_changes_nothing(feed):
    feed.put("premium_transaction_a_20310501.json", [(1, "05/01/2031 00:00:00")])
    feed.bronze()
    feed.put_text("premium_transaction_b_20310501.json", '[{"id": 2, "created_at": "05/01/2031 00:00:00"},')
    with pytest.raises(Exception, match="not a JSON array"):
        feed.bronze()
    assert feed.ids() == [1]


def test_schema_grows_with_the_files(spark, tmp_path):
    feed = Feed(spark, tmp_path, evolve_schema=True)
    feed.put("premium_transaction_a.json", [(1, "05/01/2031 00:00:00")])
    feed.bronze()
    feed.load()
    feed.put_text(
        "premium_transaction_b.json",
        '[{"id": 2, "created_at": "05/02/2031 00:00:00", "channel": "web", "rate": 1.5, "none": null},'
        ' {"id": 3, "created_at": "06/01/2031 00:00:00", "rate": 2, "more": {"x": [1]}}]',
    )
    feed.bronze()
    feed.load()
    # A rebuild keeps the values of both.
    feed.put("premium_transaction_a.json", [(9, "05/01/2031 00:00:00")])
    feed.bronze()
    feed.load()
    rows = read_table(spark, feed.config.trusted_dir).orderBy("id").collect()
    assert [(r["id"], r["channel"], r["rate"]) for r in rows] == [(2, "web", 1.5), (3, None, 2.0), (9, None, None)]
    assert "none" not in rows[0].asDict() and '"x"' in rows[1]["more"]
    feed.put_text("premium_transaction_c.json", '[{"id": "text", "created_at": "06/01/2031 00:00:00"}]')
    with pytest.raises(Exception, match="id .string for bigint"):
        feed.bronze()


def test_a_rebuild_writes_each_row_once(feed, monkeypatch):
    """staged files become those of bronze; rows of other months stay as they are."""
    feed.put("premium_transaction_a.json", [(1, "05/01/2031 00:00:00"), (2, "06/01/2031 00:00:00")])
    feed.put("premium_transaction_b.json", [(3, "05/02/2031 00:00:00"), (4, "07/01/2031 00:00:00")])
    feed.put("premium_transaction_c.json", [(5, "05/03/2031 00:00:00")])
    feed.bronze()
    (feed.landing / "premium_transaction_c.json").unlink()
    july = fs.glob(feed.spark, f"{feed.config.bronze_dir}/year=2031/month=7/*")
    feed.put("premium_transaction_a.json", [(6, "05/01/2031 00:00:00"), (7, None)])
    feed.put("premium_transaction_d.json", [(8, "05/04/2031 00:00:00"), (9, "08/01/2031 00:00:00"), (10, "07/01/2031 00:00:00")])
    write, roots = months._write, []
    monkeypatch.setattr(months, "_write", lambda df, root, *args: roots.append(root) or write(df, root, *args))
    feed.bronze()
    assert roots and feed.config.bronze_dir not in roots
    assert feed.ids() == [3, 4, 5, 6, 7, 8, 9, 10]
    assert set(july) < set(fs.glob(feed.spark, f"{feed.config.bronze_dir}/year=2031/month=7/*"))
    assert not fs.exists(feed.spark, f"{feed.config.bronze_dir}/year=2031/month=6")
    assert set(feed.pending()) == {(2031, 5), (2031, 6), (2031, 7), (2031, 8), (None, None)}
