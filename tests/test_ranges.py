"""Digests and records of files that are read by byte ranges."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators import manifest
from ledgerspark.schema import evolved
from ledgerspark.sources import landing, ranges
from ledgerspark.testbed import queries
from ledgerspark.testbed import queries
from ledgerspark.testbed.queries import write_landing, write_landing_file


class Memory:
    def __init__(self, data):
        self.data = data

    def read_at(self, length, offset):
        return self.data[offset : offset + length]


def split(data, step):
    """Records of an array cut every ``step`` bytes, with the running sums done by hand."""
    found, quotes, depth = [], 0, 0
    for k in range(max(1, -(-len(data) // step))):
        offset, length = k * step, min(step, len(data) - k * step)
        _, own, outside, inside = ranges._scan(Memory(data), offset, length)
        found += ranges._records(Memory(data), len(data), offset, length, bool(quotes % 2), depth)
        depth += inside if quotes % 2 else outside
        quotes += own
    return found


def some_value(rng, deep=0):
    kind = rng.randrange(8 if deep < 3 else 5)
    if kind == 2:
        return "".join(rng.choice('ab"\\{}[],: \n\té漢😀') for _ in range(rng.randrange(12)))
    if kind == 5:
        return [some_value(rng, deep + 1) for _ in range(rng.randrange(3))]
    if kind > 5:
        return {"k" + "\\" * rng.randrange(3) + str(i): some_value(rng, deep + 1) for i in range(rng.randrange(4))}
    return [rng.randrange(1000), None, "", "\\" * rng.randrange(9), rng.random()][kind]


@pytest.mark.parametrize("seed", range(4))
def test_arrays_split_anywhere(seed):
    rng = random.Random(seed)
    for _ in range(150):
        records = [{f"f{i}": some_value(rng) for i in range(rng.randrange(4))} for _ in range(rng.randrange(7))]
        text = json.dumps(records, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1, 4]))
        data = (rng.choice(["", " \n", "\ufeff"]) + text + rng.choice(["", " \n "])).encode()
        for step in (1, 2, 3, 7, rng.randrange(1, 60), 10**6):
            assert [json.loads(x) for x in split(data, step)] == records


def test_one_object_and_nothing():
    one = {"a": [1, {"b": "}"}]}
    for step in (1, 4, 100):
        assert [json.loads(x) for x in split(f" {json.dumps(one)}\n".encode(), step)] == [one]
        assert split(b"", step) == split(b" \n ", step) == split(b"[ ]", step) == []


@pytest.mark.parametrize(
    "text",
    ['[{"a":1} {"a":2}]', '[{"a":1},]', '[,{"a":1}]', '[{"a":1},,{"a":2}]', '[{"a":1}', '[{"a":1}]]',
     '[{"a":"x]', "[1,2]", "[[1]]", '{"a":1}{"b":2}', '[{"a":1}]{"b":2}', '[{"a":1}}', '["x"]', "x", "[null]",
     '{"a":1', '[{"a":1}],'],
)
def test_malformed_arrays_are_refused_however_they_are_split(text):
    for step in (1, 3, 1000):
        with pytest.raises(ranges._Malformed):
            split(text.encode(), step)


def tree(data, step):
    nodes = [hashlib.sha256(data[a : a + step]).hexdigest() for a in range(0, max(1, len(data)), step)]
    while len(nodes) > 1:
        groups = [nodes[a : a + ranges.FAN] for a in range(0, len(nodes), ranges.FAN)]
        nodes = [g[0] if len(g) == 1 else hashlib.sha256(("node " + "".join(g)).encode()).hexdigest() for g in groups]
    return nodes[0]


def test_digest_tree_does_not_depend_on_other_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "FAN", 4)
    rng = random.Random(1)
    sizes = {"one": 10, "full": 16, "two": 17, "five": 80, "many": 1000, "copy": 1000}
    texts = {name: rng.randbytes(size) for name, size in sizes.items()}
    texts["copy"] = texts["many"]
    for name, data in texts.items():
        (tmp_path / f"premium_transaction_{name}.json").write_bytes(data)
    files = landing.list_files(spark, str(tmp_path))
    scans = ranges.scan_ranges(files, 16)
    assert scans.count() == sum(max(1, -(-n // 16)) for n in sizes.values())
    found = {
        r["path"].rsplit("_", 1)[1][:-5]: r["content_digest"] for r in ranges.file_digests(scans).collect()
    }
    assert found == {name: tree(data, 16) for name, data in texts.items()}
    assert found["one"] == hashlib.sha256(texts["one"]).hexdigest()
    assert found["many"] == found["copy"] != found["two"]


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"id": k, "text": f'q"{k}\\ [{{' * (k % 50)} for k in range(3000)]
    (tmp_path / "premium_transaction_all.json").write_text(json.dumps(rows))
    scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path)), 10_000)
    assert scans.rdd.getNumPartitions() > 20
    read = landing.read_records(scans, landing.T.StructType.fromDDL("id bigint, text string"), 10_000)
    assert read.rdd.getNumPartitions() > 20
    found = read.orderBy("id").collect()
    assert [(r["id"], r["text"]) for r in found] == [(r["id"], r["text"]) for r in rows]
    assert {r["source_file"] for r in found} == {f"file:{tmp_path}/premium_transaction_all.json"}


def test_values_of_another_type_fail(spark, tmp_path):
    (tmp_path / "premium_transaction_1.json").write_text('[{"id": 1}, {"id": "text"}]')
    scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path)))
    with pytest.raises(Exception):
        landing.read_records(scans, landing.T.StructType.fromDDL("id bigint")).collect()


def test_no_files(spark, tmp_path):
    scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path)))
    assert scans.count() == ranges.file_digests(scans).count() == ranges.json_records(scans).count() == 0


def test_record_coverage_equals_file_coverage(spark):
    cases = {
        "premium_2031_01_02.json": ["02/03/2031 00:00:00", " ", None],
        "premium_2031_01_03.json": ["02/03/2031 00:00:00", "soon"],
        "premium_2031_01_04.json": [],
        "premium_2031_01_05.json": ["2031-05-06", "2030-12-31T23:00:00", "03/01/2031 10:11"],
        "premium_2031_01_06.json": [None, None],
    }
    files = spark.createDataFrame([(p,) for p in cases], "path string")
    arrays = spark.createDataFrame(list(cases.items()), "path string, values array<string>")
    records = arrays.select("path", F.explode("values").alias("value"))
    by_file = manifest.add_file_coverage(arrays, "values")
    by_record = manifest.add_record_coverage(files, records, "value")
    assert sorted(map(tuple, by_file.collect())) == sorted(map(tuple, by_record.collect()))


def test_positions_in_source_order(spark):
    rows = [(f"p{k % 7}{k}", 20240101 + k * 37 % 9) for k in range(200)]
    df = spark.createDataFrame(rows, "path string, file_date int").repartition(5)
    found = [(r["path"], r["file_date"]) for r in landing.with_positions(df).orderBy("position").collect()]
    assert found == sorted(rows, key=lambda r: (r[1], r[0]))
    assert sorted(r["position"] for r in landing.with_positions(df).collect()) == list(range(1, 201))


def test_small_ranges_share_tasks_and_are_scanned_once(spark, tmp_path):
    (tmp_path / "premium_transaction_all.json").write_text(json.dumps([{"id": k} for k in range(20_000)]))
    scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path)), 500)
    most = max(32, 2 * spark.sparkContext.defaultParallelism)
    assert scans.count() > 400 and scans.rdd.getNumPartitions() <= most
    records = ranges.json_records(scans, 500)
    assert records.rdd.getNumPartitions() <= most
    # The states are stored: the records are read without another scan of the ranges.
    assert records._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert records.count() == 20_000


def test_one_landing_file_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "'[\"' || id AS text").repartition(7)
    write_landing_file(rows, f"{tmp_path}/in", copies=2)
    one, two = sorted((tmp_path / "in").glob("part-*.txt"))
    assert one.read_bytes() == two.read_bytes()
    found = json.loads(one.read_text())
    assert sorted(r["id"] for r in found) == list(range(5000)) and found[0].keys() == {"id", "text"}


def test_lines_of_a_landing_file_take_a_part_of_its_size(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "'an amount' AS text").repartition(3).where("id % 7 > 0 OR id < 9")
    lines = queries._write_lines(rows.unionByName(rows.limit(0)), f"{tmp_path}/lines")
    write_landing_file(rows, f"{tmp_path}/in")
    (one,) = (tmp_path / "in").glob("part-*.txt")
    assert len(json.loads(one.read_text())) == rows.count()
    assert 3 * sum(path.stat().st_size for path in (tmp_path / "lines").glob("part-*")) < one.stat().st_size
    queries._join_lines(lines, f"{tmp_path}/joined")
    assert sorted(json.loads((tmp_path / "joined").read_text()), key=str) == sorted(json.loads(one.read_text()), key=str)
    write_landing_file(rows.limit(0), f"{tmp_path}/none", copies=2)
    assert [path.read_bytes() for path in (tmp_path / "none").glob("part-*.txt")] == [b"", b""]


def test_landing_files_hold_what_was_written(spark, tmp_path):
    rows = spark.range(30_000).selectExpr("id", "'a,\\n[\"' || id AS text").repartition(3)
    write_landing(rows, f"{tmp_path}/in")
    found = [r for path in (tmp_path / "in").glob("part-*.txt") for r in json.loads(path.read_text())]
    assert sorted((r["id"], r["text"]) for r in found) == sorted(map(tuple, rows.collect()))


def test_fields_read_by_arrow_are_those_that_spark_reads(spark, tmp_path):
    schema = landing.T.StructType.fromDDL("s string, n bigint, d double, b boolean")
    cases = {
        "plain": '[{"s": "é\\u0041\\n", "n": 1, "d": 2, "b": true}\n , {"x": {"s": [1]}, "d": -0.0},{}, {"s": null}]',
        "number_as_text": '[{"s": 5, "n": 1}, {"s": {"a": 1}}, {"s": "x"}]',
        "twice": '[{"s": "a", "s": "b"}]',
        "integer_zero": '[{"d": -0}, {"d": 1}]',
        "surrogates": '[{"s": "\\ud83d\\ude00"}, {"s": "{\\"n\\": 9}"}]',
        "large": '[{"d": 12345678901234567890, "n": 9223372036854775807}, {"d": 1.7976931348623157e308}]',
        "nothing": "[ ]",
    }
    for name, text in cases.items():
        (tmp_path / f"premium_transaction_{name}.json").write_text(text)
    texts = "path", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("record")
    for size in (7, 10_000):
        scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path)), size)
        found = ranges.json_fields(scans, schema, "FAILFAST", size).select("path", "record.*").collect()
        expected = ranges.json_records(scans, size).select(*texts).select("path", "record.*").collect()
        # As text, which tells -0.0 from 0.0.
        assert sorted(map(str, found)) == sorted(map(str, expected)) and len(found) == 14


def test_plain_records_do_not_pass_as_text(spark, tmp_path):
    rows = [{"id": k % 10, "text": "x" * 50} for k in range(5000)]
    (tmp_path / "premium_transaction_all.json").write_text(json.dumps(rows))
    schema = landing.T.StructType.fromDDL("id bigint")
    scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path)), 50_000)
    found = ranges.json_fields(scans, schema, "PERMISSIVE", 50_000, distinct=True)
    assert found.count() <= 10 * scans.count()
    assert sorted(r["id"] for r in found.select("record.id").distinct().collect()) == list(range(10))
    data = (tmp_path / "premium_transaction_all.json").read_bytes()
    places = ranges._places(Memory(data), len(data), 0, len(data), False, 0)
    assert len(ranges._columns(*places, ranges.pa.schema([("id", ranges.pa.int64())]))) == 5000


@pytest.mark.parametrize("text", ['[{"s": "\\ud83d"}]', '[{"s": "a\tb"}]', '[{"s": 01}]', '[{"n": 1.5}]', '[{"n": "1"}]', "[{'s': 1}]", '[{"s": nul}]'])
def test_what_only_spark_can_judge_is_left_to_it(text):
    data = text.encode()
    places = ranges._places(Memory(data), len(data), 0, len(data), False, 0)
    fields = ranges.pa.schema([("s", ranges.pa.string()), ("n", ranges.pa.int64())])
    assert ranges._columns(*places, fields) is None


def test_deep_records_are_left_to_spark():
    assert ranges._deep(b'[{"a": ' + b"[" * 600 + b"]" * 600 + b"}]")
    assert not ranges._deep(b'[{"a": [[{"b": 1}]]}\n,' * 1 + b'{"a": {}},' * 5000 + b"{}]")
    assert not ranges._deep(b"")


def test_landing_files_of_limited_rows(spark, tmp_path):
    write_landing(spark.range(1000).repartition(2), f"{tmp_path}/in", 300)
    files = [json.loads(path.read_text()) for path in (tmp_path / "in").glob("part-*.txt")]
    assert sorted(r["id"] for f in files for r in f) == list(range(1000))
    assert len(files) == 4 and max(map(len, files)) == 300


def test_landing_files_are_written_once(spark, tmp_path, monkeypatch):
    """F11 to F14, F18: no draft of lines that other tasks read and write again."""
    monkeypatch.setattr(queries, "scratch_folder", None)
    write_landing(spark.range(700).repartition(2), f"{tmp_path}/in", 300)
    files = sorted((tmp_path / "in").glob("part-*c000.txt"))
    found = [json.loads(f.read_text()) for f in files]
    assert all(0 < len(rows) <= 300 for rows in found)
    assert sorted(r["id"] for rows in found for r in rows) == list(range(700))
    write_landing(spark.range(0), f"{tmp_path}/none", 300)
    assert [f.read_bytes() for f in (tmp_path / "none").glob("part-*c000.txt")] == [b""]


@pytest.mark.parametrize(
    "records, n_texts",
    [
        ([{"id": 1, "a": "2031-05-01", "b": True}, {"id": None, "c": 5, "n": None}], 1),
        ([{"id": 1, "a": 1}, {"id": 2, "a": "text"}], 2),
        ([{"id": 1, "a": 1.5}, {"id": 2, "a": 2}], 2),
        ([{"id": 1, "a": [1]}, {"id": 2, "a": []}], 2),
        ([{"id": "text"}, {"id": 2, "a": "x"}], 2),
        ([], 0),
    ],
)
def test_one_record_stands_for_a_range(spark, tmp_path, records, n_texts):
    """the schema grows as if all records had been read as VARIANT values."""
    (tmp_path / "a.txt").write_text(json.dumps(records))
    scans = ranges.scan_ranges(landing.list_files(spark, str(tmp_path), ("a",), ".txt"))
    kept = T.StructType([T.StructField("id", T.LongType())])
    assert ranges.standing_records(scans, kept).count() == n_texts

    def grown(schema):
        try:
            return evolved(kept, schema)
        except ValueError as fault:
            return str(fault)

    plain = landing.record_schema(scans, T.StructType([T.StructField("id", T.DateType())]))
    assert grown(landing.record_schema(scans, kept)) == grown(plain)
