"""Landing files: listing, content digests, event dates, and reading the records."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import fs
from ledgerspark.operators.manifest import STATE_COLUMNS, add_record_coverage
from ledgerspark.schema import storable
from ledgerspark.session import materialize
from ledgerspark.sources.ranges import RANGE_BYTES, file_digests, json_fields, json_records, scan_ranges, standing_records


def _matching(
    spark: SparkSession, directory: str, tokens: Sequence[str], extension: str
) -> DataFrame:
    if not fs.exists(spark, directory):
        raise FileNotFoundError(f"Directory not found: {directory}")
    name = F.element_at(F.split("path", "/"), -1)
    wanted = name.endswith(extension)
    for token in tokens:
        wanted = wanted & name.contains(token)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}")
    return reader.load(re.sub(r"([\\\[\]{}*?])", r"\\\1", directory)).where(wanted)


def list_files(
    spark: SparkSession,
    directory: str,
    tokens: Sequence[str] = ("premium", "transaction"),
    extension: str = ".json",
) -> DataFrame:
    """Files of a folder whose name contains all tokens and ends with the extension.

    Size and modification time come from the listing; no file is opened.
    """
    return _matching(spark, directory, tokens, extension).select(
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


@dataclass(frozen=True)
class Described:
    """State of all landing files, and the byte ranges of those that were opened."""

    current: DataFrame
    scans: DataFrame


def _describe(
    files: DataFrame, scans: DataFrame, time_column: str, extension: str, range_bytes: int
) -> DataFrame:
    """First date and months of each file: only the event-time field of its records is kept."""
    field = T.StructType([T.StructField(time_column, T.StringType())])
    # Equal times of one range say nothing new.
    records = json_fields(_ranges_of(scans, files), field, "PERMISSIVE", range_bytes, distinct=True).select(
        "path", F.col("record")[time_column].alias("_value")
    )
    return add_record_coverage(files, records, "_value", extension).select(*STATE_COLUMNS)


def _ranges_of(scans: DataFrame, files: DataFrame) -> DataFrame:
    return scans.join(files.select("path"), "path", "left_semi")


def describe_directory(
    spark: SparkSession,
    directory: str,
    manifest: DataFrame,
    *,
    tokens: Sequence[str] = ("premium", "transaction"),
    extension: str = ".json",
    time_column: str = "created_at",
    trust_mtime: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> Described:
    """Current state of all landing files.

    Files of any size are read by ranges, one pass for digests and the places of records. By
    default every file is hashed, so a change that keeps size and time is seen. With
    ``trust_mtime`` only files whose size or time differ from the manifest are opened. In
    both cases only content that the manifest does not hold for the path is parsed; of
    the other files the stored dates and months are taken.
    """
    seen = materialize(list_files(spark, directory, tokens, extension), "listing")
    known = manifest.where(F.col("content_digest").isNotNull())
    same = ["path", "size_bytes", "modified_at"] if trust_mtime else ["path", "content_digest"]
    wanted = seen.join(known.select(*same), same, "left_anti") if trust_mtime else seen
    scans = materialize(scan_ranges(wanted, range_bytes), "ranges")
    hashed = materialize(wanted.join(file_digests(scans), "path"), "digests")
    current = seen if trust_mtime else hashed
    stored = known.select(*same, *[c for c in STATE_COLUMNS if c not in current.columns])
    unchanged = current.join(stored, same).select(*STATE_COLUMNS)
    opened = hashed if trust_mtime else hashed.join(known.select(*same), same, "left_anti")
    if opened.isEmpty():
        return Described(unchanged, scans)
    described = _describe(opened, scans, time_column, extension, range_bytes)
    return Described(unchanged.unionByName(described), scans)


def in_source_order(files: DataFrame) -> DataFrame:
    return files.orderBy("file_date", "path")


def with_positions(files: DataFrame) -> DataFrame:
    """Add ``position``, the place of each file in source order (first date, path), from 1.

    The sorted files are stored; counts per part give the offsets, so neither the driver nor
    one task holds the list.
    """
    place = F.monotonically_increasing_id()
    ordered = materialize(in_source_order(files).withColumn("_place", place), "ordered-files")
    part = F.shiftright("_place", 33).alias("_part")
    sizes = ordered.select(part).groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.selectExpr(
        "_part", "sum(_n) OVER (ORDER BY _part ROWS UNBOUNDED PRECEDING) - _n AS _before"
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("_part", part).join(before, "_part").select(
        *files.columns, (F.col("_before") + within + 1).alias("position")
    )


def observe_schema(scans: DataFrame, range_bytes: int = RANGE_BYTES) -> T.StructType:
    """Schema of the records as Spark infers it from all of them, in storable types."""
    spark = scans.sparkSession
    texts = json_records(scans, range_bytes).select("value")
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    dataset = getattr(texts._jdf, "as")(encoder)
    inferred = spark._jsparkSession.read().json(dataset).schema().json()
    return storable(T.StructType.fromJson(json.loads(inferred)))


def record_schema(scans: DataFrame, kept: T.StructType, range_bytes: int = RANGE_BYTES) -> T.StructType:
    """Fields and types of the records that :func:`evolved` needs, read as VARIANT values: those
    that ``kept`` lacks, and kept ones with values that it may not hold."""
    record = F.try_parse_json("value")
    row = standing_records(scans, kept, range_bytes).agg(F.schema_of_variant_agg(record).alias("found")).first()
    found = (row["found"] or "VOID").replace("OBJECT<", "STRUCT<")
    if not found.startswith("STRUCT<") or found == "STRUCT<>":
        return T.StructType()

    def plain(kind: T.DataType) -> T.DataType:
        # As schema inference has them: fractions are doubles, whole numbers BIGINT if they fit.
        if isinstance(kind, T.DecimalType) and (kind.scale or kind.precision <= 18):
            return T.DoubleType() if kind.scale else T.LongType()
        return kind

    fields = T._parse_datatype_string(found).fields
    return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in fields])


def read_records(
    scans: DataFrame, schema: T.StructType, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Records of the JSON array files whose ranges ``scans`` holds, with their ``source_file``.

    A malformed file or a value of another type fails the job. Unknown fields are dropped. A
    file is read by as many tasks as it has ranges.
    """
    return json_fields(scans, schema, "FAILFAST", range_bytes).select(
        *[F.col("record")[name].alias(name) for name in schema.fieldNames()], F.col("path").alias("source_file")
    )
