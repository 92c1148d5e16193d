"""Session settings and the scratch area shared by all executors."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerspark import fs

# The settings the library is designed for. Skewed joins and skewed partitioned writes
# are split at run time by adaptive execution; event times never change zone.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app_name: str = "ledgerspark", **conf: str) -> SparkSession:
    """Get or create a session with ``RECOMMENDED_CONF`` plus the caller's settings."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session
    without it is an error, because a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerspark-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark)}/ledgerspark/{label}-{uuid.uuid4().hex}"


# Scratch tables that materialize() made and nobody has removed, oldest first.
_MADE: list[str] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch area and read it back.

    Cuts the lineage in a way that survives lost executors, and gives Catalyst the true
    size of the result, so that it broadcasts it in a later join only if it is small.
    """
    path = scratch_path(df.sparkSession, label)
    _MADE.append(path)
    return _store(df, path)


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The tables that :func:`materialize` makes within the block, for :func:`remove_scratch`."""
    made: list[str] = []
    begin = len(_MADE)
    try:
        yield made
    finally:
        made += _MADE[begin:]
        del _MADE[begin:]


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables once no frame that reads them is used any more; empties the list."""
    while paths:
        fs.delete(spark, paths.pop())


# Keys are hexadecimal text, which Snappy, Spark's default, stores at full length.
COMPRESSION = "zstd"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANUP_LOCK = threading.Lock()
_CLEANUP = {"depth": 0, "before": "false"}


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of writes within the block go as each ends, not when the driver collects
    its garbage. Several threads may be in such blocks at once."""
    with _CLEANUP_LOCK:
        if not _CLEANUP["depth"]:
            _CLEANUP["before"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _CLEANUP["depth"] += 1
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            _CLEANUP["depth"] -= 1
            if not _CLEANUP["depth"]:
                spark.conf.set(SHUFFLE_CLEANUP, _CLEANUP["before"])


def _store(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    with shuffle_cleanup(spark):
        df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch path that is removed afterwards, also when the work fails."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        fs.delete(spark, path)


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`materialize`, for use inside a block; the files go with the block."""
    with scratch_folder(df.sparkSession, label) as path:
        yield _store(df, path)
