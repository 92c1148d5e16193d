"""Small file operations through the Hadoop file system of the session.

Used for markers and state of a few bytes, and for removing whole partition folders.
Data always goes through Spark readers and writers.
"""

from __future__ import annotations

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Arrow needs it to find the same file system."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, sorted; empty when nothing matches."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found or [])


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"Could not rename {source} to {target}.")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file: first under another name, then renamed into place."""
    draft = f"{path}.draft"
    stream = _fs(spark, path).create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if exists(spark, path):
        delete(spark, path)
    rename(spark, draft, path)


_CREATING = threading.Lock()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False, without any change, if it is there already.

    The file appears whole, by a rename that never overwrites. HDFS makes that one step, so
    of several writers one gets True; on a file system that checks first and renames then
    (local files, object stores) two processes may in a moment's overlap.
    """
    draft = f"{path}.{uuid.uuid4().hex}"
    stream = _fs(spark, path).create(_path(spark, draft), False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs
    target = _fs(spark, path).makeQualified(_path(spark, path))
    context = files.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(files, "Options$Rename"), 0)
    try:
        with _CREATING:
            context.rename(context.makeQualified(_path(spark, draft)), target, no_options)
    except Py4JJavaError as error:
        delete(spark, draft)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    """Time since a file or folder was last changed."""
    changed = _fs(spark, path).getFileStatus(_path(spark, path)).getModificationTime()
    return (spark._jvm.java.lang.System.currentTimeMillis() - changed) / 1000


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, or None when it does not exist."""
    if not exists(spark, path):
        draft = f"{path}.draft"
        if not exists(spark, draft):
            return None
        path = draft
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
