"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of all contracts: space and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

# For lower-casing A-Z and nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def one_spaced(text: Column) -> Column:
    """Every run of ASCII white space becomes one space."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def words_of(text: Column) -> Column:
    """The words of a text in order; empty for a text without words."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
