"""Upsert and merge as set operations on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_merge_keys(source: DataFrame, keys: Sequence[str]) -> None:
    missing = [key for key in keys if key not in source.columns]
    if missing or not keys:
        problem = f"no column {', '.join(missing)}" if missing else "no key was named"
        raise ValueError(f"Rows cannot be matched for an upsert: {problem}.")


def repeated_merge_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once; an upsert from them is ambiguous."""
    complete = reduce(and_, [F.col(key).isNotNull() for key in keys])
    return (
        source.where(complete)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` after replacing rows with equal keys and adding the rest.

    NULL keys never match. Target columns the source lacks keep their old values.
    """
    require_merge_keys(source, keys)
    keys = list(keys)
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        source = source.join(target.select(*keys, *missing), keys, "left")
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
