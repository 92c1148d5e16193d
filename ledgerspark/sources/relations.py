"""Relations of the session catalog, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A dotted name with every part in back-ticks, so that any part is a plain identifier."""
    parts = [part.strip() for part in name.split(".")]
    if not all(parts):
        raise ValueError(f"Not a relation name: {name!r}.")
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def read_relation(spark: SparkSession, name: str) -> DataFrame:
    """A table or view the catalog knows under this name; a missing one is an error."""
    relation = quoted(name)
    if not spark.catalog.tableExists(relation):
        raise ValueError(f"Relation {name!r} does not exist. Build the warehouse first.")
    return spark.table(relation)
