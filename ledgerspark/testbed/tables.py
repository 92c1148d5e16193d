"""The driver tables seen as transactions, landing files and manifests.

Faults are taken from natural columns, so that every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.calendar import add_calendar_features


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _percent(column: str) -> Column:
    # Not round(), which goes through BigDecimal for every row; values are not negative.
    return (F.col(column) * 100 + 0.5).cast("int")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its supplier as raw records plus ``created_at_timestamp``."""
    items = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    tax, discount = _percent("l_tax"), _percent("l_discount")
    item_id = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
    created = F.when((F.col("l_linenumber") == 7) & (tax == 1), None).otherwise(
        F.col("l_shipdate")
    )
    amount = (
        F.when((discount == 9) & (tax == 7), -F.col("l_extendedprice"))
        .when((discount == 5) & (tax == 2), None)
        .when((discount == 3) & (tax == 4), F.lit(0.0))
        .otherwise(F.col("l_extendedprice"))
    )
    currency = (
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"), "GBP")
        .when((discount == 2) & (tax == 6), "USD")
        .otherwise("EUR")
    )
    joined = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined.select(
        F.when(F.col("l_quantity") == 7, None).otherwise(item_id).alias("transaction_id"),
        F.date_format(created, "MM/dd/yyyy HH:mm:ss").alias("created_at"),
        amount.alias("amount"),
        currency.alias("currency"),
        F.when((discount == 10) & (tax == 8), None)
        .otherwise(F.col("s_name"))
        .alias("charged_partner"),
        F.when(F.col("l_returnflag") == "R", "cancelled")
        .otherwise("processed")
        .alias("status"),
        created.alias("created_at_timestamp"),
    )


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted table: transactions with day and calendar features."""
    rows = transactions(spark, sf_dir)
    rows = rows.withColumn("day", F.dayofmonth("created_at_timestamp"))
    return add_calendar_features(rows, "created_at_timestamp")


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a listing of landing files: one file per document."""
    days = F.floor(F.col("n_chars") / 30).cast("int")
    day = F.date_add(F.lit("2012-01-01").cast("date"), days)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("landing/"), F.col("source"), F.lit("/"), F.col("doc_id")).alias("path"),
        F.col("n_chars").alias("size_bytes"),
        F.timestamp_seconds(F.lit(1700000000)).alias("modified_at"),
        F.sha2(F.col("text").cast("binary"), 256).alias("content_digest"),
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("file_date"),
        F.array(F.year(day) * 100 + F.month(day)).alias("months"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as what earlier runs knew: labelled documents were ingested before.

    Low quality means the file held other content, one month later; a toxic one has no
    stored digest and another size.
    """
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    known = labels.join(documents, "doc_id").select(
        F.concat(F.lit("landing/"), F.col("source"), F.lit("/"), F.col("doc_id")).alias("path"),
        "quality",
        "toxic",
    )
    now = landing_files(spark, sf_dir)
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    old_month = F.transform("months", lambda m: F.when(m % 100 == 12, m + 89).otherwise(m + 1))
    return now.join(known, "path").select(
        "path",
        F.when(toxic, F.col("size_bytes") + 1).otherwise(F.col("size_bytes")).alias("size_bytes"),
        "modified_at",
        F.when(toxic, None)
        .when(low, F.sha2(F.col("content_digest").cast("binary"), 256))
        .otherwise(F.col("content_digest"))
        .alias("content_digest"),
        "file_date",
        F.when(low, old_month).otherwise(F.col("months")).alias("months"),
    )
