"""Ordered CSV report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import fs

# Fixed value: name of the exported report.
REPORT_NAME = "monthly_partner_premium_summary.csv"


def report_order(mart: DataFrame) -> DataFrame:
    """Newest month first, then partner (and currency) in binary text order."""
    order = [F.desc("month"), F.asc("partner")]
    if "currency" in mart.columns:
        order.append(F.asc("currency"))
    return mart.orderBy(*order)


def export_report(
    mart: DataFrame,
    output_dir: str,
    *,
    file_name: str = REPORT_NAME,
    single_file: bool = False,
) -> str:
    """Write the report and return its path: a folder of CSV parts.

    The parts, in name order, hold the rows in report order. With ``single_file`` the
    caller asks for one file instead, which one task then has to write.
    """
    spark = mart.sparkSession
    report = report_order(mart.select("partner", "month", "total_premium"))
    target = f"{output_dir.rstrip('/')}/{file_name}"
    folder = f"{target}.parts"
    ordered = report.coalesce(1) if single_file else report
    ordered.write.mode("overwrite").option("header", True).csv(folder)
    if fs.exists(spark, target):
        fs.delete(spark, target)
    if single_file:
        part = fs.glob(spark, f"{folder}/part-*.csv")
        fs.rename(spark, part[0], target)
        fs.delete(spark, folder)
    else:
        fs.rename(spark, folder, target)
    return target


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report with ``position``, the place of each row from 1.

    Counts per part give the offsets, so the rows are not gathered to be numbered.
    """
    rows = spark.read.csv(
        path, header=True, schema="partner string, month string, total_premium double"
    ).select(
        "*",
        F.col("_metadata.file_name").alias("part"),
        F.monotonically_increasing_id().alias("place"),
    )
    # A part may be read in several splits; places grow within and across them.
    splits = rows.select("part", F.shiftright("place", 33).alias("split"))
    sizes = splits.groupBy("part", "split").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.selectExpr(
        "part", "split",
        "sum(n) OVER (ORDER BY part, split ROWS UNBOUNDED PRECEDING) - n AS before",
    )
    numbered = rows.withColumn("split", F.shiftright("place", 33)).join(before, ["part", "split"])
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(
        "partner", "month", "total_premium", (F.col("before") + within + 1).alias("position")
    )
