"""Problem 2: texts of scanned pages, their faults and their repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.registry import query
from paperloom.llm.scans import repaired, scan_faults
from paperloom.sources.tables import table


def scans(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "extracted").filter(F.col("ocrtextfile").isNotNull()).select(F.col("extractid").alias("key"), F.col("ocrtextfile").alias("text"))


@query()
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    faults, _ = scan_faults(scans(spark, folder))
    return faults.withColumnRenamed("key", "extractid")


@query()
def p2_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Each scanned text as continuous paragraphs."""
    return repaired(scans(spark, folder)).withColumnRenamed("key", "extractid")
