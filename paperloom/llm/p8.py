"""Problem 8: the reading band of each document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.reading import reading_levels
from paperloom.llm.registry import query
from paperloom.sources.tables import table

LEAST_WORDS = 30


@query()
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return reading_levels(table(spark, folder, "documents"), table(spark, folder, "reading_labels"), LEAST_WORDS)
