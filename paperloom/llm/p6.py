"""Problem 6: every document as token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.encode import encode
from paperloom.llm.registry import query
from paperloom.sources.tables import table


@query()
def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], "text")
