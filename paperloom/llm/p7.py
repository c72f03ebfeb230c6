"""Problem 7: a mixture of the sources with the target shares of all tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.encode import token_counts
from paperloom.llm.mixing import mix, shares
from paperloom.llm.registry import query
from paperloom.sources.tables import cut, table


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    sized = cut(token_counts(documents, ["doc_id", "source"], "text"))
    return mix(sized, table(spark, folder, "source_targets"))


@query()
def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Each copy of a document in the mixture, with its virtual finish time and the total so far."""
    return mixture(spark, folder)


@query()
def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares asked for and reached."""
    return shares(mixture(spark, folder), table(spark, folder, "source_targets"))
