"""Problem 1: one proposal under many spellings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import merkle
from paperloom.llm.registry import query
from paperloom.sources.tables import cut, table


def proposals(spark: SparkSession, folder: str) -> DataFrame:
    """Proposals as unordered nodes of their parts, per session."""
    answers = table(spark, folder, "classifications").filter(F.col("proposedtemplate").isNotNull())
    parts = F.split("proposedtemplate", "[;|/]")
    return merkle.records(answers.select("resultid", "sessionid", parts.alias("parts")), "resultid", "sessionid", "parts")


SQL = r"""
WITH parts AS (
  SELECT resultid, sessionid, list_sort(list_filter(list_transform(string_split_regex(proposedtemplate, '[;|/]'),
           lambda p: regexp_replace(replace(lower(p), 'ß', 'ss'), '[^\p{L}\p{N}]+', '', 'g')), lambda p: p <> '')) AS form
  FROM classifications WHERE proposedtemplate IS NOT NULL),
kept AS (SELECT resultid, sessionid, form, min(resultid) OVER (PARTITION BY sessionid, form) AS firstid FROM parts WHERE len(form) > 0)
"""


@query(SQL + "SELECT firstid, resultid FROM kept WHERE resultid <> firstid")
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = cut(proposals(spark, folder))
    return merkle.copies(found, found.count()).select(F.col("first").alias("firstid"), F.col("_row").alias("resultid"))


@query(SQL + "SELECT sessionid, firstid, count(*)::BIGINT AS copies FROM kept GROUP BY ALL")
def p1_proposals(spark: SparkSession, folder: str) -> DataFrame:
    """Each proposal of a session once, with its number of copies."""
    session = F.when(F.col("_scope") != "", F.substr("_scope", F.lit(2)))
    return merkle.collapse(proposals(spark, folder)).select(session.alias("sessionid"), F.col("first").alias("firstid"), "copies")
