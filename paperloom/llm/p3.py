"""Problem 3: freely typed names and the template they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.canonical import MOST_PHRASES, map_values, part_key
from paperloom.llm.registry import query
from paperloom.sources.tables import cut, table


def typed_names(spark: SparkSession, folder: str) -> DataFrame:
    answers = table(spark, folder, "classifications").filter(F.col("proposedtemplate").isNotNull())
    gaps = table(spark, folder, "vocabulary_gap").select("gapid", F.posexplode("nearest").alias("pos", "near"))
    proposals = answers.select(F.lit("classifications").alias("origin"), F.col("resultid").alias("recordid"), F.lit(0).alias("slot"), F.col("proposedtemplate").alias("value"))
    nearest = gaps.select(F.lit("vocabulary_gap").alias("origin"), F.col("gapid").alias("recordid"), (F.col("pos") + 1).alias("slot"), F.col("near.name").alias("value"))
    return proposals.unionByName(nearest)


def template_phrases(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Each template's name and phrases, for the names that are in the list."""
    names = table(spark, folder, "document_templates").select(F.col("name").alias("entry")).filter(F.col("entry").isNotNull()).distinct()
    phrases = table(spark, folder, "type_phrases").select("phrase", F.col("canonical").alias("entry")).filter(F.col("phrase").isNotNull())
    every = names.select(F.col("entry").alias("phrase"), "entry").unionByName(phrases.join(names, "entry", "left_semi")).distinct()
    return [(r[0], r[1]) for r in every.limit(MOST_PHRASES + 1).select("phrase", "entry").collect()]


def mapped(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "classifications").count()
    return map_values(typed_names(spark, folder), ["origin", "recordid", "slot"], template_phrases(spark, folder), rows)


@query()
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return mapped(spark, folder).withColumnRenamed("entry", "templatename")


@query()
def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Values that stand for no template, in their deduplicated spelling, with how often they were typed.

    Each spelling is mapped once; null values are none.
    """
    typed = typed_names(spark, folder).groupBy("origin", part_key(F.col("value")).alias("value")).agg(F.count("*").alias("copies"))
    spelt = cut(typed)
    found = map_values(spelt.select("origin", F.col("value").alias("_key"), "value"), ["origin", "_key"], template_phrases(spark, folder), spelt.count())
    return spelt.join(found.select("origin", F.col("_key").alias("value")), ["origin", "value"], "left_anti")
