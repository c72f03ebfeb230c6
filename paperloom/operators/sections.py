"""Sections: where a template stands within an item template, derived from the arrangement; new sections planned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import section_key


def section_of(sections: DataFrame) -> DataFrame:
    """(itemtemplate, documenttemplateid, section, sortorder): the first section by sort order that holds the template.

    sections: itemtemplate, label, sortorder, templates array<string>.
    """
    held = sections.select("itemtemplate", "label", "sortorder", F.explode("templates").alias("documenttemplateid"))
    first = F.min_by(F.struct("label", "sortorder"), F.struct("sortorder", "label"))
    return held.groupBy("itemtemplate", "documenttemplateid").agg(first.alias("s")).select("itemtemplate", "documenttemplateid", F.col("s.label").alias("section"), F.col("s.sortorder").alias("sortorder"))


def section_pairs(answers: DataFrame) -> DataFrame:
    """(itemtemplate, documenttemplateid, documenttemplate, itemtable, documents): what has to be arranged."""
    some = answers.filter((F.coalesce("documenttemplateid", F.lit("")) != "") & (F.coalesce("itemtemplate", F.lit("")) != ""))
    return some.groupBy("itemtemplate", "documenttemplateid", "documenttemplate", "itemtable").agg(F.count("*").alias("documents"))


def section_id(itemtemplate: Column, label: Column) -> Column:
    """The derived id: 12 digits of a hash of item template and section key."""
    return F.concat(F.lit("ds_"), F.left(F.sha2(F.concat_ws(":", itemtemplate, section_key(label)), 256), F.lit(12)))


def unarranged(answers: DataFrame, sections: DataFrame) -> DataFrame:
    """(itemtemplate, documenttemplate, documents, available): templates in no section of their item template."""
    pairs = section_pairs(answers).join(section_of(sections).select("itemtemplate", "documenttemplateid"), ["itemtemplate", "documenttemplateid"], "left_anti")
    offered = sections.groupBy("itemtemplate").agg(F.array_join(F.array_sort(F.collect_set("label")), "|").alias("available"))
    each = pairs.groupBy("itemtemplate", "documenttemplate").agg(F.sum("documents").alias("documents"))
    return each.join(offered, "itemtemplate", "left").withColumn("available", F.coalesce("available", F.lit("")))


def collect_sections(pairs: DataFrame, answers: DataFrame, sections: DataFrame) -> DataFrame:
    """The section of each pair: an existing arrangement wins over the answer; whether its label is new.

    answers: itemtemplate, documenttemplateid, section.  Pairs without either keep a null section.
    """
    labels = sections.select("itemtemplate", section_key(F.col("label")).alias("_key")).distinct().withColumn("_old", F.lit(True))
    joined = pairs.join(section_of(sections).withColumnRenamed("section", "arranged"), ["itemtemplate", "documenttemplateid"], "left")
    joined = joined.join(answers.select("itemtemplate", "documenttemplateid", F.col("section").alias("answered")), ["itemtemplate", "documenttemplateid"], "left")
    joined = joined.withColumn("section", F.coalesce("arranged", "answered")).withColumn("_key", section_key(F.col("section")))
    out = joined.join(labels, ["itemtemplate", "_key"], "left")
    moved = F.col("arranged").isNotNull() & F.col("answered").isNotNull() & (section_key(F.col("arranged")) != section_key(F.col("answered")))
    return out.select(
        "itemtemplate", "documenttemplateid", "documenttemplate", "documents", "section", F.when(F.col("section").isNotNull(), section_id(F.col("itemtemplate"), F.col("section"))).alias("sectionid"),
        (F.col("section").isNotNull() & F.col("_old").isNull()).alias("isnew"), moved.alias("kept"),
    )
