"""The application's items and closed lists: loading, findings, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import casefold, is_true, normalise


def load_items(items: DataFrame, tables: list[str]) -> DataFrame:
    """Items normalised: names without stray white space, archived as a boolean; rows of unknown tables are dropped."""
    clean = lambda c: F.coalesce(normalise(F.col(c)), F.lit(""))
    return items.select(
        clean("itemtable").alias("itemtable"), clean("id").alias("id"), clean("identifier").alias("identifier"), clean("name").alias("name"), clean("template").alias("template"), is_true(F.col("archived")).alias("archived")
    ).filter(F.col("itemtable").isin(tables))


def item_problems(items: DataFrame, tables: list[str], templates: list[str]) -> DataFrame:
    """Row-level findings: unknown tables (the row is dropped) and unknown templates (it is kept)."""
    table_, template = F.coalesce(normalise(F.col("itemtable")), F.lit("")), F.coalesce(normalise(F.col("template")), F.lit(""))
    what = F.when(~table_.isin(tables), "table").when((template != "") & ~template.isin(templates), "template")
    return items.select(F.coalesce("id", F.lit("")).alias("id"), what.alias("unknown"), F.when(what == "table", table_).otherwise(template).alias("value")).filter(F.col("unknown").isNotNull())


def items_summary(items: DataFrame) -> DataFrame:
    """Per table: items, archived, blank identifiers, no template, distinct identifiers, identifiers of several items."""
    each = items.groupBy("itemtable", "identifier").agg(
        F.count("*").alias("n"), F.sum(F.col("archived").cast("bigint")).alias("gone"), F.sum((F.col("template") == "").cast("bigint")).alias("bare")
    )
    named = F.col("identifier") != ""
    return each.groupBy("itemtable").agg(
        F.sum("n").alias("items"), F.sum("gone").alias("archived"), F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("blank_id"), F.sum("bare").alias("no_template"),
        F.count_if(named).alias("distinct_ids"), F.count_if(named & (F.col("n") > 1)).alias("collisions"),
    )


def item_collisions(items: DataFrame, most_names: int = 3) -> DataFrame:
    """Identifiers that name several items, with the first few names; no identifier's names are all gathered."""
    named = items.filter(F.col("identifier") != "").select("itemtable", "identifier", "name")
    counted = named.groupBy("itemtable", "identifier").agg(F.count("*").alias("n")).filter("n > 1")
    k = F.row_number().over(Window.partitionBy("itemtable", "identifier").orderBy("name"))
    first = named.withColumn("_k", k).filter(F.col("_k") <= most_names).groupBy("itemtable", "identifier").agg(F.array_join(F.array_sort(F.collect_list("name")), "|").alias("names"))
    return counted.join(first, ["itemtable", "identifier"])


def duplicate_names(templates: DataFrame) -> DataFrame:
    """Case-blind template names held by several ids."""
    return templates.groupBy(casefold(F.col("name")).alias("name")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("id")), "|").alias("ids")).filter("n > 1")


def closed_list(templates: DataFrame, tables: DataFrame) -> DataFrame:
    """(itemtable, id, name): what each table permits; a template without tables is permitted everywhere.

    tables: itemtable, a few rows.
    """
    everywhere = F.col("for_tables").isNull() | (F.size("for_tables") == 0)
    listed = templates.filter(~everywhere).select("id", "name", F.explode(F.array_distinct("for_tables")).alias("itemtable")).join(F.broadcast(tables), "itemtable", "left_semi")
    return listed.select("itemtable", "id", "name").unionByName(templates.filter(everywhere).select("id", "name").join(F.broadcast(tables)).select("itemtable", "id", "name"))


def unknown_tables(branches: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables that branches name and the application does not have; both: itemtable."""
    return branches.select("itemtable").subtract(tables.select("itemtable"))
