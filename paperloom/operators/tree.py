"""The folder tree: parts of paths, summaries of levels, exclusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import casefold


def folders_of(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def extension_of(name: Column) -> Column:
    """Last suffix in lower case without its dot; empty where there is none or the name begins with its only dot."""
    return F.lower(F.regexp_extract(name, r"[^./]\.([^./]+)$", 1))


def tree(files: DataFrame, path: str = "relativepath") -> DataFrame:
    """path, folders, name, ext, depth of each file.  Null paths are dropped."""
    name = F.element_at(F.split(path, "/"), -1)
    return files.filter(F.col(path).isNotNull()).select(
        F.col(path).alias("path"), folders_of(F.col(path)).alias("folders"), name.alias("name"), extension_of(name).alias("ext"), F.size(folders_of(F.col(path))).alias("depth")
    )


def levels(files: DataFrame, most_names: int = 12) -> DataFrame:
    """For each folder depth: distinct names, files under it, the most frequent names (ties by name).

    Only the names that are shown are ranked into a list; Spark keeps as many of each depth in a task before it shuffles.
    """
    named = files.select(F.posexplode("folders").alias("pos", "folder")).groupBy((F.col("pos") + 1).alias("depth"), "folder").agg(F.count("*").alias("n"))
    k = F.row_number().over(Window.partitionBy("depth").orderBy(F.desc("n"), "folder"))
    best = named.withColumn("_k", k).filter(F.col("_k") <= most_names).groupBy("depth").agg(F.array_sort(F.collect_list(F.struct("_k", "folder"))).alias("b"))
    sums = named.groupBy("depth").agg(F.count("*").alias("distinct_names"), F.sum("n").alias("files_under"))
    return sums.join(best, "depth").select("depth", "distinct_names", "files_under", F.array_join(F.transform("b", lambda x: x["folder"]), "|").alias("names"))


def depth_flags(files: DataFrame) -> DataFrame:
    """One row: files, files without a folder above them, whether files stand at several depths, whether no folder is there."""
    counted = files.groupBy("depth").agg(F.count("*").alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return counted.agg(
        zero(F.sum("n")).alias("files"), zero(F.sum(F.when(F.col("depth") == 0, F.col("n")))).alias("loose"), (F.count("*") > 1).alias("mixed"), (F.coalesce(F.max("depth"), F.lit(0)) == 0).alias("flat")
    )


def depth_histogram(files: DataFrame) -> DataFrame:
    return files.groupBy("depth").agg(F.count("*").alias("files"))


def folder_candidates(files: DataFrame) -> DataFrame:
    """For each case-blind folder name: distinct parents and files, to decide what to exclude."""
    at = files.select("folders", F.posexplode("folders").alias("pos", "folder"))
    parent = F.array_join(F.slice("folders", F.lit(1), F.col("pos")), "/")
    return at.select(casefold(F.col("folder")).alias("folder"), parent.alias("parent")).groupBy("folder").agg(F.count_distinct("parent").alias("parents"), F.count("*").alias("files"))


def extension_histogram(files: DataFrame) -> DataFrame:
    return files.groupBy(F.when(F.col("ext") == "", "(none)").otherwise(F.col("ext")).alias("ext")).agg(F.count("*").alias("files"))


def exclusion_reason(folders: list[str], extensions: list[str]) -> Column:
    """Why a file is left out: its first folder in path order that is listed, else its extension; null if it stays."""
    listed = F.get(F.filter("folders", lambda f: casefold(f).isin([x.casefold() for x in folders])), F.lit(0))
    return F.coalesce(F.concat(F.lit("folder "), listed), F.when(F.col("ext").isin([x.casefold().lstrip(".") for x in extensions]), F.concat(F.lit("extension "), "ext")))


def exclusions(files: DataFrame, folders: list[str], extensions: list[str]) -> DataFrame:
    """The files with ``why``; null for those kept."""
    return files.withColumn("why", exclusion_reason(folders, extensions))
