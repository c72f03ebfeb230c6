"""From a file's path to the one live item it belongs to, or why there is none."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import casefold, strip
from paperloom.operators.skew import lookup
from paperloom.sources.tables import cut


@dataclass(frozen=True)
class Branch:
    """Files whose path begins with the prefix: their table, and where their identifier stands.

    level: the folder, from 1; else pattern: a regular expression on the file name, its first group if it has one.
    """

    prefix: str
    table: str
    level: int | None = None
    pattern: str | None = None
    hint_level: int | None = None


def branch_of(path: Column, branches: list[Branch]) -> Column:
    """The number of the longest prefix of the path, the first of equals; null where none fits.

    Branches are written by hand, so they are few: a chain of prefix tests inside code generation, no join at all.
    """
    order = sorted(range(len(branches)), key=lambda k: (-len(branches[k].prefix), k))
    when = reduce(lambda e, k: e.when(path.startswith(branches[k].prefix), F.lit(k)), order, F.when(F.lit(False), F.lit(-1)))
    return when


def _pick(number: Column, branches: list[Branch], value) -> Column:
    return reduce(lambda e, k: e.when(number == k, value(branches[k])), range(len(branches)), F.when(F.lit(False), F.lit(None).cast("string")))


def java_pattern(pattern: str) -> str:
    """A pattern of a branch, written for Python, as Spark's engine reads it.

    Classes are Unicode ones in both.  Look-behind, conditions and named groups are refused with the reason, and so is
    what is no pattern at all.
    """
    try:
        re.compile(pattern)
    except re.error as x:
        raise ValueError(f"not a regular expression: {pattern!r}: {x}") from x
    # What begins a group that the two engines read differently.
    for opening, name in (("(?<", "look-behind"), ("(?P", "a named group"), ("(?(", "a condition"), ("(?#", "a comment")):
        if opening in pattern.replace("\\\\", "").replace("\\(", ""):
            raise ValueError(f"{name} cannot be used in a branch: {pattern!r}")
    # The end of the text is written with another letter there.
    return "(?U)" + re.sub(r"(?<!\\)((?:\\\\)*)\\Z", r"\1\\z", pattern)


def identify(files: DataFrame, branches: list[Branch]) -> DataFrame:
    """branch, itemtable, identifier, hint and why (null so far) of each file; files: path, folders, name."""
    number = branch_of(F.col("path"), branches)

    def identifier(b: Branch) -> Column:
        if b.level is not None:
            return strip(F.get("folders", F.lit(b.level - 1)))
        if b.pattern:
            group = 1 if re.compile(b.pattern).groups else 0
            return strip(F.nullif(F.regexp_extract("name", java_pattern(b.pattern), group), F.lit("")))
        return F.lit(None).cast("string")

    found = files.withColumn("branch", number)
    found = found.withColumn("itemtable", _pick(F.col("branch"), branches, lambda b: F.lit(b.table)))
    found = found.withColumn("identifier", F.nullif(_pick(F.col("branch"), branches, identifier), F.lit("")))
    found = found.withColumn("hint", _pick(F.col("branch"), branches, lambda b: F.get("folders", F.lit(b.hint_level - 1)) if b.hint_level else F.lit(None).cast("string")))
    return found.withColumn("why", F.when(F.col("branch").isNull(), "unbranched").when(F.col("identifier").isNull(), "unidentified"))


def item_index(items: DataFrame, key: Column, prefix: str, most_names: int = 3) -> DataFrame:
    """One row for each table and key: how many items, the one item if it is one, up to three names if they are several."""
    one = F.struct("id", "name", "template", "archived")
    keyed = items.filter(F.col("identifier") != "").withColumn("_key", key)
    counted = keyed.groupBy("itemtable", "_key").agg(F.count("*").alias(f"{prefix}_n"), F.min_by(one, F.struct("id", "name")).alias(f"{prefix}_item"))
    k = F.row_number().over(Window.partitionBy("itemtable", "_key").orderBy("id", "name"))
    first = keyed.withColumn("_k", k).filter(F.col("_k") <= most_names)
    names = first.groupBy("itemtable", "_key").agg(F.array_sort(F.collect_list(F.struct("_k", F.concat("id", F.lit(" ("), "name", F.lit(")")).alias("name")))).alias("_names"))
    listed = F.when(F.col(f"{prefix}_n") > 1, F.array_join(F.transform("_names", lambda x: x["name"]), ", "))
    return counted.join(names, ["itemtable", "_key"]).select("itemtable", "_key", f"{prefix}_n", f"{prefix}_item", listed.alias(f"{prefix}_names"))


def resolve(found: DataFrame, items: DataFrame, rows: int | None = None) -> DataFrame:
    """Adds itemid, itemname, itemtemplate, how, names, and the reason why there is no item.

    An identifier is looked up as it stands; only if nothing is found, case-blind.  Several items are ``ambiguous`` (an
    ambiguous exact match does not fall through; names: the first of them), an archived one is ``archived``, none is
    ``unmatched``.  how: ``exact`` or ``case-blind`` where an item is reached.

    rows: how many files there are, counted if not given; from that it follows which items have so many files that these
    are not brought to one task.  Identified files are kept, and so is what the first look-up gives, as each look-up
    reads its side several times.
    """
    found = cut(found.withColumn("_folded", casefold(F.col("identifier"))))
    rows = found.count() if rows is None else rows
    exact = item_index(items, F.col("identifier"), "exact").withColumnRenamed("_key", "identifier")
    loose = item_index(items, casefold(F.col("identifier")), "loose").withColumnRenamed("_key", "_folded")
    joined = lookup(cut(lookup(found, exact, ["itemtable", "identifier"], rows)), loose, ["itemtable", "_folded"], rows)
    n, item = F.coalesce("exact_n", "loose_n"), F.coalesce("exact_item", "loose_item")
    why = F.coalesce("why", F.when(n.isNull(), "unmatched").when(n > 1, "ambiguous").when(item["archived"], "archived"))
    out = joined.withColumn("why", why)
    ok = F.col("why").isNull()
    names = F.when(F.col("why") == "ambiguous", F.when(F.col("exact_n").isNotNull(), F.col("exact_names")).otherwise(F.col("loose_names")))
    return out.withColumns({
        "itemid": F.when(ok, item["id"]), "itemname": F.when(ok, item["name"]), "itemtemplate": F.when(ok, item["template"]),
        "how": F.when(ok, F.when(F.col("exact_n").isNotNull(), "exact").otherwise("case-blind")), "names": names,
    }).drop("exact_n", "exact_item", "exact_names", "loose_n", "loose_item", "loose_names", "_folded")


def match_rates(resolved: DataFrame, branches: list[Branch]) -> DataFrame:
    """Per branch: files, matched, of those case-blind, failed by reason, distinct items; dead branches have a row too."""
    spark = resolved.sparkSession
    every = spark.createDataFrame([(k, b.prefix) for k, b in enumerate(branches)], "branch int, prefix string")
    why = F.col("why")
    got = resolved.groupBy("branch").agg(
        F.count("*").alias("files"), F.count_if(why.isNull()).alias("matched"), F.count_if(F.col("how") == "case-blind").alias("folded"),
        *[F.count_if(why == w).alias(w) for w in ("unidentified", "unmatched", "ambiguous", "archived")], F.count_distinct("itemid").alias("items")
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in got.columns if c != "branch"]
    return every.join(got, "branch", "left").select("prefix", *zero)


def legible(resolved: DataFrame) -> DataFrame:
    """One row: files, those that reach one live item, those no branch covers, and whether all reach one."""
    why = F.col("why")
    return resolved.agg(F.count("*").alias("files"), F.count_if(why.isNull()).alias("matched"), F.count_if(why == "unbranched").alias("unbranched")).withColumn("legible", F.col("files") == F.col("matched"))


def tables_of_forms(resolved: DataFrame, members: DataFrame) -> DataFrame:
    """(form, tables): the tables that the files of a form's members belong to, sorted.

    resolved: sha, itemtable; members: form, sha.
    """
    each = members.join(resolved.filter(F.col("itemtable").isNotNull()).select("sha", "itemtable").distinct(), "sha").select("form", "itemtable").distinct()
    return each.groupBy("form").agg(F.array_join(F.array_sort(F.collect_list("itemtable")), "|").alias("tables"))


def wanted_uploads(uploads: DataFrame, wanted: DataFrame) -> DataFrame:
    """The uploaded files whose content somebody asked for; files nobody asked for are left out.  Both: sha."""
    return uploads.join(wanted.select("sha").distinct(), "sha", "left_semi")
