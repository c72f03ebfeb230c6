"""From answers to documents: one verdict for each reading, given to every copy, checked, and what is left to do.

A reading is one content on one table; its verdict comes from the rounds read of it or, where it was not read itself,
from the answer to its form.  Rows of all frames may repeat; keys that are null meet nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.answers import thin_margin
from paperloom.operators.sections import section_of
from paperloom.operators.skew import lookup, small
from paperloom.options import AnswerOptions

#: Why a file is no row of a data sheet: from its folder, from its text, from its answer, or as someone told.
REASONS = (
    "unbranched", "unidentified", "unmatched", "ambiguous", "archived", "unreadable", "unread", "unverified", "contested", "nothing", "proposal", "template not allowed", "no section", "described",
)


def form_verdicts(readings: DataFrame, members: DataFrame, answers: DataFrame) -> DataFrame:
    """(readingid, form, template, proposal, confidence, standsfor, sampled): readings that their form's answer stands for.

    readings: readingid, sha; members: form, sha; answers: form and the other columns, one row for each form.  A reading
    whose content is in several answered forms takes the first form's.
    """
    fields = ["form", "template", "proposal", "confidence", "standsfor", "sampled"]
    met = readings.select("readingid", "sha").distinct().join(members.select("form", "sha").distinct(), "sha").join(small(answers.select(*fields)), "form")
    return met.groupBy("readingid").agg(F.min_by(F.struct(*fields), "form").alias("f")).select("readingid", "f.*")


def reading_verdicts(settled: DataFrame, by_form: DataFrame) -> DataFrame:
    """One row for each reading that was answered at all: what was read of it comes before the answer to its form.

    settled: readingid, template, proposal, confidence, agreed, contested, fault; by_form: as of ``form_verdicts``.
    """
    own = settled.withColumn("_own", F.lit(True)).withColumnsRenamed({c: f"_{c}" for c in ("template", "proposal", "confidence")})
    both = own.join(by_form, "readingid", "full_outer")
    mine = F.col("_own").isNotNull()
    pick = lambda c: F.when(mine, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    form_only = lambda c: F.when(~mine, F.col(c)).alias(c)
    no = F.lit(False)
    return both.select(
        "readingid", pick("template"), pick("proposal"), pick("confidence"), F.coalesce("agreed", no).alias("agreed"), F.coalesce("contested", no).alias("contested"), "fault",
        form_only("form"), form_only("standsfor"), form_only("sampled"),
    )


def fan_out(documents: DataFrame, verdicts: DataFrame, rows: int | None = None) -> DataFrame:
    """Each document with the verdict of its reading; ``answered`` is false where there is none.

    A content with a third of all files is one reading with that many copies; its rows are not brought to one task.
    """
    rows = documents.count() if rows is None else rows
    return lookup(documents, verdicts.withColumn("answered", F.lit(True)), ["readingid"], rows).withColumn("answered", F.coalesce("answered", F.lit(False)))


def checked(fanned: DataFrame, templates: DataFrame, sections: DataFrame, options: AnswerOptions = AnswerOptions()) -> DataFrame:
    """Adds verdict, documenttemplate, section, sectionsortorder, thin, why and usable to fanned-out documents.

    templates: id, name, for_tables (empty for all); sections: as of ``sections.section_of``.  verdict, the first that
    applies: unread, unverified, unknown template, template not allowed, pick, proposal, nothing.  Only a pick keeps its
    template.  why: what a person has to look at first, one of ``REASONS``, or ``thin``; null where nothing is.  A
    contested reading keeps its first verdict and is reported.  usable: a pick that nobody has to look at.
    """
    known = templates.select(F.col("id").alias("template"), F.col("name").alias("_name"), "for_tables", F.lit(True).alias("_known"))
    met = fanned.join(small(known), "template", "left")
    has = F.coalesce("template", F.lit("")) != ""
    everywhere = F.col("for_tables").isNull() | (F.size("for_tables") == 0)
    allowed = F.coalesce(everywhere | F.array_contains("for_tables", F.col("itemtable")), F.lit(False))
    verdict = (
        F.when(~F.col("answered"), "unread").when(F.col("fault").isNotNull(), "unverified").when(has & F.col("_known").isNull(), "unknown template").when(has & ~allowed, "template not allowed")
        .when(has, "pick").when(F.trim(F.coalesce("proposal", F.lit(""))) != "", "proposal").otherwise("nothing")
    )
    told = met.withColumn("verdict", verdict)
    picked = F.col("verdict") == "pick"
    told = told.withColumns({"documenttemplateid": F.when(picked, F.col("template")), "documenttemplate": F.when(picked, F.col("_name")), "proposal": F.when(F.col("verdict") == "proposal", F.col("proposal"))})
    where = section_of(sections).withColumnRenamed("sortorder", "sectionsortorder")
    placed = told.join(small(where), ["itemtemplate", "documenttemplateid"], "left")
    thin = picked & thin_margin(F.col("documenttemplateid"), F.col("agreed"), F.col("confidence"), options)
    why = (
        F.when(F.col("verdict") == "unread", "unread").when(F.col("verdict") == "unverified", "unverified").when(F.col("contested"), "contested").when(F.col("verdict") == "nothing", "nothing")
        .when(F.col("verdict") == "proposal", "proposal").when(F.col("verdict").isin("unknown template", "template not allowed"), "template not allowed")
        .when(F.col("section").isNull(), "no section").when(thin, "thin")
    )
    out = placed.withColumns({"thin": thin, "why": why}).withColumn("usable", F.col("why").isNull())
    return out.drop("template", "for_tables", "_name", "_known")


def reread(documents: DataFrame) -> DataFrame:
    """(readingid): what is read again: not verified or with a thin margin, unless a form answered or two rounds did.

    documents: as of ``checked``, with ``rounds``, how many answers its reading has.
    """
    again = F.col("why").isin("unverified", "thin") & F.col("form").isNull() & (F.coalesce("rounds", F.lit(0)) < 2)
    return documents.filter(again).select("readingid").distinct()


def files_with_issues(attachments: DataFrame, documents: DataFrame, described: DataFrame | None = None) -> DataFrame:
    """(path, why): every file that is no data row and was not left out, once, with the first reason that applies.

    attachments: path, why (from resolving, null where an item is reached), read (null where nothing can be read);
    documents: path, why; described: path, of files that somebody told about instead of their being read.
    """
    at = attachments.select("path", F.coalesce("why", F.when(F.col("read").isNull(), "unreadable")).alias("why"))
    parts = [at, documents.select("path", F.when(F.col("why") != "thin", F.col("why")).alias("why"))]
    if described is not None:
        parts.append(described.select("path", F.lit("described").alias("why")))
    place = reduce(lambda e, k: e.when(F.col("why") == REASONS[k], k), range(len(REASONS)), F.when(F.lit(False), -1))
    found = reduce(DataFrame.unionByName, [p.filter(F.col("why").isNotNull()) for p in parts])
    return found.groupBy("path").agg(F.min_by("why", place).alias("why"))


def to_do(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """(block, itemtemplate, name, documents, available): what one person's act clears many documents.

    ``create``: a proposed template and the documents that wait for it; ``arrange``: a template that no section of an
    item template holds, and the sections there are; ``permit``: a template that is not allowed where it was chosen.
    """
    offered = sections.groupBy("itemtemplate").agg(F.array_join(F.array_sort(F.collect_set("label")), "|").alias("available"))
    none = F.lit(None).cast("string")
    create = documents.filter(F.col("why") == "proposal").groupBy(F.lit("create").alias("block"), none.alias("itemtemplate"), F.trim("proposal").alias("name")).agg(F.count("*").alias("documents"))
    arrange = documents.filter(F.col("why") == "no section").groupBy(F.lit("arrange").alias("block"), "itemtemplate", F.col("documenttemplate").alias("name")).agg(F.count("*").alias("documents"))
    permit = documents.filter(F.col("why") == "template not allowed").groupBy(F.lit("permit").alias("block"), none.alias("itemtemplate"), F.col("itemtable").alias("name")).agg(F.count("*").alias("documents"))
    return reduce(DataFrame.unionByName, [create, arrange, permit]).join(offered, "itemtemplate", "left").select("block", "itemtemplate", "name", "documents", F.coalesce("available", F.lit("")).alias("available"))


def yes_no(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "yes").otherwise("no")


def templates_sheet(pairs: DataFrame, collected: DataFrame) -> DataFrame:
    """One row for each template, item template and table: its section's id (empty without one), whether that is new.

    pairs: itemtemplate, documenttemplateid, documenttemplate, itemtable; collected: as of ``sections.collect_sections``.
    """
    where = collected.select("itemtemplate", "documenttemplateid", "documenttemplate", "sectionid", "isnew")
    joined = pairs.select("itemtemplate", "documenttemplateid", "documenttemplate", "itemtable").distinct().join(where, ["itemtemplate", "documenttemplateid", "documenttemplate"], "left")
    return joined.select("documenttemplateid", "documenttemplate", "itemtemplate", "itemtable", F.coalesce("sectionid", F.lit("")).alias("section_id"), yes_no(F.col("isnew")).alias("is_new"))


def sections_sheet(collected: DataFrame, sections: DataFrame, tables: DataFrame, key) -> DataFrame:
    """One row for each section that holds a template: label, key, derived id, item template, table, order, whether new.

    tables: itemtemplate, itemtable.  Of several spellings of one label the first counts; new sections have no order.
    """
    used = collected.filter(F.col("section").isNotNull()).groupBy("itemtemplate", "sectionid", key(F.col("section")).alias("key")).agg(F.min("section").alias("label"), F.max("isnew").alias("isnew"))
    order = sections.groupBy("itemtemplate", key(F.col("label")).alias("key")).agg(F.min("sortorder").alias("sort_order"))
    joined = used.join(order, ["itemtemplate", "key"], "left").join(tables.select("itemtemplate", "itemtable").distinct(), "itemtemplate", "left")
    return joined.select("label", "key", F.col("sectionid").alias("section_id"), "itemtemplate", "itemtable", "sort_order", yes_no(F.col("isnew")).alias("is_new"))
