"""Problem 5: references of the tables to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import blank_to_null, casefold, is_true, strip
from paperloom.operators.references import Parent, Reference, orphan_cascade, orphan_report
from paperloom.plans.registry import query
from paperloom.sources.tables import table


def items_once(items: DataFrame) -> DataFrame:
    """One row for each item: what its latest export says, and when its first one arrived.

    Exports of the same moment: the larger (archived, identifier) counts.  Rows without id name no item.
    """
    latest = F.max_by(F.struct("itemtable", "identifier", "archived"), F.struct("arrivedat", "archived", "identifier"))
    return (
        items.filter(F.col("id").isNotNull()).groupBy("id").agg(latest.alias("l"), F.min("arrivedat").alias("since"))
        .select("id", "l.itemtable", "l.identifier", is_true(F.col("l.archived")).alias("withdrawn"), "since")
    )


def references(spark: SparkSession, folder: str) -> list[Reference]:
    """The graph: answers name items and templates, and the readings of their file; readings name files.

    A reading of a file that is not there hands that on to the answers of its path.
    """
    answers = table(spark, folder, "classifications").select("resultid", "itemtable", "identifier", "itemid", "documenttemplateid", "path", "classifiedat")
    extracted = table(spark, folder, "extracted").select("extractid", "path", "extractedat")
    items = items_once(table(spark, folder, "items"))
    templates = table(spark, folder, "document_templates")
    row, at, path = F.col("resultid"), F.col("classifiedat"), blank_to_null(F.col("path"))
    by_id = Parent("items", items, F.col("id"), withdrawn=F.col("withdrawn"), since=F.col("since"))
    by_identifier = Parent("items", items, blank_to_null(casefold(strip(F.col("identifier")))), F.coalesce("itemtable", F.lit("")), F.col("withdrawn"), F.col("since"))
    by_template = Parent("document_templates", templates, F.col("id"), withdrawn=F.col("retiredat").isNotNull(), since=F.col("addedat"))
    return [
        Reference("itemId", "classifications", answers, row, blank_to_null(F.col("itemid")), by_id, at),
        Reference("identifier", "classifications", answers, row, blank_to_null(casefold(strip(F.col("identifier")))), by_identifier, at, F.coalesce("itemtable", F.lit(""))),
        Reference("documentTemplateId", "classifications", answers, row, blank_to_null(F.col("documenttemplateid")), by_template, at),
        Reference("classifications.path", "classifications", answers, row, path, Parent("extracted", extracted, F.col("path")), at),
        Reference("extracted.path", "extracted", extracted, F.col("extractid"), path, Parent("files", table(spark, folder, "files"), F.col("path")), F.col("extractedat"), own=path),
    ]


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    """All orphans of the graph, direct and inherited."""
    rows = 4 * table(spark, folder, "classifications").count() + table(spark, folder, "extracted").count()
    return orphan_cascade(references(spark, folder), rows)


SPACE = r"[\s\x{0085}\p{Z}\x1c-\x1f]"

FOUND_SQL = rf"""
WITH latest AS (
  SELECT id, itemtable, identifier, lower(regexp_replace(coalesce(archived, ''), '^{SPACE}+|{SPACE}+$', '', 'g')) IN ('true', 't', 'yes', 'y', '1') AS gone,
         min(arrivedat) OVER (PARTITION BY id) AS since,
         row_number() OVER (PARTITION BY id ORDER BY arrivedat DESC NULLS LAST, archived DESC NULLS LAST, identifier DESC NULLS LAST) AS k
  FROM items WHERE id IS NOT NULL),
item AS (SELECT *, replace(lower(regexp_replace(identifier, '^{SPACE}+|{SPACE}+$', '', 'g')), 'ß', 'ss') AS folded FROM latest WHERE k = 1),
dims AS (
  SELECT 'itemId' AS fieldname, '' AS scope, id AS key, bool_and(gone) AS gone, min(since) AS since FROM item GROUP BY id
  UNION ALL SELECT 'identifier', coalesce(itemtable, ''), folded, bool_and(gone), min(since) FROM item WHERE folded <> '' GROUP BY 2, 3
  UNION ALL SELECT 'documentTemplateId', '', id, bool_and(retiredat IS NOT NULL), min(addedat) FROM document_templates GROUP BY id),
refs AS (
  SELECT 'itemId' AS fieldname, '' AS scope, itemid AS key, itemid AS raw, resultid, classifiedat FROM classifications
  UNION ALL SELECT 'identifier', coalesce(itemtable, ''), replace(lower(regexp_replace(identifier, '^{SPACE}+|{SPACE}+$', '', 'g')), 'ß', 'ss'), identifier, resultid, classifiedat FROM classifications
  UNION ALL SELECT 'documentTemplateId', '', documenttemplateid, documenttemplateid, resultid, classifiedat FROM classifications),
orphans AS (
  SELECT r.fieldname, r.resultid, r.classifiedat,
         CASE WHEN d.key IS NULL THEN 'missing' WHEN d.gone THEN 'deleted' WHEN d.since > r.classifiedat THEN 'late' END AS why
  FROM refs r LEFT JOIN dims d ON d.fieldname = r.fieldname AND d.scope = r.scope AND d.key = r.key
  WHERE regexp_replace(r.raw, '{SPACE}+', '', 'g') <> '')
"""


@query(FOUND_SQL + "SELECT fieldname, resultid, why FROM orphans WHERE why IS NOT NULL")
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The answers whose item or template is missing, withdrawn or late; no answer inherits through these fields."""
    found = orphans(spark, folder).filter(F.col("_ref").isin("itemId", "identifier", "documentTemplateId") & (F.col("_why") != "inherited"))
    return found.select(F.col("_ref").alias("fieldname"), F.col("_row").alias("resultid"), F.col("_why").alias("why"))


CHAIN_SQL = FOUND_SQL + """,
bad_reading AS (SELECT extractid, path, extractedat FROM extracted e WHERE trim(path) <> '' AND NOT EXISTS (SELECT 1 FROM files f WHERE f.path = e.path)),
chain AS (
  SELECT 'extracted.path' AS fieldname, extractedat AS moment, 'missing' AS why FROM bad_reading
  UNION ALL SELECT 'classifications.path', classifiedat, 'missing' FROM classifications c WHERE trim(path) <> '' AND NOT EXISTS (SELECT 1 FROM extracted e WHERE e.path = c.path)
  UNION ALL SELECT 'classifications.path', classifiedat, 'inherited' FROM classifications c WHERE EXISTS (SELECT 1 FROM bad_reading b WHERE b.path = c.path)),
every AS (SELECT fieldname, classifiedat AS moment, why FROM orphans WHERE why IS NOT NULL UNION ALL SELECT * FROM chain)
"""


@query(CHAIN_SQL + "SELECT fieldname, strftime(moment, '%Y-%m') AS month, why, count(*)::BIGINT AS orphans FROM every GROUP BY ALL")
def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans of all references by month and reason, direct ones beside inherited ones."""
    return orphan_report(orphans(spark, folder))


@query(CHAIN_SQL + """SELECT fieldname, (count(*) FILTER (why <> 'inherited'))::BIGINT AS direct, (count(*) FILTER (why = 'inherited'))::BIGINT AS inherited FROM every GROUP BY fieldname""")
def p5_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """How many orphans of each reference are direct and how many inherit it."""
    why = F.col("_why")
    return orphans(spark, folder).groupBy(F.col("_ref").alias("fieldname")).agg(F.count_if(why != "inherited").alias("direct"), F.count_if(why == "inherited").alias("inherited"))
