"""The collection: answers given to every copy, checked, and the sheets and lists that come of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import section_key
from paperloom.operators import answers as A
from paperloom.operators import collect as C
from paperloom.operators import readings as R
from paperloom.operators import sections as S
from paperloom.operators import tree as T
from paperloom.plans.answers import SECTIONS_SQL, SETTLED_SQL, answers, checked, section_ids, sections
from paperloom.plans.corpus import EXCLUDED_EXTENSIONS, EXCLUDED_FOLDERS, PAIRS_SQL, attachments, pairs, sql_fold
from paperloom.plans.registry import query
from paperloom.sources.tables import cut, table

CONFIDENCE_SQL = "CASE WHEN confidence IS NULL OR isnan(confidence) THEN NULL ELSE least(1.0, greatest(0.0, confidence)) END"


def members(spark: SparkSession, folder: str) -> DataFrame:
    """form (session and id) and sha, of forms that do not split by value."""
    forms = table(spark, folder, "forms").filter(F.coalesce(F.size("splitby"), F.lit(0)) <= 0)
    return forms.select(F.concat_ws("/", "sessionid", "id").alias("form"), "sessionid", F.explode("members").alias("sha"))


def form_answers(spark: SparkSession, folder: str) -> DataFrame:
    """One answer for each form of a session: the first that was delivered."""
    said = answers(spark, folder).filter(F.col("viaform").isNotNull() & F.col("sessionid").isNotNull())
    one = F.struct(F.col("documenttemplateid").alias("template"), F.col("proposedtemplate").alias("proposal"), A.confidence_of(F.col("confidence").cast("string")).alias("confidence"), "standsfor", "sampled")
    return said.groupBy(F.concat_ws("/", "sessionid", "viaform").alias("form")).agg(F.min_by(one, "resultid").alias("a")).select("form", "a.*")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every attachment with the id of its reading."""
    found = pairs(spark, folder)
    return found.join(R.reading_ids(found), ["sha", "itemtable"])


def settled(spark: SparkSession, folder: str) -> DataFrame:
    """One verdict for each reading from its own rounds; the better confidence of two that agree."""
    rounds = checked(spark, folder).filter(F.col("readingid").isNotNull() & F.col("viaform").isNull())
    rounds = rounds.select("readingid", F.col("resultid").alias("round"), F.col("documenttemplateid").alias("template"), F.col("proposedtemplate").alias("proposal"), "fault", A.confidence_of(F.col("confidence").cast("string")).alias("confidence"))
    rounds = cut(rounds)
    scores = rounds.groupBy("readingid").agg(F.min_by("confidence", F.when(F.col("fault").isNull(), F.col("round"))).alias("_first"), F.max("confidence").alias("_best"))
    return A.settle(rounds).join(scores, "readingid").withColumn("confidence", F.when(F.col("agreed"), F.col("_best")).otherwise(F.col("_first"))).drop("_first", "_best")


ROUNDS_SQL = SETTLED_SQL[5:].replace("WHERE readingid IS NOT NULL", "WHERE readingid IS NOT NULL AND viaform IS NULL").replace("AS f, count(*)", f"AS f, arg_min({{c}}, resultid) FILTER (fault IS NULL AND {{c}} IS NOT NULL) AS c0, arg_min(struct_pack(c := {{c}}), resultid) FILTER (fault IS NULL) AS c1, max({{c}}) AS best, count(*)".replace("{c}", CONFIDENCE_SQL))
BY_FORM_SQL = f"""mem AS (SELECT DISTINCT sessionid || '/' || id AS form, unnest(members) AS sha FROM forms WHERE len(coalesce(splitby, [])) = 0 AND sessionid IS NOT NULL AND id IS NOT NULL),
said AS (SELECT sessionid || '/' || viaform AS form, arg_min(struct_pack(template := documenttemplateid, proposal := proposedtemplate, confidence := {CONFIDENCE_SQL}, standsfor := standsfor, sampled := sampled), resultid) AS a
  FROM classifications WHERE viaform IS NOT NULL AND sessionid IS NOT NULL GROUP BY 1),
docs AS (SELECT p.*, CASE WHEN i.k = 1 THEN stem ELSE stem || '-' || i.k END AS readingid FROM pairs p JOIN ids i ON i.sha = p.sha AND i.itemtable = p.itemtable),
byform AS (SELECT readingid, arg_min(struct_pack(form := m.form, a := a), m.form) AS f FROM (SELECT DISTINCT readingid, sha FROM docs) d JOIN mem m ON m.sha = d.sha JOIN said USING (form) GROUP BY 1)"""
COLLECT_SQL = f"""{PAIRS_SQL}, {ROUNDS_SQL}, {BY_FORM_SQL}, {SECTIONS_SQL},
held AS (SELECT itemtemplate, label, sortorder, unnest(templates) AS documenttemplateid FROM sec),
arr AS (SELECT itemtemplate, documenttemplateid, arg_min(struct_pack(label, sortorder), struct_pack(sortorder, label)) AS s FROM held GROUP BY 1, 2),
verd AS (SELECT coalesce(s.readingid, b.readingid) AS readingid, s.readingid IS NOT NULL AS own, CASE WHEN s.readingid IS NOT NULL THEN s.f.t ELSE b.f.a.template END AS template,
  CASE WHEN s.readingid IS NOT NULL THEN s.f.p ELSE b.f.a.proposal END AS proposal, CASE WHEN s.readingid IS NULL THEN b.f.a.confidence WHEN held_up > 1 AND different = 1 THEN s.best ELSE s.c1.c END AS confidence,
  coalesce(held_up > 1 AND different = 1, false) AS agreed, coalesce(different > 1, false) AS contested, CASE WHEN held_up = 0 THEN ff END AS fault, s.answers AS rounds,
  CASE WHEN s.readingid IS NULL THEN b.f.form END AS form, CASE WHEN s.readingid IS NULL THEN b.f.a.standsfor END AS standsfor, CASE WHEN s.readingid IS NULL THEN b.f.a.sampled END AS sampled
  FROM settled s FULL JOIN byform b ON b.readingid = s.readingid),
fan AS (SELECT d.source, d.relativepath, d.itemtable, d.itemtemplate, d.readingid, v.readingid IS NOT NULL AS answered, v.* EXCLUDE (readingid), t.name, t.id IS NOT NULL AS known,
  coalesce(t.id IS NOT NULL AND (t.for_tables IS NULL OR len(t.for_tables) = 0 OR list_contains(t.for_tables, d.itemtable)), false) AS allowed
  FROM docs d LEFT JOIN verd v ON v.readingid = d.readingid LEFT JOIN document_templates t ON t.id = v.template),
vd AS (SELECT *, CASE WHEN NOT answered THEN 'unread' WHEN fault IS NOT NULL THEN 'unverified' WHEN coalesce(template, '') <> '' AND NOT known THEN 'unknown template' WHEN coalesce(template, '') <> '' AND NOT allowed THEN 'template not allowed'
  WHEN coalesce(template, '') <> '' THEN 'pick' WHEN trim(coalesce(proposal, '')) <> '' THEN 'proposal' ELSE 'nothing' END AS verdict FROM fan),
col0 AS (SELECT vd.* EXCLUDE (proposal), CASE WHEN verdict = 'pick' THEN template END AS documenttemplateid, CASE WHEN verdict = 'pick' THEN name END AS documenttemplate, CASE WHEN verdict = 'proposal' THEN proposal END AS proposal,
  verdict = 'pick' AND NOT coalesce(agreed, false) AND coalesce(confidence < 0.7, true) AS thin FROM vd),
col AS (SELECT c.*, a.s.label AS section, a.s.sortorder AS sectionsortorder, CASE WHEN verdict = 'unread' THEN 'unread' WHEN verdict = 'unverified' THEN 'unverified' WHEN contested THEN 'contested' WHEN verdict = 'nothing' THEN 'nothing'
  WHEN verdict = 'proposal' THEN 'proposal' WHEN verdict IN ('unknown template', 'template not allowed') THEN 'template not allowed' WHEN a.s IS NULL THEN 'no section' WHEN thin THEN 'thin' END AS why
  FROM col0 c LEFT JOIN arr a ON a.itemtemplate = c.itemtemplate AND a.documenttemplateid = c.documenttemplateid)
"""


def collected(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its verdict, where it goes, and what a person has to look at."""
    docs = cut(documents(spark, folder))
    rounds = settled(spark, folder)
    by_form = C.form_verdicts(docs, members(spark, folder), form_answers(spark, folder))
    verdicts = C.reading_verdicts(rounds.select("readingid", "template", "proposal", "confidence", "agreed", "contested", "fault"), by_form)
    verdicts = verdicts.join(rounds.select("readingid", F.col("answers").alias("rounds")), "readingid", "left")
    return C.checked(C.fan_out(docs, verdicts, docs.count()), table(spark, folder, "document_templates"), sections(spark))


@query(f"{PAIRS_SQL}, {BY_FORM_SQL} SELECT readingid, f.form AS form, f.a.template AS template, f.a.proposal AS proposal, f.a.standsfor AS standsfor, f.a.sampled AS sampled FROM byform")
def form_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that the answer to their form stands for."""
    return C.form_verdicts(documents(spark, folder), members(spark, folder), form_answers(spark, folder)).select("readingid", "form", "template", "proposal", "standsfor", "sampled")


@query(COLLECT_SQL + "SELECT source, readingid, itemtable, verdict, documenttemplateid, documenttemplate, proposal, confidence, section, sectionsortorder, form, standsfor, why, why IS NULL AS usable FROM col")
def collected_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One verdict for every copy of a content, with its section and what to look at."""
    return collected(spark, folder).select("source", "readingid", "itemtable", "verdict", "documenttemplateid", "documenttemplate", "proposal", "confidence", "section", "sectionsortorder", "form", "standsfor", "why", "usable")


REREAD_SQL = "rr AS (SELECT DISTINCT readingid FROM col WHERE why IN ('unverified', 'thin') AND form IS NULL AND coalesce(rounds, 0) < 2)"


@query(COLLECT_SQL + f", {REREAD_SQL} SELECT DISTINCT d.readingid, d.sha, d.itemtable FROM docs d JOIN rr ON rr.readingid = d.readingid")
def second_round(spark: SparkSession, folder: str) -> DataFrame:
    """The readings that are handed out once more."""
    return R.again(documents(spark, folder).select("readingid", "sha", "itemtable").distinct(), C.reread(collected(spark, folder)))


ISSUES_SQL = """, left_out AS (SELECT source FROM (SELECT source, coalesce(list_filter(folders, lambda f: replace(lower(f), 'ß', 'ss') = 'old')[1], CASE WHEN ext = 'msg' THEN 'msg' END) AS x FROM resolved) WHERE x IS NOT NULL),
iss AS (SELECT r.source AS path, coalesce(r.why, CASE WHEN p.read IS NULL THEN 'unreadable' END) AS why FROM resolved r LEFT JOIN pairs p ON p.source = r.source UNION ALL SELECT source, why FROM col WHERE why <> 'thin'),
ranked AS (SELECT path, why, list_position(['unbranched', 'unidentified', 'unmatched', 'ambiguous', 'archived', 'unreadable', 'unread', 'unverified', 'contested', 'nothing', 'proposal', 'template not allowed', 'no section', 'described'], why) AS k
  FROM iss WHERE why IS NOT NULL AND path NOT IN (SELECT source FROM left_out)), issues AS (SELECT path, arg_min(why, k) AS why FROM ranked GROUP BY path)"""


def kept_attachments(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(files that are not left out, with why and read; files that are)."""
    marked = T.exclusions(attachments(spark, folder).withColumnRenamed("why", "issue"), EXCLUDED_FOLDERS, EXCLUDED_EXTENSIONS)
    read = pairs(spark, folder).select("source", "read")
    kept = marked.filter(F.col("why").isNull()).drop("why").withColumnRenamed("issue", "why").join(read, "source", "left")
    return kept.select(F.col("source").alias("path"), "why", "read"), marked.filter(F.col("why").isNotNull()).select(F.col("source").alias("path"))


def issues(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files with issues, data rows, files left out): each file in exactly one of them."""
    kept, ignored = kept_attachments(spark, folder)
    documents = collected(spark, folder).select(F.col("source").alias("path"), "why").join(ignored, "path", "left_anti")
    found = cut(C.files_with_issues(kept, documents))
    return found, documents.join(found, "path", "left_anti").select("path"), ignored


@query(COLLECT_SQL + ISSUES_SQL + " SELECT path, why FROM issues")
def files_with_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Every file that is no data row and was not left out, with its reason; sorted by it."""
    return issues(spark, folder)[0].orderBy("why", "path")


@query(COLLECT_SQL + ISSUES_SQL + """ SELECT 'ignored' AS sheet, '' AS why, count(*)::BIGINT AS files FROM left_out HAVING count(*) > 0 UNION ALL SELECT 'issues', why, count(*)::BIGINT FROM issues GROUP BY why
  UNION ALL SELECT 'data', itemtable, count(*)::BIGINT FROM col WHERE source NOT IN (SELECT path FROM issues) AND source NOT IN (SELECT source FROM left_out) GROUP BY itemtable""")
def reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """How many files each sheet has, by reason or table; together they are all files of the tree."""
    found, data, ignored = issues(spark, folder)
    rows = collected(spark, folder).select(F.col("source").alias("path"), "itemtable").join(data, "path", "left_semi")
    none = ignored.groupBy(F.lit("ignored").alias("sheet"), F.lit("").alias("why")).agg(F.count("*").alias("files"))
    some = found.groupBy(F.lit("issues").alias("sheet"), "why").agg(F.count("*").alias("files"))
    return none.unionByName(some).unionByName(rows.groupBy(F.lit("data").alias("sheet"), F.col("itemtable").alias("why")).agg(F.count("*").alias("files")))


@query(COLLECT_SQL + """, off AS (SELECT itemtemplate, array_to_string(list_sort(list(DISTINCT label)), '|') AS available FROM sec GROUP BY 1),
todo AS (SELECT 'create' AS block, NULL AS itemtemplate, trim(proposal) AS name, count(*)::BIGINT AS documents FROM col WHERE why = 'proposal' GROUP BY 3
  UNION ALL SELECT 'arrange', itemtemplate, documenttemplate, count(*)::BIGINT FROM col WHERE why = 'no section' GROUP BY 2, 3 UNION ALL SELECT 'permit', NULL, itemtable, count(*)::BIGINT FROM col WHERE why = 'template not allowed' GROUP BY 3)
SELECT block, t.itemtemplate, name, documents, coalesce(available, '') AS available FROM todo t LEFT JOIN off ON off.itemtemplate = t.itemtemplate""")
def readme_to_do(spark: SparkSession, folder: str) -> DataFrame:
    """What one person's act clears many documents: templates to create, to arrange, to permit."""
    return C.to_do(collected(spark, folder), sections(spark))


def arranged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(pairs with their table, sections as collected)."""
    return S.section_pairs(answers(spark, folder)), section_ids(spark, folder)


SHEETS_SQL = f"""WITH {SECTIONS_SQL}, prs AS (SELECT DISTINCT itemtemplate, documenttemplateid, documenttemplate, itemtable FROM classifications WHERE coalesce(documenttemplateid, '') <> '' AND coalesce(itemtemplate, '') <> ''),
told AS (SELECT itemtemplate, documenttemplateid, max(nullif(regexp_replace(section, '^[\\s\\x0b\\x1c-\\x1f\\x{{0085}}\\p{{Z}}]+|[\\s\\x0b\\x1c-\\x1f\\x{{0085}}\\p{{Z}}]+$', '', 'g'), '')) AS answered FROM classifications
  WHERE coalesce(documenttemplateid, '') <> '' AND coalesce(itemtemplate, '') <> '' GROUP BY 1, 2),
held AS (SELECT itemtemplate, label, sortorder, unnest(templates) AS documenttemplateid FROM sec), arr AS (SELECT itemtemplate, documenttemplateid, arg_min(label, struct_pack(sortorder, label)) AS arranged FROM held GROUP BY 1, 2),
prs2 AS (SELECT DISTINCT itemtemplate, documenttemplateid, documenttemplate FROM prs),
sc AS (SELECT p.*, coalesce(arranged, answered) AS section FROM prs2 p LEFT JOIN told t ON t.itemtemplate = p.itemtemplate AND t.documenttemplateid = p.documenttemplateid LEFT JOIN arr a ON a.itemtemplate = p.itemtemplate AND a.documenttemplateid = p.documenttemplateid),
ky AS (SELECT *, replace({sql_fold("section")}, ' ', '_') AS key FROM sc), old AS (SELECT itemtemplate, replace({sql_fold("label")}, ' ', '_') AS key, min(sortorder) AS sort_order FROM sec GROUP BY 1, 2),
got AS (SELECT ky.*, CASE WHEN section IS NOT NULL THEN 'ds_' || sha256(ky.itemtemplate || ':' || ky.key)[1:12] END AS sectionid, section IS NOT NULL AND old.key IS NULL AS isnew, old.sort_order FROM ky LEFT JOIN old ON old.itemtemplate = ky.itemtemplate AND old.key = ky.key)
"""


@query(SHEETS_SQL + """SELECT p.documenttemplateid, p.documenttemplate, p.itemtemplate, p.itemtable, coalesce(g.sectionid, '') AS section_id, CASE WHEN coalesce(g.isnew, false) THEN 'yes' ELSE 'no' END AS is_new
FROM prs p LEFT JOIN got g ON g.itemtemplate = p.itemtemplate AND g.documenttemplateid = p.documenttemplateid AND g.documenttemplate = p.documenttemplate""")
def document_templates_sheet(spark: SparkSession, folder: str) -> DataFrame:
    pairs_, collected_ = arranged(spark, folder)
    return C.templates_sheet(pairs_, collected_)


@query(SHEETS_SQL + """, used AS (SELECT itemtemplate, sectionid, key, min(section) AS label, bool_or(isnew) AS isnew, min(sort_order) AS sort_order FROM got WHERE section IS NOT NULL GROUP BY 1, 2, 3)
SELECT label, key, sectionid AS section_id, u.itemtemplate, t.itemtable, sort_order, CASE WHEN isnew THEN 'yes' ELSE 'no' END AS is_new FROM used u LEFT JOIN (SELECT DISTINCT itemtemplate, itemtable FROM prs) t ON t.itemtemplate = u.itemtemplate""")
def document_sections_sheet(spark: SparkSession, folder: str) -> DataFrame:
    pairs_, collected_ = arranged(spark, folder)
    return C.sections_sheet(collected_, sections(spark), pairs_, section_key)
