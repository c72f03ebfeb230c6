"""Answers to attachments: roll call, checks, verdicts, sections, contradictions, names against the closed list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import casefold, name_words, normalise, strip
from paperloom.operators import answers as A
from paperloom.operators import audit as U
from paperloom.operators import sections as S
from paperloom.plans.corpus import sql_fold, sql_strip
from paperloom.plans.registry import query
from paperloom.sources.tables import table

# The arrangement of sections, written by hand: item template, label, sort order, templates.
SECTIONS = [
    ("Active", "Safety", 0, ["dt_0104", "dt_0109"]), ("Active", "Quality", 1, ["dt_0115", "dt_0104"]), ("Pigment", "Quality", 1, ["dt_0104"]), ("Raw Material", "Supply", 2, ["dt_0109", "dt_0115"]),
    ("Raw Material", "Regulatory", 3, ["dt_0115"]), ("Outer Pack", "Packaging", 4, []), ("Solvent Grade", "Safety & Handling", 0, ["dt_0104"]),
]
SECTIONS_SQL = "sec(itemtemplate, label, sortorder, templates) AS (VALUES " + ", ".join(f"('{a}', '{b}', {c}, {d!r}::VARCHAR[])" for a, b, c, d in SECTIONS) + ")"
BLANK = "coalesce({c}, '') <> ''"


def answers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "classifications")


def sections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTIONS, "itemtemplate string, label string, sortorder int, templates array<string>")


def shown(spark: SparkSession, folder: str) -> DataFrame:
    """(path, told): the text of each path's latest record."""
    return table(spark, folder, "extracted").groupBy("path").agg(F.max_by("textfile", F.struct("extractedat", "extractid")).alias("told"))


TOLD_SQL = "told AS (SELECT path, textfile AS told FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY extractedat DESC, extractid DESC) AS k FROM extracted) WHERE k = 1)"
FAULT_SQL = f"""{TOLD_SQL}, checked AS (SELECT c.*, CASE WHEN coalesce(t.told, '') = '' THEN NULL WHEN {sql_fold("coalesce(c.quote, '')")} = '' THEN 'no quote'
  WHEN len({sql_fold("coalesce(c.quote, '')")}) < 12 THEN 'quote too short' WHEN NOT contains({sql_fold("t.told")}, {sql_fold("coalesce(c.quote, '')")}) THEN 'quote not in the text' END AS fault
  FROM classifications c LEFT JOIN told t ON t.path = c.path)"""


def checked(spark: SparkSession, folder: str) -> DataFrame:
    return answers(spark, folder).join(shown(spark, folder), "path", "left").withColumn("fault", A.quote_fault(F.col("told"), F.col("quote")))


@query(f"WITH {FAULT_SQL} SELECT resultid, fault FROM checked")
def quote_check(spark: SparkSession, folder: str) -> DataFrame:
    return checked(spark, folder).select("resultid", "fault")


@query("""WITH t AS (SELECT DISTINCT readingid, itemtable FROM classifications WHERE readingid IS NOT NULL),
g AS (SELECT DISTINCT readingid FROM classifications WHERE coalesce(review, '') <> 'nothing to read')
SELECT t.itemtable, count(*)::BIGINT AS sent, count(g.readingid)::BIGINT AS answered, (count(*) - count(g.readingid))::BIGINT AS missing FROM t LEFT JOIN g USING (readingid) GROUP BY 1""")
def roll_call(spark: SparkSession, folder: str) -> DataFrame:
    """Readings handed out per table, and those that came back with something."""
    tasks = answers(spark, folder).filter(F.col("readingid").isNotNull()).select("readingid", "itemtable").distinct()
    back = answers(spark, folder).filter(F.coalesce("review", F.lit("")) != "nothing to read")
    return A.roll_call(tasks, back, "readingid", "itemtable")


SAME_SQL = f"CASE WHEN {BLANK.format(c='documenttemplateid')} THEN 't:' || documenttemplateid ELSE 'p:' || " + r"trim(regexp_replace(regexp_replace(replace(lower(coalesce(proposedtemplate, '')), 'ß', 'ss'), '[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{0085}\p{Z}]+', ' ', 'g'), '[\s\x0b\x1c-\x1f\x{0085}\p{Z}]+', ' ', 'g')) END"
SETTLED_SQL = f"""WITH {FAULT_SQL}, same AS (SELECT *, {SAME_SQL} AS same FROM checked WHERE readingid IS NOT NULL),
settled AS (SELECT readingid, arg_min(struct_pack(t := documenttemplateid, p := proposedtemplate), resultid) FILTER (fault IS NULL) AS f, count(*)::BIGINT AS answers, (count(*) FILTER (fault IS NULL))::BIGINT AS held_up,
  count(DISTINCT same) FILTER (fault IS NULL) AS different, arg_min(fault, resultid) FILTER (fault IS NOT NULL) AS ff FROM same GROUP BY readingid)
"""


@query(SETTLED_SQL + "SELECT readingid, f.t AS template, f.p AS proposal, answers, held_up, held_up > 1 AND different = 1 AS agreed, different > 1 AS contested, CASE WHEN held_up = 0 THEN ff END AS fault FROM settled")
def settled_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """One verdict for each reading: what was delivered for it, in order, counts as its rounds."""
    rounds = checked(spark, folder).filter(F.col("readingid").isNotNull())
    return A.settle(rounds.select("readingid", F.col("resultid").alias("round"), F.col("documenttemplateid").alias("template"), F.col("proposedtemplate").alias("proposal"), "fault"))


VERDICT_SQL = FAULT_SQL + """, v AS (SELECT c.*, d.id IS NOT NULL AS known, coalesce(d.id IS NOT NULL AND (d.for_tables IS NULL OR len(d.for_tables) = 0 OR list_contains(d.for_tables, c.itemtable)), false) AS allowed
  FROM checked c LEFT JOIN document_templates d ON d.id = c.documenttemplateid),
w AS (SELECT *, CASE WHEN review = 'nothing to read' THEN 'unread' WHEN fault IS NOT NULL THEN 'unverified' WHEN coalesce(documenttemplateid, '') <> '' AND NOT known THEN 'unknown template'
  WHEN coalesce(documenttemplateid, '') <> '' AND NOT allowed THEN 'template not allowed' WHEN coalesce(documenttemplateid, '') <> '' THEN 'pick' WHEN trim(coalesce(proposedtemplate, '')) <> '' THEN 'proposal' ELSE 'nothing' END AS verdict FROM v)"""


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "document_templates").select(F.col("id").alias("documenttemplateid"), "for_tables", F.lit(True).alias("_known"))
    met = checked(spark, folder).join(known, "documenttemplateid", "left")
    there = F.col("_known").isNotNull()
    allowed = F.coalesce(there & (F.col("for_tables").isNull() | (F.size("for_tables") == 0) | F.array_contains("for_tables", F.col("itemtable"))), F.lit(False))
    unread = F.coalesce(F.col("review") == "nothing to read", F.lit(False))
    return met.withColumn("verdict", A.verdict(unread, F.col("fault"), F.col("documenttemplateid"), there, allowed, F.col("proposedtemplate")))


@query(f"WITH {VERDICT_SQL} SELECT resultid, verdict FROM w")
def classifications(spark: SparkSession, folder: str) -> DataFrame:
    return verdicts(spark, folder).select("resultid", "verdict")


@query(f"WITH {VERDICT_SQL}, {SETTLED_SQL[5:].replace(FAULT_SQL + ',', '')} SELECT DISTINCT w.readingid FROM w JOIN settled s ON s.readingid = w.readingid WHERE verdict = 'pick' AND viaform IS NULL AND NOT (held_up > 1 AND different = 1) AND (confidence IS NULL OR isnan(confidence) OR least(1.0, greatest(0.0, confidence)) < 0.7)")
def reread_list(spark: SparkSession, folder: str) -> DataFrame:
    """Readings whose template was chosen with too little confidence and on which no rounds agree; answers by form are
    read again as forms."""
    picks = verdicts(spark, folder).filter((F.col("verdict") == "pick") & F.col("viaform").isNull() & F.col("readingid").isNotNull())
    agreed = settled_verdicts(spark, folder).select("readingid", "agreed")
    confidence = A.confidence_of(F.col("confidence").cast("string"))
    return picks.join(agreed, "readingid").filter(A.thin_margin(F.col("documenttemplateid"), F.col("agreed"), confidence)).select("readingid").distinct()


@query("""WITH c AS (SELECT CASE WHEN confidence IS NULL OR isnan(confidence) THEN NULL ELSE least(1.0, greatest(0.0, confidence)) END AS c FROM classifications)
SELECT CASE WHEN c IS NULL THEN 'none' WHEN c >= 0.9 THEN '>=0.9' WHEN c >= 0.7 THEN '>=0.7' WHEN c >= 0.5 THEN '>=0.5' ELSE '<0.5' END AS bucket, count(*)::BIGINT AS answers FROM c GROUP BY 1""")
def confidence_histogram(spark: SparkSession, folder: str) -> DataFrame:
    bucket = A.confidence_bucket(A.confidence_of(F.col("confidence").cast("string")))
    return answers(spark, folder).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("answers"))


@query(r"""WITH p AS (SELECT proposedtemplate, trim(regexp_replace(regexp_replace(replace(lower(proposedtemplate), 'ß', 'ss'), '[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{0085}\p{Z}]+', ' ', 'g'), '[\s\x0b\x1c-\x1f\x{0085}\p{Z}]+', ' ', 'g')) AS k
  FROM classifications WHERE trim(coalesce(proposedtemplate, '')) <> '') SELECT min(proposedtemplate) AS spelling, count(*)::BIGINT AS documents FROM p GROUP BY k""")
def proposed_names(spark: SparkSession, folder: str) -> DataFrame:
    return U.proposed_names(answers(spark, folder))


ONE_SQL = """one AS (SELECT readingid, arg_min(struct_pack(called := called, quote := quote, evidence := evidence, sha := sha), struct_pack(path, resultid)) AS f FROM (
  SELECT *, coalesce(nullif(trim(documenttemplate), ''), 'proposed: ' || nullif(trim(proposedtemplate), '')) AS called FROM classifications WHERE viaform IS NULL AND readingid IS NOT NULL) WHERE called IS NOT NULL GROUP BY readingid),
alone AS (SELECT readingid, f.called AS called, f.quote AS quote, f.evidence AS evidence, f.sha AS sha FROM one)"""


@query(f"""WITH {ONE_SQL}, q AS (SELECT {sql_fold("coalesce(quote, '')")} AS quote, called FROM alone), e AS (SELECT quote, called, count(*) AS n FROM q WHERE len(quote) >= 12 GROUP BY 1, 2)
SELECT quote, count(*)::BIGINT AS names, sum(n)::BIGINT AS answers, array_to_string(list(called || '=' || n ORDER BY called), '|') AS templates FROM e GROUP BY quote HAVING count(*) > 1""")
def quote_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return U.quote_collisions(U.one_at_a_time(answers(spark, folder)))


@query(f"""WITH {ONE_SQL}, m AS (SELECT sha, min(formkey) AS form FROM (SELECT formkey, unnest(members) AS sha FROM forms) GROUP BY sha),
e AS (SELECT {sql_fold("coalesce(evidence, '')")} AS evidence, m.form FROM alone a LEFT JOIN m ON m.sha = a.sha)
SELECT evidence, count(DISTINCT form)::BIGINT AS forms, count(*)::BIGINT AS answers FROM e WHERE len(evidence) >= 12 GROUP BY evidence HAVING count(DISTINCT form) > 1""")
def evidence_reuse_across_forms(spark: SparkSession, folder: str) -> DataFrame:
    form = table(spark, folder, "forms").select("formkey", F.explode("members").alias("sha")).groupBy("sha").agg(F.min("formkey").alias("form"))
    return U.evidence_reuse(U.one_at_a_time(answers(spark, folder)).join(form, "sha", "left"))


@query(f"""WITH {ONE_SQL}, ph AS (SELECT DISTINCT p FROM (SELECT {sql_fold("unnest([trim(phrase), trim(regexp_replace(regexp_replace(phrase, '[(][^)]*[)]', ' ', 'g'), ' +', ' ', 'g'))])")} AS p FROM type_phrases) WHERE len(p) > 8 AND len(p) <= 60),
a AS (SELECT readingid, {sql_fold("called")} AS called, {sql_fold("concat_ws(' ', quote, evidence)")} AS told FROM alone)
SELECT p AS phrase, count(DISTINCT readingid)::BIGINT AS answers FROM a JOIN ph ON contains(told, p) AND NOT contains(called, p) GROUP BY p""")
def named_but_not_picked(spark: SparkSession, folder: str) -> DataFrame:
    return U.named_but_not_picked(U.one_at_a_time(answers(spark, folder)), table(spark, folder, "type_phrases"))


@query("""SELECT itemtemplate, documenttemplateid, documenttemplate, itemtable, count(*)::BIGINT AS documents FROM classifications
WHERE coalesce(documenttemplateid, '') <> '' AND coalesce(itemtemplate, '') <> '' GROUP BY ALL""")
def section_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return S.section_pairs(answers(spark, folder))


PAIRS_SQL = f"""WITH {SECTIONS_SQL}, pairs AS (SELECT itemtemplate, documenttemplateid, documenttemplate, count(*)::BIGINT AS documents, max(nullif({sql_strip("section")}, '')) AS answered FROM classifications
  WHERE coalesce(documenttemplateid, '') <> '' AND coalesce(itemtemplate, '') <> '' GROUP BY 1, 2, 3),
held AS (SELECT itemtemplate, label, sortorder, unnest(templates) AS documenttemplateid FROM sec),
arr AS (SELECT itemtemplate, documenttemplateid, arg_min(label, struct_pack(sortorder, label)) AS arranged FROM held GROUP BY 1, 2)"""


@query(PAIRS_SQL + f""", s AS (SELECT p.*, coalesce(arranged, answered) AS section, arranged FROM pairs p LEFT JOIN arr USING (itemtemplate, documenttemplateid)),
k AS (SELECT *, replace({sql_fold("section")}, ' ', '_') AS key FROM s)
SELECT k.itemtemplate, documenttemplateid, documenttemplate, documents, section, CASE WHEN section IS NOT NULL THEN 'ds_' || sha256(k.itemtemplate || ':' || key)[1:12] END AS sectionid,
  section IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sec WHERE sec.itemtemplate = k.itemtemplate AND replace({sql_fold("sec.label")}, ' ', '_') = k.key) AS isnew,
  arranged IS NOT NULL AND answered IS NOT NULL AND replace({sql_fold("arranged")}, ' ', '_') <> replace({sql_fold("answered")}, ' ', '_') AS kept FROM k""")
def section_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The section of each template within each item template, arranged or answered, and its derived id."""
    pairs = S.section_pairs(answers(spark, folder)).groupBy("itemtemplate", "documenttemplateid", "documenttemplate").agg(F.sum("documents").alias("documents"))
    some = answers(spark, folder).filter((F.coalesce("documenttemplateid", F.lit("")) != "") & (F.coalesce("itemtemplate", F.lit("")) != ""))
    said = some.groupBy("itemtemplate", "documenttemplateid", "documenttemplate").agg(F.max(F.nullif(strip(F.col("section")), F.lit(""))).alias("section"))
    told = said.groupBy("itemtemplate", "documenttemplateid").agg(F.max("section").alias("section"))
    return S.collect_sections(pairs, told, sections(spark))


@query(PAIRS_SQL + """, off AS (SELECT itemtemplate, array_to_string(list_sort(list(DISTINCT label)), '|') AS available FROM sec GROUP BY 1)
SELECT p.itemtemplate, documenttemplate, sum(documents)::BIGINT AS documents, coalesce(any_value(available), '') AS available FROM pairs p LEFT JOIN off USING (itemtemplate)
WHERE NOT EXISTS (SELECT 1 FROM arr WHERE arr.itemtemplate = p.itemtemplate AND arr.documenttemplateid = p.documenttemplateid) GROUP BY 1, 2""")
def unarranged_templates(spark: SparkSession, folder: str) -> DataFrame:
    return S.unarranged(answers(spark, folder), sections(spark))


def template_names(spark: SparkSession, folder: str) -> DataFrame:
    words = F.array_join(name_words(F.col("name")), " ")
    return table(spark, folder, "document_templates").filter(F.col("name").isNotNull()).select("name", words.alias("words")).distinct().filter("words <> ''")


@query()
def vocabulary_gap(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of forms and the nearest names of the closed list; a score under 0.6 is a gap."""
    titles = table(spark, folder, "vocabulary_gap").filter(F.col("title").isNotNull()).select("title").distinct()
    titles = titles.select("title", F.array_join(name_words(F.col("title")), " ").alias("words")).filter("words <> ''")
    return U.nearest_names(titles, template_names(spark, folder))


@query("SELECT sum(documents)::BIGINT AS documents, count(*)::BIGINT AS forms FROM vocabulary_gap WHERE coalesce(trim(title), '') <> ''")
def gap_total(spark: SparkSession, folder: str) -> DataFrame:
    gaps = table(spark, folder, "vocabulary_gap").filter(F.coalesce(F.trim("title"), F.lit("")) != "")
    return gaps.agg(F.sum("documents").cast("bigint").alias("documents"), F.count("*").alias("forms"))


@query()
def near_misses(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers of answers that no item has, and the items' identifiers they come near to."""
    key = lambda c: casefold(normalise(F.col(c)))
    index = table(spark, folder, "items").filter(F.col("identifier").isNotNull()).select("itemtable", key("identifier").alias("identifier")).filter("identifier <> ''").distinct()
    used = answers(spark, folder).filter(F.col("identifier").isNotNull()).select("itemtable", key("identifier").alias("identifier")).filter("identifier <> ''").distinct()
    return U.near_misses(used.join(index, ["itemtable", "identifier"], "left_anti"), index)


@query("""SELECT itemtable, identifier, itemname, documenttemplate, section, sectionsortorder, confidence, evidence, quote, review, path FROM classifications WHERE coalesce(documenttemplateid, '') <> ''""")
def workbook_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the data sheets, one sheet for each table."""
    rows = answers(spark, folder).filter(F.coalesce("documenttemplateid", F.lit("")) != "")
    return rows.select("itemtable", "identifier", "itemname", "documenttemplate", "section", "sectionsortorder", "confidence", "evidence", "quote", "review", "path")


@query(r"""SELECT gapid, CASE WHEN len(c) <= 24 THEN c ELSE regexp_replace(CASE WHEN contains(left(c, 24), ' ') AND len(left(c, 24)) - (position(' ' IN reverse(left(c, 24)))) > 24 * 0.6
  THEN left(c, (len(left(c, 24)) - position(' ' IN reverse(left(c, 24))))::INT) ELSE left(c, 24) END, '[ .,;:-]+$', '') END AS title
FROM (SELECT gapid, trim(regexp_replace(title, '[\s\x0b\x1c-\x1f\x{0085}\p{Z}]+', ' ', 'g')) AS c FROM vocabulary_gap)""")
def trimmed_titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "vocabulary_gap").select("gapid", A.trimmed(F.col("title"), 24).alias("title"))
