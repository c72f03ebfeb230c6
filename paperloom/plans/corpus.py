"""Folder to attachments: tree, exclusions, items, resolution, readings and batches over one folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import blank_to_null, casefold, letters, strip
from paperloom.operators import readings as R
from paperloom.operators import resolve as J
from paperloom.operators import tree as T
from paperloom.operators import vocabulary as V
from paperloom.plans.registry import query
from paperloom.sources.files import capped, kind_of, pages_to_render, slug, sniff, true_extension
from paperloom.sources.tables import table

TABLES = ["products", "raw_materials", "packaging"]
TEMPLATES = ["Active", "Finished Product", "Intermediate", "Outer Pack", "Pigment", "Primary Pack", "Raw Material", "Solvent Grade"]
EXCLUDED_FOLDERS, EXCLUDED_EXTENSIONS = ["Old"], ["msg"]
BRANCHES = [
    J.Branch("FG-", "products", level=1, hint_level=2),
    J.Branch("FG-00000", "products", level=1, hint_level=2),
    J.Branch("RM-", "raw_materials", level=1, hint_level=2),
    J.Branch("PK-00000001", "packaging", pattern=r"^\d+_([A-Za-z]+)", hint_level=2),
    J.Branch("PK-", "packaging", level=1),
]

WS = r"[\s\x0b\x1c-\x1f\x{0085}\p{Z}]"


def sql_normal(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


def sql_fold(c: str) -> str:
    return sql_normal(f"replace(lower({c}), 'ß', 'ss')")


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


# The tree of one folder of files; folder names carry the items' identifiers, padded as the items write them.
TREE_SQL = r"""
t0 AS (SELECT regexp_replace(relativepath, '^([A-Z]{2}-)', '\10000') AS path, path AS source, sha, sessionid FROM files WHERE relativepath IS NOT NULL),
tree AS (SELECT *, string_split(path, '/') AS parts, string_split(path, '/')[1:-2] AS folders, string_split(path, '/')[-1] AS name,
                lower(regexp_extract(string_split(path, '/')[-1], '[^./]\.([^./]+)$', 1)) AS ext, len(string_split(path, '/')) - 1 AS depth FROM t0)
"""
ITEMS_SQL = f"""
items1 AS (SELECT {sql_normal("coalesce(itemtable, '')")} AS itemtable, {sql_normal("coalesce(id, '')")} AS id, {sql_normal("coalesce(identifier, '')")} AS identifier,
                  {sql_normal("coalesce(name, '')")} AS name, {sql_normal("coalesce(template, '')")} AS template,
                  coalesce(lower({sql_strip("archived")}) IN ('true', 't', 'yes', 'y', '1'), false) AS archived
           FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrivedat DESC, name DESC NULLS LAST) AS k FROM items WHERE id IS NOT NULL) WHERE k = 1),
itm AS (SELECT * FROM items1 WHERE itemtable IN ('products', 'raw_materials', 'packaging'))
"""


def files_tree(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "files").filter(F.col("relativepath").isNotNull())
    path = F.regexp_replace("relativepath", "^([A-Z]{2}-)", "$10000")
    named = files.select(path.alias("path"), F.col("path").alias("source"), "sha", "sessionid")
    name = F.element_at(F.split("path", "/"), -1)
    return named.select("*", T.folders_of(F.col("path")).alias("folders"), name.alias("name"), T.extension_of(name).alias("ext"), F.size(T.folders_of(F.col("path"))).alias("depth"))


def latest_items(spark: SparkSession, folder: str) -> DataFrame:
    """Each item as its latest export has it."""
    last = F.max_by(F.struct("itemtable", "identifier", "name", "template", "archived"), F.struct("arrivedat", "name"))
    items = table(spark, folder, "items").filter(F.col("id").isNotNull()).groupBy("id").agg(last.alias("l"))
    return items.select("id", "l.*")


def items_of(spark: SparkSession, folder: str) -> DataFrame:
    return V.load_items(latest_items(spark, folder), TABLES)


def attachments(spark: SparkSession, folder: str) -> DataFrame:
    return J.resolve(J.identify(files_tree(spark, folder), BRANCHES), items_of(spark, folder))


RESOLVED_SQL = f"""
WITH {TREE_SQL}, {ITEMS_SQL},
found AS (SELECT *, CASE WHEN starts_with(path, 'PK-00000001') THEN 3 WHEN starts_with(path, 'FG-00000') THEN 1 WHEN starts_with(path, 'FG-') THEN 0
                         WHEN starts_with(path, 'RM-') THEN 2 WHEN starts_with(path, 'PK-') THEN 4 END AS branch FROM tree),
ident AS (SELECT *, CASE WHEN branch IN (0, 1) THEN 'products' WHEN branch = 2 THEN 'raw_materials' WHEN branch IN (3, 4) THEN 'packaging' END AS itemtable,
                 nullif(CASE WHEN branch = 3 THEN regexp_extract(name, '^\\d+_([A-Za-z]+)', 1) WHEN branch IS NOT NULL THEN {sql_strip("folders[1]")} END, '') AS identifier,
                 CASE WHEN branch IN (0, 1, 2, 3) THEN folders[2] END AS hint FROM found),
exact AS (SELECT itemtable, identifier, count(*) AS n, array_to_string(list(id || ' (' || name || ')' ORDER BY id, name)[1:3], ', ') AS names, min_by(struct_pack(id, name, template, archived), struct_pack(id, name)) AS item FROM itm WHERE identifier <> '' GROUP BY 1, 2),
loose AS (SELECT itemtable, replace(lower(identifier), 'ß', 'ss') AS folded, count(*) AS n, array_to_string(list(id || ' (' || name || ')' ORDER BY id, name)[1:3], ', ') AS names, min_by(struct_pack(id, name, template, archived), struct_pack(id, name)) AS item FROM itm WHERE identifier <> '' GROUP BY 1, 2),
met AS (SELECT i.*, coalesce(e.n, l.n) AS n, coalesce(e.item, l.item) AS item, e.n IS NOT NULL AS direct, CASE WHEN e.n IS NOT NULL THEN e.names ELSE l.names END AS names FROM ident i
        LEFT JOIN exact e ON e.itemtable = i.itemtable AND e.identifier = i.identifier
        LEFT JOIN loose l ON l.itemtable = i.itemtable AND l.folded = replace(lower(i.identifier), 'ß', 'ss')),
resolved AS (SELECT *, CASE WHEN branch IS NULL THEN 'unbranched' WHEN identifier IS NULL THEN 'unidentified' WHEN n IS NULL THEN 'unmatched' WHEN n > 1 THEN 'ambiguous' WHEN item.archived THEN 'archived' END AS why FROM met)
"""
RESOLVED_SQL = RESOLVED_SQL.replace("\\\\d", "\\d")


@query(RESOLVED_SQL + "SELECT source, path, itemtable, identifier, why, CASE WHEN why IS NULL THEN item.id END AS itemid FROM resolved")
def legibility_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Which files reach exactly one live item, and why the others do not."""
    return attachments(spark, folder).select("source", "path", "itemtable", "identifier", "why", "itemid")


@query(RESOLVED_SQL + "SELECT source, hint, CASE WHEN why IS NULL THEN item.name END AS itemname, CASE WHEN why IS NULL THEN item.template END AS itemtemplate FROM resolved WHERE why IS NULL")
def resolve_attachments(spark: SparkSession, folder: str) -> DataFrame:
    return attachments(spark, folder).filter(F.col("why").isNull()).select("source", "hint", "itemname", "itemtemplate")


@query(RESOLVED_SQL + """, b(branch, prefix) AS (VALUES (0, 'FG-'), (1, 'FG-00000'), (2, 'RM-'), (3, 'PK-00000001'), (4, 'PK-'))
SELECT prefix, count(r.path)::BIGINT AS files, (count(*) FILTER (r.path IS NOT NULL AND why IS NULL))::BIGINT AS matched, (count(*) FILTER (why = 'unidentified'))::BIGINT AS unidentified,
       (count(*) FILTER (r.path IS NOT NULL AND why IS NULL AND NOT direct))::BIGINT AS folded, (count(*) FILTER (why = 'unmatched'))::BIGINT AS unmatched, (count(*) FILTER (why = 'ambiguous'))::BIGINT AS ambiguous, (count(*) FILTER (why = 'archived'))::BIGINT AS archived,
       count(DISTINCT CASE WHEN why IS NULL THEN item.id END)::BIGINT AS items
FROM b LEFT JOIN resolved r ON r.branch = b.branch GROUP BY prefix""")
def branch_match_rates(spark: SparkSession, folder: str) -> DataFrame:
    return J.match_rates(attachments(spark, folder), BRANCHES)


@query(RESOLVED_SQL + "SELECT source, identifier, n::BIGINT AS items, names FROM resolved WHERE why = 'ambiguous'")
def ambiguous_items(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose identifier several items share, with how many and the first of them."""
    found = attachments(spark, folder).filter("why = 'ambiguous'").select("source", "itemtable", "identifier", "names")
    items = items_of(spark, folder).filter("identifier <> ''")
    exact = items.groupBy("itemtable", "identifier").agg(F.count("*").alias("_e"))
    loose = items.groupBy("itemtable", casefold(F.col("identifier")).alias("_f")).agg(F.count("*").alias("_l"))
    met = found.join(exact, ["itemtable", "identifier"], "left").withColumn("_f", casefold(F.col("identifier"))).join(loose, ["itemtable", "_f"], "left")
    return met.select("source", "identifier", F.coalesce("_e", "_l").alias("items"), "names")


@query(RESOLVED_SQL + """SELECT count(*)::BIGINT AS files, (count(*) FILTER (why IS NULL))::BIGINT AS matched, (count(*) FILTER (why = 'unbranched'))::BIGINT AS unbranched,
  count(*) = count(*) FILTER (why IS NULL) AS legible FROM resolved""")
def legibility_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every file reaches one live item."""
    return J.legible(attachments(spark, folder))


@query(RESOLVED_SQL + "SELECT source, identifier FROM resolved WHERE branch = 3")
def identifier_by_filename(spark: SparkSession, folder: str) -> DataFrame:
    return J.identify(files_tree(spark, folder), BRANCHES).filter("branch = 3").select("source", "identifier")


@query(f"""WITH {TREE_SQL}, named AS (SELECT i AS depth, folders[i] AS folder, count(*) AS n FROM (SELECT folders, unnest(range(1, len(folders) + 1)) AS i FROM tree) GROUP BY 1, 2)
SELECT depth::INT AS depth, count(*)::BIGINT AS distinct_names, sum(n)::BIGINT AS files_under, array_to_string(list(folder ORDER BY n DESC, folder)[1:12], '|') AS names FROM named GROUP BY depth""")
def tree_levels(spark: SparkSession, folder: str) -> DataFrame:
    return T.levels(files_tree(spark, folder))


@query(f"WITH {TREE_SQL} SELECT count(*)::BIGINT AS files, (count(*) FILTER (depth = 0))::BIGINT AS loose, count(DISTINCT depth) > 1 AS mixed, coalesce(max(depth), 0) = 0 AS flat FROM tree")
def depth_flags(spark: SparkSession, folder: str) -> DataFrame:
    return T.depth_flags(files_tree(spark, folder))


@query(f"WITH {TREE_SQL} SELECT depth::INT AS depth, count(*)::BIGINT AS files FROM tree GROUP BY 1")
def depth_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return T.depth_histogram(files_tree(spark, folder))


@query(f"""WITH {TREE_SQL} SELECT replace(lower(folders[i]), 'ß', 'ss') AS folder, count(DISTINCT array_to_string(folders[1:i - 1], '/'))::BIGINT AS parents, count(*)::BIGINT AS files
FROM (SELECT folders, unnest(range(1, len(folders) + 1)) AS i FROM tree) GROUP BY 1""")
def folder_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return T.folder_candidates(files_tree(spark, folder))


@query(f"WITH {TREE_SQL} SELECT CASE WHEN ext = '' THEN '(none)' ELSE ext END AS ext, count(*)::BIGINT AS files FROM tree GROUP BY 1")
def extension_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return T.extension_histogram(files_tree(spark, folder))


EXCLUDED_SQL = f"""WITH {TREE_SQL}, excluded AS (SELECT *, coalesce('folder ' || list_filter(folders, lambda f: replace(lower(f), 'ß', 'ss') = 'old')[1], CASE WHEN ext = 'msg' THEN 'extension msg' END) AS why FROM tree)"""


def excluded(spark: SparkSession, folder: str) -> DataFrame:
    return T.exclusions(files_tree(spark, folder), EXCLUDED_FOLDERS, EXCLUDED_EXTENSIONS)


@query(EXCLUDED_SQL + "SELECT source, why FROM excluded")
def exclusions_applied(spark: SparkSession, folder: str) -> DataFrame:
    return excluded(spark, folder).select("source", "why")


@query(EXCLUDED_SQL + "SELECT coalesce(why, 'kept') AS why, count(*)::BIGINT AS files FROM excluded GROUP BY 1")
def exclusions_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    return excluded(spark, folder).groupBy(F.coalesce("why", F.lit("kept")).alias("why")).agg(F.count("*").alias("files"))


@query("SELECT path, sha256(coalesce(textfile, '')) AS textsha FROM extracted")
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "extracted").select("path", F.sha2(F.coalesce("textfile", F.lit("")), 256).alias("textsha"))


@query("SELECT sha, count(*)::BIGINT AS files, min(path) AS first FROM files GROUP BY sha HAVING count(*) > 1")
def copies_report(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "files").groupBy("sha").agg(F.count("*").alias("files"), F.min("path").alias("first")).filter("files > 1")


@query("SELECT kind, count(*)::BIGINT AS files FROM extracted GROUP BY kind")
def kind_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "extracted").groupBy("kind").agg(F.count("*").alias("files"))


@query(r"""WITH h AS (SELECT extractid, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS ext, upper(hex(encode(left(coalesce(textfile, ''), 8))))[1:16] AS head FROM extracted),
s AS (SELECT *, CASE WHEN starts_with(head, '25504446') THEN 'pdf' WHEN starts_with(head, '504B0304') THEN 'zip' WHEN starts_with(head, 'D0CF11E0A1B11AE1') THEN 'ole' WHEN starts_with(head, 'FFD8FF') THEN 'jpg'
  WHEN starts_with(head, '89504E470D0A1A0A') THEN 'png' WHEN starts_with(head, '47494638') THEN 'gif' WHEN starts_with(head, '49492A00') OR starts_with(head, '4D4D002A') THEN 'tif' END AS said FROM h)
SELECT extractid, head, said, CASE WHEN said = 'pdf' AND ext <> 'pdf' THEN 'pdf' WHEN said = 'ole' AND ext IN ('docx', 'xlsx', 'pptx') THEN left(ext, 3) WHEN said = 'zip' AND ext IN ('doc', 'xls', 'ppt') THEN ext || 'x' ELSE ext END AS ext FROM s""")
def magic_sniff(spark: SparkSession, folder: str) -> DataFrame:
    """What the first bytes of a record stand for, and the suffix to read it by."""
    head = F.hex(F.substring(F.encode(F.coalesce("textfile", F.lit("")), "UTF-8"), 1, 8))
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return table(spark, folder, "extracted").select("extractid", head.alias("head"), sniff(head).alias("said"), true_extension(ext, head).alias("ext"))


@query("SELECT extractid, least(coalesce(pages, 0), 3)::INT AS three, least(coalesce(pages, 0), 1)::INT AS first, least(coalesce(pages, 0), 40)::INT AS every, 0::INT AS none FROM extracted")
def pages_rendered(spark: SparkSession, folder: str) -> DataFrame:
    """How many pages of each record are rendered by what is asked for."""
    asked = {"three": "3", "first": "first", "every": "all", "none": "none"}
    return table(spark, folder, "extracted").select("extractid", *[pages_to_render(v, F.col("pages"), 40).alias(c) for c, v in asked.items()])


@query(f"""SELECT extractid, len({sql_strip("coalesce(textfile, '')")})::INT AS chars, len(regexp_replace(coalesce(textfile, ''), '[^\\p{{L}}\\p{{Nl}}\\p{{No}}]', '', 'g'))::INT AS letters FROM extracted""".replace("\\\\p", "\\p"))
def letters_and_chars(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("textfile", F.lit(""))
    return table(spark, folder, "extracted").select("extractid", F.length(strip(text)).alias("chars"), letters(text).alias("letters"))


@query(r"""WITH e AS (SELECT extractid, lower(regexp_extract(path, '\.([^./]+)$', 1)) AS ext, textfile, pages, CASE WHEN kind IN ('missing', 'failed', 'unsupported') THEN kind END AS error FROM extracted),
f AS (SELECT *, len(regexp_replace(coalesce(textfile, ''), '^[\s\x0b]+|[\s\x0b]+$', '', 'g')) AS chars_, len(regexp_replace(coalesce(textfile, ''), '[^\p{L}\p{Nl}\p{No}]', '', 'g')) / greatest(coalesce(pages, 1), 1) AS per_page FROM e)
SELECT extractid, CASE WHEN error = 'missing' THEN 'missing' WHEN ext IN ('jpg', 'jpeg', 'png', 'gif', 'tif', 'tiff', 'bmp', 'webp') THEN 'image' WHEN ext IN ('doc', 'xls', 'ppt') OR error = 'unsupported' THEN 'unsupported'
  WHEN error IS NOT NULL AND coalesce(pages > 0, false) THEN 'image-only' WHEN error IS NOT NULL THEN 'failed' WHEN ext <> 'pdf' AND chars_ > 0 THEN 'text' WHEN ext <> 'pdf' THEN 'empty'
  WHEN per_page >= 40 THEN 'text' WHEN chars_ = 0 THEN 'image-only' ELSE 'sparse-text' END AS kind FROM f""")
def kind_ladder(spark: SparkSession, folder: str) -> DataFrame:
    """The kind of each record from suffix, text, pages and what went wrong."""
    error = F.when(F.col("kind").isin("missing", "failed", "unsupported"), F.col("kind"))
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return table(spark, folder, "extracted").select("extractid", kind_of(ext, F.col("textfile"), error, F.col("pages")).alias("kind"))


@query("""WITH e AS (SELECT extractid, textfile, len(textfile) AS n, chr(10) || chr(10) || '[... ' || (len(textfile) - 400)::VARCHAR || ' characters left out ...]' || chr(10) || chr(10) AS note FROM extracted)
SELECT extractid, CASE WHEN n <= 400 THEN textfile ELSE substring(textfile, 1, (400 - len(note) - floor((400 - len(note)) * 0.25))::INT) || note || right(textfile, floor((400 - len(note)) * 0.25)::INT) END AS text FROM e""")
def cap_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "extracted").select("extractid", capped(F.col("textfile"), 400).alias("text"))


@query(r"""WITH f AS (SELECT path, string_split(path, '/')[-1] AS name FROM files)
SELECT path, sha256(path)[1:8] || '_' || left(regexp_replace(regexp_replace(name, '(.)\.[^.]*$', '\1'), '[^A-Za-z0-9._-]+', '_', 'g'), 60) AS slug FROM f""")
def path_slug(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "files").select("path", slug(F.col("path")).alias("slug"))


@query(f"""WITH {ITEMS_SQL}, e AS (SELECT itemtable, identifier, count(*) AS n, count(*) FILTER (archived) AS gone, count(*) FILTER (template = '') AS bare FROM itm GROUP BY 1, 2)
SELECT itemtable, sum(n)::BIGINT AS items, sum(gone)::BIGINT AS archived, sum(CASE WHEN identifier = '' THEN n ELSE 0 END)::BIGINT AS blank_id, sum(bare)::BIGINT AS no_template,
       (count(*) FILTER (identifier <> ''))::BIGINT AS distinct_ids, (count(*) FILTER (identifier <> '' AND n > 1))::BIGINT AS collisions FROM e GROUP BY itemtable""")
def items_summary(spark: SparkSession, folder: str) -> DataFrame:
    return V.items_summary(items_of(spark, folder))


@query(f"""WITH {ITEMS_SQL} SELECT itemtable, identifier, count(*)::BIGINT AS n, array_to_string(list(name ORDER BY name)[1:3], '|') AS names FROM itm WHERE identifier <> '' GROUP BY 1, 2 HAVING count(*) > 1""")
def items_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return V.item_collisions(items_of(spark, folder))


@query(f"""WITH {ITEMS_SQL} SELECT id, CASE WHEN itemtable NOT IN ('products', 'raw_materials', 'packaging') THEN 'table' ELSE 'template' END AS unknown,
  CASE WHEN itemtable NOT IN ('products', 'raw_materials', 'packaging') THEN itemtable ELSE template END AS value FROM items1
WHERE itemtable NOT IN ('products', 'raw_materials', 'packaging') OR (template <> '' AND template NOT IN ({", ".join(repr(t) for t in TEMPLATES)}))""")
def item_problems(spark: SparkSession, folder: str) -> DataFrame:
    return V.item_problems(latest_items(spark, folder), TABLES, TEMPLATES)


@query("SELECT replace(lower(name), 'ß', 'ss') AS name, count(*)::BIGINT AS n, array_to_string(list(id ORDER BY id), '|') AS ids FROM document_templates GROUP BY 1 HAVING count(*) > 1")
def duplicate_template_names(spark: SparkSession, folder: str) -> DataFrame:
    return V.duplicate_names(table(spark, folder, "document_templates"))


@query("""SELECT t.itemtable, d.id, d.name FROM document_templates d, (VALUES ('products'), ('raw_materials'), ('packaging')) t(itemtable)
WHERE d.for_tables IS NULL OR len(d.for_tables) = 0 OR list_contains(d.for_tables, t.itemtable)""")
def closed_list_by_table(spark: SparkSession, folder: str) -> DataFrame:
    tables = spark.createDataFrame([(t,) for t in TABLES], "itemtable string")
    return V.closed_list(table(spark, folder, "document_templates"), tables)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Attachments with what their latest extraction offers to read."""
    record = F.max_by(F.struct("kind", "ocrtextfile", "ocrchars", "images", "path"), F.struct("extractedat", "extractid"))
    read = table(spark, folder, "extracted").groupBy("path").agg(record.alias("r")).select("r.*")
    read = read.select(F.col("path").alias("source"), F.array_join(R.read_from(), "+").alias("read"), R.images_of().alias("images"))
    found = attachments(spark, folder).filter(F.col("why").isNull()).select("source", "sessionid", "sha", "itemtable", "itemtemplate", F.col("path").alias("relativepath"), "hint")
    return found.join(read, "source", "left")


PAIRS_SQL = RESOLVED_SQL + """, rec AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY extractedat DESC, extractid DESC) AS k FROM extracted),
rd AS (SELECT path AS source, coalesce(ocrtextfile IS NOT NULL AND ocrchars >= 120, false) AS o, kind, len(images) AS pictures FROM rec WHERE k = 1),
rd2 AS (SELECT source, CASE kind WHEN 'text' THEN 'textfile' WHEN 'sparse-text' THEN CASE WHEN o THEN 'textfile+ocrtextfile' ELSE 'textfile+images' END
   WHEN 'image-only' THEN CASE WHEN o THEN 'ocrtextfile' ELSE 'images' END WHEN 'image' THEN CASE WHEN o THEN 'ocrtextfile' ELSE 'path' END END AS read, kind, pictures FROM rd),
pairs AS (SELECT r.source, r.sessionid, r.sha, r.itemtable, r.item.template AS itemtemplate, r.path AS relativepath, r.hint, d.read, CASE WHEN read LIKE '%images' THEN coalesce(pictures, 0) WHEN read = 'path' THEN 1 ELSE 0 END AS images
          FROM resolved r LEFT JOIN rd2 d ON d.source = r.source WHERE r.why IS NULL),
ids AS (SELECT sha, itemtable, sha[1:8] AS stem, row_number() OVER (PARTITION BY sha[1:8] ORDER BY sha, itemtable) AS k FROM (SELECT DISTINCT sha, itemtable FROM pairs)),
readings AS (SELECT p.sha, p.itemtable, count(*) AS files, min(relativepath) AS first_file, min_by(struct_pack(read, images), relativepath) FILTER (read IS NOT NULL) AS f FROM pairs p GROUP BY 1, 2)
"""


@query(PAIRS_SQL + "SELECT sha, itemtable, CASE WHEN k = 1 THEN stem ELSE stem || '-' || k END AS readingid FROM ids")
def reading_ids(spark: SparkSession, folder: str) -> DataFrame:
    return R.reading_ids(pairs(spark, folder))


@query(PAIRS_SQL + "SELECT sha, itemtable, files::BIGINT AS files, first_file, f.read AS read, coalesce(f.images, 0)::INT AS images FROM readings")
def readings(spark: SparkSession, folder: str) -> DataFrame:
    return R.readings(pairs(spark, folder))


@query(PAIRS_SQL + "SELECT sha, itemtable, relativepath FROM pairs")
def reading_files(spark: SparkSession, folder: str) -> DataFrame:
    return R.reading_files(pairs(spark, folder))


@query(PAIRS_SQL + "SELECT DISTINCT sha, itemtable, hint FROM pairs WHERE hint IS NOT NULL")
def reading_hints(spark: SparkSession, folder: str) -> DataFrame:
    return R.reading_hints(pairs(spark, folder))


@query(PAIRS_SQL.replace("WITH", "WITH RECURSIVE", 1) + """, ready AS (SELECT CASE WHEN i.k = 1 THEN stem ELSE stem || '-' || i.k END AS readingid, r.itemtable, coalesce(f.images, 0) AS images,
    row_number() OVER (ORDER BY r.itemtable, first_file, CASE WHEN i.k = 1 THEN stem ELSE stem || '-' || i.k END) AS place FROM readings r JOIN ids i ON i.sha = r.sha AND i.itemtable = r.itemtable WHERE f.read IS NOT NULL),
cuts AS (SELECT place, readingid, itemtable, images, 1 AS batch, 1 AS held, images AS carried FROM ready WHERE place = 1
  UNION ALL SELECT n.place, n.readingid, n.itemtable, n.images, CASE WHEN c.held = 20 OR (c.carried > 0 AND c.carried + n.images > 12) THEN c.batch + 1 ELSE c.batch END,
    CASE WHEN c.held = 20 OR (c.carried > 0 AND c.carried + n.images > 12) THEN 1 ELSE c.held + 1 END, CASE WHEN c.held = 20 OR (c.carried > 0 AND c.carried + n.images > 12) THEN n.images ELSE c.carried + n.images END
  FROM cuts c JOIN ready n ON n.place = c.place + 1)
SELECT readingid, itemtable, images::BIGINT AS images, batch::BIGINT AS batch FROM cuts""")
def batches(spark: SparkSession, folder: str) -> DataFrame:
    """Readings cut into batches."""
    found = pairs(spark, folder)
    ready = R.readings(found).filter(F.col("read").isNotNull()).join(R.reading_ids(found), ["sha", "itemtable"])
    return R.batches(ready.select("readingid", "itemtable", "first_file", "images"))


@query(PAIRS_SQL + """, m AS (SELECT sha, min_by(array_to_string(splitby, ', '), formkey) AS splitsinto FROM (SELECT formkey, splitby, unnest(members) AS sha FROM forms WHERE len(splitby) > 0) GROUP BY sha)
SELECT i.sha, i.itemtable, m.splitsinto FROM ids i LEFT JOIN m ON m.sha = i.sha""")
def readings_with_split_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Readings and, where their form splits by value, by which."""
    forms = table(spark, folder, "forms").filter(F.size("splitby") > 0)
    rules = forms.select(F.col("formkey").alias("form"), F.array_join("splitby", ", ").alias("splitsinto"))
    members = forms.select(F.col("formkey").alias("form"), F.explode("members").alias("sha"))
    return R.with_split_rule(R.reading_ids(pairs(spark, folder)), members, rules).select("sha", "itemtable", "splitsinto")


@query(PAIRS_SQL + """, m AS (SELECT DISTINCT unnest(members) AS sha FROM forms WHERE len(coalesce(splitby, [])) = 0)
SELECT sha, itemtable, sha IN (SELECT sha FROM m) AS by_form FROM ids""")
def readings_not_answered_by_form(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that a form answers and readings still to be handed out."""
    forms = table(spark, folder, "forms").filter(F.coalesce(F.size("splitby"), F.lit(0)) <= 0)
    members = forms.select(F.explode("members").alias("sha")).distinct().withColumn("_in", F.lit(True))
    ids = R.reading_ids(pairs(spark, folder)).join(members, "sha", "left")
    return ids.select("sha", "itemtable", F.col("_in").isNotNull().alias("by_form"))


@query(RESOLVED_SQL + """, ex AS (SELECT source, coalesce('folder ' || list_filter(folders, lambda f: replace(lower(f), 'ß', 'ss') = 'old')[1], CASE WHEN ext = 'msg' THEN 'extension msg' END) AS x, why, itemtable FROM resolved)
SELECT CASE WHEN x IS NOT NULL THEN 'ignored' WHEN why IS NOT NULL THEN 'issue: ' || why ELSE 'data: ' || itemtable END AS sheet, count(*)::BIGINT AS files FROM ex GROUP BY 1""")
def readme_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The account of all files: a data sheet, ignored, or an issue with its reason."""
    both = T.exclusions(attachments(spark, folder).withColumnRenamed("why", "issue"), EXCLUDED_FOLDERS, EXCLUDED_EXTENSIONS)
    sheet = F.when(F.col("why").isNotNull(), "ignored").when(F.col("issue").isNotNull(), F.concat(F.lit("issue: "), "issue")).otherwise(F.concat(F.lit("data: "), "itemtable"))
    return both.groupBy(sheet.alias("sheet")).agg(F.count("*").alias("files"))


@query(EXCLUDED_SQL + "SELECT name, array_to_string(folders, '/') AS folder, why FROM excluded WHERE why IS NOT NULL")
def ignored_files(spark: SparkSession, folder: str) -> DataFrame:
    return excluded(spark, folder).filter(F.col("why").isNotNull()).select("name", F.array_join("folders", "/").alias("folder"), "why")


@query(f"""WITH t AS (SELECT DISTINCT path FROM files), a AS (SELECT path, 'answered' AS o FROM classifications WHERE coalesce(documenttemplateid, '') <> ''),
b AS (SELECT path, 'open' AS o FROM classifications WHERE coalesce(documenttemplateid, '') = ''), p AS (SELECT * FROM a UNION ALL SELECT * FROM b),
c AS (SELECT path, count(*) AS n, array_to_string(list_sort(list(DISTINCT o)), '|') AS outcomes FROM p GROUP BY path)
SELECT coalesce(t.path, c.path) AS path, coalesce(outcomes, '') AS outcomes, coalesce(n, 0)::BIGINT AS n FROM t FULL JOIN c ON c.path = t.path WHERE t.path IS NULL OR n IS NULL OR n <> 1""")
def conservation_check(spark: SparkSession, folder: str) -> DataFrame:
    """Files that are in no outcome or in more than one."""
    from paperloom.operators.audit import conservation

    answers = table(spark, folder, "classifications").select("path", (F.coalesce("documenttemplateid", F.lit("")) != "").alias("answered"))
    return conservation(table(spark, folder, "files").select("path"), [("answered", answers.filter("answered")), ("open", answers.filter("NOT answered"))])


@query("""SELECT e.extractid, coalesce(trim(e.path) <> '', false) AND f.path IS NOT NULL AS there FROM extracted e LEFT JOIN files f ON f.path = e.path""")
def missing_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose file is listed, and records whose file is not there."""
    files = table(spark, folder, "files").select("path").withColumn("_f", F.lit(True))
    e = table(spark, folder, "extracted").select("extractid", blank_to_null(F.col("path")).alias("path"))
    return e.join(files, "path", "left").select("extractid", F.col("_f").isNotNull().alias("there"))


@query(RESOLVED_SQL + """, m AS (SELECT DISTINCT formkey AS form, unnest(members) AS sha FROM forms), e AS (SELECT DISTINCT m.form, r.itemtable FROM m JOIN resolved r ON r.sha = m.sha WHERE r.itemtable IS NOT NULL)
SELECT form, array_to_string(list(itemtable ORDER BY itemtable), '|') AS tables FROM e GROUP BY form""")
def tables_of_forms(spark: SparkSession, folder: str) -> DataFrame:
    members = table(spark, folder, "forms").select(F.col("formkey").alias("form"), F.explode(F.array_distinct("members")).alias("sha"))
    return J.tables_of_forms(attachments(spark, folder), members)


@query("SELECT path, sha FROM files WHERE sha IN (SELECT sha FROM classifications WHERE coalesce(documenttemplateid, '') <> '')")
def wanted_uploads(spark: SparkSession, folder: str) -> DataFrame:
    """Files of which an answered row wants the content."""
    wanted = table(spark, folder, "classifications").filter(F.coalesce("documenttemplateid", F.lit("")) != "")
    return J.wanted_uploads(table(spark, folder, "files").select("path", "sha"), wanted)
