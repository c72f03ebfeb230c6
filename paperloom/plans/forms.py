"""Forms: words, signatures, clusters and their wording over the texts of one folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import forms as O
from paperloom.operators import review as V
from paperloom.operators import similarity as L
from paperloom.options import SWEEP_FLOORS, SWEEP_THRESHOLDS, FormOptions
from paperloom.plans.registry import query
from paperloom.sources.tables import cut, table

OPTIONS = FormOptions()


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """sha, path, text of every file that was read."""
    read = table(spark, folder, "extracted").select("path", F.col("textfile").alias("text"))
    return table(spark, folder, "files").select("path", "sha").join(read, "path")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return O.texts_once(documents(spark, folder))


TEXTS_SQL = r"""
docs AS (SELECT f.sha, f.path, e.textfile AS text FROM files f JOIN extracted e ON e.path = f.path),
texts AS (SELECT sha, min_by(text, struct_pack(k := -len(text), path)) AS text FROM docs WHERE trim(coalesce(text, '')) <> '' GROUP BY sha),
words AS (SELECT DISTINCT sha, upper(unnest(regexp_extract_all(regexp_replace(text, '([a-z])([A-Z])', '\1 \2', 'g'), '[A-Za-z]{3,}'))) AS word FROM texts),
df AS (SELECT word, count(*) AS documents FROM words GROUP BY word),
fl AS (SELECT greatest(2, round_even(0.025 * (SELECT count(*) FROM texts)::DOUBLE, 0)::BIGINT) AS floor),
sig AS (SELECT t.sha, coalesce(array_to_string(list_sort(list(w.word) FILTER (w.word IS NOT NULL)), ' '), '') AS signature
        FROM texts t LEFT JOIN (SELECT words.* FROM words JOIN df USING (word), fl WHERE df.documents >= fl.floor) w ON w.sha = t.sha GROUP BY t.sha)
"""


@query(f"WITH {TEXTS_SQL} SELECT sha, text FROM texts")
def longest_text_per_sha(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder)


@query(f"WITH {TEXTS_SQL} SELECT DISTINCT sha FROM files WHERE sha NOT IN (SELECT sha FROM texts)")
def unreadable_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "files").select("sha").distinct().join(texts(spark, folder), "sha", "left_anti")


@query(f"WITH {TEXTS_SQL} SELECT word, documents::BIGINT AS documents FROM df")
def document_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return O.document_frequency(O.words_of(texts(spark, folder)))


@query(f"WITH {TEXTS_SQL} SELECT (SELECT count(*) FROM texts)::BIGINT AS documents, floor::BIGINT AS floor FROM fl")
def frequency_floor(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder).agg(F.count("*").alias("documents")).withColumn("floor", O.floor_of(F.col("documents"), OPTIONS))


@query(f"WITH {TEXTS_SQL} SELECT sha, signature FROM sig")
def signatures(spark: SparkSession, folder: str) -> DataFrame:
    once = texts(spark, folder)
    signed = O.signatures(once, O.words_of(once), once.count(), OPTIONS)
    return signed.select("sha", F.array_join("signature", " ").alias("signature"))


# The parts of words run together: all covers by known words, of these the one whose parts are longest first.
PARTS_SQL = f"""WITH RECURSIVE {TEXTS_SQL},
vocabulary AS (SELECT DISTINCT word FROM words), long_words AS (SELECT word FROM vocabulary WHERE len(word) >= 12),
covers AS (SELECT word, 0 AS upto, []::VARCHAR[] AS parts, []::BIGINT[] AS sizes FROM long_words
  UNION ALL SELECT c.word, c.upto + len(v.word), list_append(c.parts, v.word), list_append(c.sizes, len(v.word)::BIGINT) FROM covers c JOIN vocabulary v ON v.word = c.word[c.upto + 1:c.upto + len(v.word)] AND v.word <> c.word
    WHERE len(c.parts) < 6 AND c.upto < len(c.word)),
parts AS (SELECT word, unnest(arg_max(parts, sizes)) AS part FROM covers WHERE upto = len(word) GROUP BY word),
every AS (SELECT DISTINCT sha, word FROM (SELECT sha, word FROM words UNION ALL SELECT w.sha, p.part FROM words w JOIN parts p USING (word)))
"""


@query(PARTS_SQL + "SELECT word, part FROM parts")
def joined_token_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Words run together and their parts."""
    return O.split_joined(O.words_of(texts(spark, folder)).select("word").distinct(), OPTIONS)


def signed_texts(spark: SparkSession, folder: str) -> DataFrame:
    sets = O.word_sets(texts(spark, folder), OPTIONS)
    return cut(O.set_signatures(sets, sets.count(), OPTIONS))


# The sequential walk: documents by size of signature, then sha; the state is the list of seeds so far.
WALK_SQL = PARTS_SQL + """, freq AS (SELECT word, count(*) AS documents FROM every GROUP BY word), total AS (SELECT count(*) AS n FROM texts),
{cells}, signed AS (SELECT c.floor, t.sha, coalesce(list_sort(list(e.word) FILTER (e.word IS NOT NULL)), []) AS sig FROM (SELECT DISTINCT floor FROM cells) c CROSS JOIN texts t
  LEFT JOIN (SELECT c.floor, e.sha, e.word FROM (SELECT DISTINCT floor FROM cells) c CROSS JOIN every e JOIN freq f USING (word) WHERE f.documents >= greatest(2, round_even(c.floor * (SELECT n FROM total)::DOUBLE, 0)::BIGINT)) e ON e.sha = t.sha AND e.floor = c.floor GROUP BY 1, 2),
ranked AS (SELECT c.floor, c.threshold, s.sha, s.sig, row_number() OVER (PARTITION BY c.floor, c.threshold ORDER BY len(s.sig) DESC, s.sha) AS place FROM cells c JOIN signed s ON s.floor = c.floor),
walk AS (SELECT floor, threshold, 0::BIGINT AS place, NULL::VARCHAR AS sha, NULL::VARCHAR AS seed, 1.0::DOUBLE AS fit, []::STRUCT(sha VARCHAR, sig VARCHAR[])[] AS seeds FROM cells
  UNION ALL SELECT floor, threshold, place, sha, CASE WHEN held THEN seeds[best].sha ELSE sha END, CASE WHEN held THEN scores[best] ELSE 1.0 END, CASE WHEN held THEN seeds ELSE list_append(seeds, struct_pack(sha := sha, sig := sig)) END
  FROM (SELECT *, list_position(scores, list_max(scores)) AS best, coalesce(len(sig) > 0 AND list_max(scores) >= threshold, false) AS held
        FROM (SELECT r.*, w.seeds, list_transform(w.seeds, lambda s: len(list_intersect(s.sig, r.sig))::DOUBLE / greatest(len(s.sig) + len(r.sig) - len(list_intersect(s.sig, r.sig)), 1)) AS scores
              FROM walk w JOIN ranked r ON r.floor = w.floor AND r.threshold = w.threshold AND r.place = w.place + 1))),
placed AS (SELECT floor, threshold, sha, seed, fit FROM walk WHERE place > 0)
"""
ONE_CELL = "cells AS (SELECT 0.025::DOUBLE AS floor, 0.55::DOUBLE AS threshold)"
ALL_CELLS = "cells AS (SELECT f::DOUBLE AS floor, t::DOUBLE AS threshold FROM (SELECT unnest([" + ", ".join(map(str, SWEEP_FLOORS)) + "]) AS f) CROSS JOIN (SELECT unnest([" + ", ".join(map(str, SWEEP_THRESHOLDS)) + "]) AS t))"


@query(WALK_SQL.replace("{cells}", ONE_CELL) + """, sizes AS (SELECT seed, count(*) AS n FROM placed GROUP BY seed),
numbers AS (SELECT z.seed, row_number() OVER (ORDER BY n DESC, len(s.sig) DESC, z.seed) AS k FROM sizes z JOIN signed s ON s.sha = z.seed)
SELECT p.sha, CASE WHEN k < 10 THEN 'f0' || k ELSE 'f' || k END AS form, p.fit FROM placed p JOIN numbers USING (seed)""")
def forms_leader_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """The form of each text."""
    signed = signed_texts(spark, folder)
    found = O.leader_clusters(signed, OPTIONS)
    return cut(found).join(O.number_forms(found, signed), "seed").select("sha", F.col("short").alias("form"), "fit")


@query(WALK_SQL.replace("{cells}", ALL_CELLS) + """, z AS (SELECT floor, threshold, seed, count(*) AS n FROM placed GROUP BY 1, 2, 3),
med AS (SELECT floor, list_sort(list(len(sig)))[len(list(sig)) // 2 + 1] AS median_words FROM signed GROUP BY floor)
SELECT z.floor, threshold, count(*)::BIGINT AS forms, max(n)::BIGINT AS largest, (count(*) FILTER (n = 1))::BIGINT AS single, any_value(median_words)::INT AS median_words FROM z JOIN med ON med.floor = z.floor GROUP BY z.floor, threshold""")
def form_sweep(spark: SparkSession, folder: str) -> DataFrame:
    sets = O.word_sets(texts(spark, folder), OPTIONS)
    return O.sweep(sets, sets.count(), SWEEP_FLOORS, SWEEP_THRESHOLDS)


def as_classes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return L.signature_classes(signed_texts(spark, folder))


SIGNED_SQL = WALK_SQL[: WALK_SQL.index("ranked AS")].replace("{cells}", ONE_CELL).rstrip().rstrip(",") + ", cls AS (SELECT min(sha) AS class, sig FROM signed WHERE len(sig) > 0 GROUP BY sig)"


@query(SIGNED_SQL + " SELECT sha, class FROM signed JOIN cls ON cls.sig = signed.sig UNION ALL SELECT sha, sha FROM signed WHERE len(sig) = 0")
def signature_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Each text with the text that stands for all of the same signature."""
    return as_classes(spark, folder)[0]


@query(SIGNED_SQL + """, p AS (SELECT a.class AS a, b.class AS b, len(list_intersect(a.sig, b.sig)) AS shared, len(a.sig) + len(b.sig) AS n FROM cls a JOIN cls b ON a.class < b.class)
SELECT a, b, shared::BIGINT AS shared, (n - shared)::BIGINT AS united FROM p WHERE shared * 20 >= (n - shared) * 11""")
def similarity_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of different signatures that are at least as similar as members of one form."""
    return L.similarity_edges(as_classes(spark, folder)[1], L.as_fraction(OPTIONS.threshold))


def given_members(spark: SparkSession, folder: str) -> DataFrame:
    """form and sha of the forms of the table: runs name their forms anew, so the key is the form."""
    return table(spark, folder, "forms").select(F.col("formkey").alias("form"), F.explode(F.array_distinct("members")).alias("sha"))


MEMBERS_SQL = f"""WITH {TEXTS_SQL}, members AS (SELECT DISTINCT formkey AS form, unnest(members) AS sha FROM forms),
sizes AS (SELECT form, count(*) AS n FROM members GROUP BY form), have AS (SELECT m.form, w.word, count(*) AS have FROM members m JOIN words w USING (sha) GROUP BY 1, 2)"""


@query(MEMBERS_SQL + "SELECT h.form, word FROM have h JOIN sizes s USING (form) WHERE have = n")
def form_wording(spark: SparkSession, folder: str) -> DataFrame:
    """Words that all members of a form have."""
    return O.common_words(given_members(spark, folder), O.words_of(texts(spark, folder)))


@query(MEMBERS_SQL + "SELECT h.form, word, have::BIGINT AS documents FROM have h JOIN sizes s USING (form) WHERE have >= greatest(1, round_even(n::DOUBLE * 0.4, 0)::BIGINT)")
def inside_form_keep(spark: SparkSession, folder: str) -> DataFrame:
    return O.inside_words(given_members(spark, folder), O.words_of(texts(spark, folder)), OPTIONS)


@query(MEMBERS_SQL + """, rules AS (SELECT formkey AS form, wording FROM forms WHERE wording IS NOT NULL)
SELECT m.form, m.sha, len(list_filter(wording, lambda w: NOT contains(upper(t.text), upper(w)))) = 0 AS has FROM members m JOIN rules r USING (form) JOIN texts t ON t.sha = m.sha""")
def wording_split(spark: SparkSession, folder: str) -> DataFrame:
    rules = table(spark, folder, "forms").filter(F.col("wording").isNotNull()).select(F.col("formkey").alias("form"), "wording")
    return O.wording_split(given_members(spark, folder), texts(spark, folder), rules)


# No form of the tables has a word run together of its own, so its words are its members' words.
@query(MEMBERS_SQL.replace(TEXTS_SQL, PARTS_SQL[15:].strip()).replace("WITH ", "WITH RECURSIVE ", 1) + r""", keep AS (SELECT h.form, list(DISTINCT word) AS keep FROM have h JOIN sizes s USING (form) WHERE have >= greatest(1, round_even(n::DOUBLE * 0.4, 0)::BIGINT) GROUP BY h.form),
picked AS (SELECT form, sha FROM (SELECT *, row_number() OVER (PARTITION BY form ORDER BY sha256(sha || ':0'), sha) AS k FROM members) WHERE k <= 5),
ln AS (SELECT p.form, p.sha, unnest(string_split(regexp_replace(t.text, '([a-z])([A-Z])', '\1 \2', 'g'), chr(10))) AS raw, generate_subscripts(string_split(t.text, chr(10)), 1) - 1 AS line FROM picked p JOIN texts t USING (sha)),
pl AS (SELECT word, list(part) AS parts FROM parts GROUP BY word),
tk AS (SELECT ln.form, ln.sha, line, trim(regexp_replace(raw, '[\s\x0b\p{Z}]+', ' ', 'g')) AS flat, regexp_extract_all(raw, '[A-Za-z]+|[0-9][0-9.,/:%-]*|[^\s\x0b\p{Z}]') AS tokens, coalesce(keep, []) AS keep FROM ln LEFT JOIN keep USING (form)),
more AS (SELECT k.form, list(pl.word) AS more FROM keep k JOIN pl ON len(list_intersect(pl.parts, k.keep)) = len(list_distinct(pl.parts)) GROUP BY k.form)
SELECT sha, tk.form, line::INT AS line, CASE WHEN line < 8 THEN upper(replace(flat, 'ß', 'SS')) ELSE array_to_string(list_transform(tokens, lambda t: CASE WHEN regexp_matches(t, '^[A-Za-z]') THEN CASE WHEN list_contains(keep, upper(t)) OR list_contains(coalesce(more, []), upper(t)) THEN upper(t) ELSE '_' END
  WHEN regexp_matches(t, '^[0-9]') THEN '_' ELSE t END), ' ') END AS view FROM tk LEFT JOIN more USING (form) WHERE flat <> ''""".replace("\\\\", "\\"))
def structure_view(spark: SparkSession, folder: str) -> DataFrame:
    """The printed side of a few members of each form."""
    members, once = given_members(spark, folder), cut(texts(spark, folder))
    words = cut(O.words_of(once))
    keep = cut(O.inside_words(members, words, OPTIONS))
    parts = O.split_joined(words.select("word").distinct(), OPTIONS)
    return O.structure_view(O.sample(members, OPTIONS).join(once, "sha"), keep, parts, OPTIONS)


@query(f"WITH {TEXTS_SQL}" + r"SELECT sha, len(regexp_replace(text, '[^\p{Nd}]', '', 'g'))::INT AS digits, len(text)::INT AS chars FROM texts")
def fill_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """How much of a text is digits, as numerator and denominator."""
    return texts(spark, folder).select("sha", F.regexp_count("text", F.lit(r"\p{Nd}")).alias("digits"), F.length("text").alias("chars"))


@query(r"""SELECT extractid, coalesce(array_to_string(list_filter(string_split_regex(textfile, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{0085}\x{2028}\x{2029}]'), lambda l: regexp_replace(l, '[\s\x0b\x1c-\x1f\x{0085}\p{Z}]+', '', 'g') <> '')[1:14], chr(10)), '') AS lines FROM extracted""")
def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The head of each text, for a member without a picture."""
    return table(spark, folder, "extracted").select("extractid", F.array_join(V.first_lines(F.col("textfile")), "\n").alias("lines"))


def review_members(spark: SparkSession, folder: str) -> DataFrame:
    """form, sha, fit (1 where none is told) and fill of each member, once."""
    fits = table(spark, folder, "forms").select(F.col("formkey").alias("form"), F.explode("fit").alias("sha", "fit"))
    once = texts(spark, folder).select("sha", V.fill_ratio(F.col("text")).alias("filled"))
    told = given_members(spark, folder).join(fits, ["form", "sha"], "left").join(once, "sha", "left")
    return told.withColumns({"fit": F.coalesce("fit", F.lit(1.0)), "filled": F.coalesce("filled", F.lit(0.0))})


REVIEW_SQL = MEMBERS_SQL + r""", fits AS (SELECT DISTINCT formkey AS form, unnest(map_keys(fit)) AS sha, unnest(map_values(fit)) AS fit FROM forms),
rev AS (SELECT m.form, m.sha, coalesce(f.fit, 1.0) AS fit, coalesce(CASE WHEN len(t.text) > 0 THEN len(regexp_replace(t.text, '[^\p{Nd}]', '', 'g'))::DOUBLE / len(t.text) END, 0.0) AS filled
  FROM members m LEFT JOIN fits f ON f.form = m.form AND f.sha = m.sha LEFT JOIN texts t ON t.sha = m.sha),
r1 AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY sha256(sha || ':0'), sha) AS r FROM rev),
r2 AS (SELECT *, CASE WHEN r > 8 THEN row_number() OVER (PARTITION BY form, r <= 8 ORDER BY fit, sha) END AS s FROM r1),
r3 AS (SELECT *, CASE WHEN s > 6 THEN row_number() OVER (PARTITION BY form, coalesce(s > 6, false) ORDER BY filled, sha) END AS u, CASE WHEN s > 6 THEN count(*) OVER (PARTITION BY form, coalesce(s > 6, false)) END AS n FROM r2),
shown AS (SELECT form, sha, CASE WHEN r <= 8 THEN 'random' WHEN s <= 6 THEN 'suspect' WHEN u <= least(2, n // 2) OR u > n - least(2, n // 2) OR n = 1 THEN 'filled' END AS block FROM r3)
"""


@query(REVIEW_SQL + "SELECT form, sha, block FROM shown WHERE block IS NOT NULL")
def suspect_block(spark: SparkSession, folder: str) -> DataFrame:
    """Members shown for review: by chance, of least fit, and of most and least fill."""
    return V.shown_members(cut(review_members(spark, folder)))


@query(REVIEW_SQL + "SELECT form, sha, filled FROM rev JOIN shown USING (form, sha) WHERE block = 'filled'")
def fill_extremes(spark: SparkSession, folder: str) -> DataFrame:
    """The members at both ends of how much is filled in, among those not shown otherwise."""
    members = cut(review_members(spark, folder))
    return V.shown_members(members).filter("block = 'filled'").join(members, ["form", "sha"]).select("form", "sha", "filled")


def given_answers(spark: SparkSession, folder: str) -> DataFrame:
    """What a reviewer said of the forms: every member of little fit is marked; splitting forms are said to split."""
    low = review_members(spark, folder).filter("fit < 0.6").groupBy("form").agg(F.collect_set("sha").alias("marked"))
    forms = table(spark, folder, "forms").select(F.col("formkey").alias("form"), F.when(F.size("splitby") > 0, "split").when(F.col("runno") > 1, "unheard of").otherwise("ok").alias("grouping"), F.array_join("splitby", "  ").alias("splitsinto"))
    return forms.filter("form % 5 <> 0").join(low, "form", "left").select("form", "grouping", F.lit("wrong").alias("naming"), "splitsinto", "marked")


RESULTS_SQL = REVIEW_SQL + r""", said AS (SELECT formkey AS form, len(coalesce(splitby, [])) > 0 AS split, nullif(trim(regexp_replace(array_to_string(splitby, '  '), ' +', ' ', 'g')), '') AS splitsinto FROM forms WHERE formkey % 5 <> 0),
low AS (SELECT rev.form, rev.sha FROM rev JOIN said USING (form) WHERE fit < 0.6), seen AS (SELECT form, sha, block FROM shown WHERE block IS NOT NULL),
res AS (SELECT f.form, CASE WHEN coalesce(d.split, false) THEN 'split' ELSE 'ok' END AS grouping, CASE WHEN d.form IS NOT NULL THEN 'wrong' ELSE 'ok' END AS naming, d.splitsinto,
  (SELECT count(*) FROM seen s WHERE s.form = f.form AND block = 'random')::BIGINT AS random_shown, (SELECT count(*) FROM seen s JOIN low l ON l.form = s.form AND l.sha = s.sha WHERE s.form = f.form AND block = 'random')::BIGINT AS random_marked,
  (SELECT count(*) FROM seen s JOIN low l ON l.form = s.form AND l.sha = s.sha WHERE s.form = f.form)::BIGINT AS marked,
  (SELECT count(*) FROM low l WHERE l.form = f.form AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.form = l.form AND s.sha = l.sha))::BIGINT AS strays, d.form IS NOT NULL AS answered FROM (SELECT DISTINCT form FROM seen) f LEFT JOIN said d ON d.form = f.form)
"""


@query(RESULTS_SQL + "SELECT form, grouping, naming, splitsinto, random_shown, random_marked, marked, strays, answered FROM res")
def review_results(spark: SparkSession, folder: str) -> DataFrame:
    """What was said of each form shown: unknown words count as right, marks of members not shown are strays."""
    return V.review_results(suspect_block(spark, folder), given_answers(spark, folder))


@query(RESULTS_SQL + r"""SELECT form, CASE WHEN grouping <> 'ok' OR naming <> 'ok' OR marked > 0 THEN form || ': grouping ' || grouping || ', naming ' || naming || ', marked ' || random_marked || '/' || random_shown || coalesce(', by ' || splitsinto, '') END AS line,
  '{"formId":' || form || ',"grouping":"' || grouping || '","naming":"' || naming || '","randomShown":' || random_shown || ',"randomMarked":' || random_marked || coalesce(',"splitsInto":"' || splitsinto || '"', '') || '}' AS json FROM res""")
def review_block(spark: SparkSession, folder: str) -> DataFrame:
    """Each reviewed form as a sentence, where something is to be said, and as a row to be read back."""
    return V.review_block(review_results(spark, folder))


@query(RESULTS_SQL + """SELECT form, CASE WHEN splitsinto IS NOT NULL THEN 'split by value' WHEN coalesce(random_marked / nullif(random_shown, 0) >= 0.25, false) THEN 'dissolved' WHEN random_marked > 0 THEN 'marked read alone' ELSE 'kept' END AS outcome FROM res""")
def review_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Where each reviewed form goes, when no wording and no threshold sets the marked members apart."""
    outcome = V.outcome(F.col("grouping"), F.col("random_marked"), F.col("random_shown"), F.col("splitsinto"), F.lit(False), F.lit(None).cast("double"))
    return review_results(spark, folder).select("form", outcome.alias("outcome"))


@query(MEMBERS_SQL + """, fits AS (SELECT DISTINCT formkey AS form, unnest(map_keys(fit)) AS sha, unnest(map_values(fit)) AS fit FROM forms),
marked AS (SELECT m.form, m.sha, coalesce(fit, 1.0) < 0.7 AS marked FROM members m LEFT JOIN fits f ON f.form = m.form AND f.sha = m.sha),
mm AS (SELECT form, count(*) FILTER (marked) AS m, count(*) FILTER (NOT marked) AS h FROM marked GROUP BY form),
hv AS (SELECT k.form, w.word, count(*) FILTER (marked) AS wm, count(*) FILTER (NOT marked) AS wh FROM marked k JOIN words w USING (sha) GROUP BY 1, 2),
b AS (SELECT hv.*, wm / m AS a, wh / h AS b FROM hv JOIN mm USING (form) WHERE m > 0 AND h > 0),
d AS (SELECT *, CASE WHEN a >= 0.8 AND b <= 0.2 THEN 'marked' WHEN b >= 0.8 AND a <= 0.2 THEN 'held' END AS direction FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY abs(a - b) DESC, word DESC) AS k FROM d WHERE direction IS NOT NULL)
SELECT form, word, direction, wm::BIGINT AS marked, wh::BIGINT AS held FROM r WHERE k <= 3""")
def separating_wording(spark: SparkSession, folder: str) -> DataFrame:
    """Words that tell members of little fit from the others."""
    marked = review_members(spark, folder).select("form", "sha", (F.col("fit") < 0.7).alias("marked")).distinct()
    return V.separating_wording(marked, O.words_of(texts(spark, folder)))


@query("""WITH fits AS (SELECT DISTINCT formkey AS form, unnest(map_keys(fit)) AS sha, unnest(map_values(fit)) AS fit FROM forms), mem AS (SELECT DISTINCT formkey AS form, unnest(members) AS sha FROM forms)
SELECT m.form, count(*)::BIGINT AS random_shown, (count(*) FILTER (f.fit < 0.6))::BIGINT AS random_marked, 0::BIGINT AS strays FROM mem m LEFT JOIN fits f ON f.form = m.form AND f.sha = m.sha GROUP BY 1""")
def failure_rate(spark: SparkSession, folder: str) -> DataFrame:
    """All members shown at random, those of little fit marked."""
    members = review_members(spark, folder).select("form", "sha", "fit").distinct()
    return V.failure_rates(members.select("form", "sha", F.lit("random").alias("block")), members.filter("fit < 0.6"))
