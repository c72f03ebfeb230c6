"""Problem 4: texts and lists that are edited versions of one another."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.registry import query
from paperloom.llm.sketches import all_pairs, groups, near_duplicates, word_set
from paperloom.sources.tables import table

THRESHOLD = Fraction(3, 4)
LEAST = {"extracted": 20, "forms": 5}


def sets(spark: SparkSession, folder: str) -> DataFrame:
    """The word sets of the texts and the member sets of the forms, those of enough elements."""
    texts = table(spark, folder, "extracted").filter(F.col("textfile").isNotNull())
    lists = table(spark, folder, "forms").filter(F.col("members").isNotNull())
    words = texts.select(F.lit("extracted").alias("origin"), F.col("extractid").alias("key"), word_set(F.col("textfile")).alias("elements"))
    members = lists.select(F.lit("forms").alias("origin"), F.col("formkey").alias("key"), F.array_distinct(F.array_compact("members")).alias("elements"))
    least = F.when(F.col("origin") == "forms", LEAST["forms"]).otherwise(LEAST["extracted"])
    return words.unionByName(members).filter(F.size("elements") >= least)


SQL = r"""
WITH RECURSIVE sets AS (
  SELECT 'extracted' AS origin, extractid AS key, list_sort(list_distinct(list_filter(string_split_regex(lower(textfile), '[^\p{L}\p{N}]+'), lambda w: w <> ''))) AS elements, 20 AS least FROM extracted WHERE textfile IS NOT NULL
  UNION ALL SELECT 'forms', formkey, list_sort(list_distinct(list_filter(members, lambda m: m IS NOT NULL))), 5 FROM forms WHERE members IS NOT NULL),
kept AS (SELECT origin, key, elements, len(elements) AS n, min(key) OVER (PARTITION BY origin, elements) AS class FROM sets WHERE len(elements) >= least),
words AS (SELECT origin, key, n, unnest(elements) AS w FROM kept WHERE key = class),
met AS (SELECT a.origin, a.key AS a, b.key AS b, any_value(a.n + b.n) AS both_, count(*) AS shared FROM words a JOIN words b ON a.origin = b.origin AND a.w = b.w AND a.key < b.key AND least(a.n, b.n) * 4 >= greatest(a.n, b.n) * 3 GROUP BY 1, 2, 3),
links AS (SELECT origin, a, b FROM met WHERE shared * 4 >= (both_ - shared) * 3)
"""


@query(SQL + """, every AS (SELECT origin, a, b FROM links UNION ALL SELECT origin, class, class FROM kept WHERE key = class)
SELECT e.origin, least(x.key, y.key) AS firstkey, greatest(x.key, y.key) AS secondkey FROM every e JOIN kept x ON x.origin = e.origin AND x.class = e.a JOIN kept y ON y.origin = e.origin AND y.class = e.b WHERE e.a <> e.b OR x.key < y.key""")
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    members, links = near_duplicates(sets(spark, folder), min(LEAST.values()), THRESHOLD)
    return all_pairs(members, links)


@query(SQL + """, ends AS (SELECT origin, a AS x, b AS y FROM links UNION ALL SELECT origin, b, a FROM links),
reach AS (SELECT DISTINCT origin, x, x AS y FROM ends UNION SELECT r.origin, r.x, e.y FROM reach r JOIN ends e ON e.origin = r.origin AND e.x = r.y),
grp AS (SELECT origin, x, min(y) AS g FROM reach GROUP BY 1, 2), num AS (SELECT origin, x, count(*) AS n FROM ends GROUP BY 1, 2)
SELECT k.origin, k.key, k.class, coalesce(num.n, 0)::BIGINT AS links, coalesce(g, k.class) AS "group" FROM kept k LEFT JOIN grp ON grp.origin = k.origin AND grp.x = k.class LEFT JOIN num ON num.origin = k.origin AND num.x = k.class""")
def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Each text and list with its class of equal sets, its number of links and its group."""
    members, links = near_duplicates(sets(spark, folder), min(LEAST.values()), THRESHOLD)
    return groups(members, links)
