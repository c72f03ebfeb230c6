import datetime as dt

from pyspark.sql import functions as F

from paperloom.operators.references import Parent, Reference, orphan_cascade, orphan_report
from paperloom.operators.skew import lookup

T = dt.datetime(2024, 1, 10)
EARLY, LATE = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def parent(spark, rows, name="p"):
    df = spark.createDataFrame(rows, "key string, gone boolean, since timestamp_ntz")
    return Parent(name, df, F.col("key"), withdrawn=F.col("gone"), since=F.col("since"))


def test_reasons_in_order(spark):
    p = parent(spark, [("a", False, EARLY), ("b", True, LATE), ("c", False, LATE), ("d", True, EARLY), ("d", False, LATE), ("e", False, None)])
    child = spark.createDataFrame([(1, "a", T), (2, "b", T), (3, "c", T), (4, "d", T), (5, "x", T), (6, None, T), (7, "c", None), (8, "e", T), (5, "x", T)], "id bigint, ref string, at timestamp_ntz")
    r = Reference("ref", "child", child, F.col("id"), F.col("ref"), p, F.col("at"))
    got = sorted((x["_row"], x["_why"]) for x in orphan_cascade([r], 100).collect())
    assert got == [(2, "deleted"), (3, "late"), (5, "missing"), (5, "missing")]


def test_empty_tables(spark):
    p = parent(spark, [])
    none = spark.createDataFrame([], "id bigint, ref string")
    assert orphan_cascade([Reference("ref", "child", none, F.col("id"), F.col("ref"), p)], 10).count() == 0
    some = spark.createDataFrame([(1, "a")], "id bigint, ref string")
    assert [x["_why"] for x in orphan_cascade([Reference("ref", "child", some, F.col("id"), F.col("ref"), p)], 10).collect()] == ["missing"]


def test_cascade_with_a_cycle(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "gone"), ("d", "c"), ("e", "d"), ("f", None)], "id string, up string")
    p = Parent("t", rows, F.col("id"))
    r = Reference("up", "t", rows, F.col("id"), F.col("up"), p, own=F.col("id"))
    got = {(x["_row"], x["_why"], x["_round"]) for x in orphan_cascade([r], 10).collect()}
    assert got == {("c", "missing", 0), ("d", "inherited", 1), ("e", "inherited", 2)}


def test_report_counts_by_month(spark):
    p = parent(spark, [])
    child = spark.createDataFrame([(1, "a", T), (2, "b", T), (3, "b", LATE), (4, "b", None)], "id bigint, ref string, at timestamp_ntz")
    got = {(x["month"], x["orphans"]) for x in orphan_report(orphan_cascade([Reference("r", "c", child, F.col("id"), F.col("ref"), p, F.col("at"))], 9)).collect()}
    assert got == {("2024-01", 2), ("2024-02", 1), (None, 1)}


def test_lookup_with_a_hot_key(spark):
    big = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 100 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"), F.lit(1).alias("extra"))
    dim = spark.range(0, 60_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(spark.createDataFrame([(7, 14)], "k bigint, v bigint"))
    mine = lookup(big, dim, ["k"], 60_000)
    plain = big.join(dim, "k", "left")
    assert mine.count() == 60_000
    assert mine.select("k", "row", "v").exceptAll(plain.select("k", "row", "v")).count() == 0
    assert plain.select("k", "row", "v").exceptAll(mine.select("k", "row", "v")).count() == 0


def test_a_long_chain_is_followed_to_its_end_within_scopes(spark):
    rows = spark.createDataFrame([("n0", "gone", "s")] + [(f"n{k}", f"n{k - 1}", "s") for k in range(1, 12)] + [("m", "n3", "other"), ("n4", None, "third"), ("k", "n4", "third")], "id string, up string, scope string")
    p = Parent("t", rows, F.col("id"), scope=F.col("scope"))
    r = Reference("up", "t", rows, F.col("id"), F.col("up"), p, own=F.col("id"), own_scope=F.col("scope"), scope=F.col("scope"))
    got = {x["_row"]: (x["_why"], x["_round"]) for x in orphan_cascade([r], 20).collect()}
    assert got == {"n0": ("missing", 0), "m": ("missing", 0), **{f"n{k}": ("inherited", k) for k in range(1, 12)}}


def test_several_references_of_one_table(spark):
    p, q = parent(spark, [("a", False, EARLY)]), parent(spark, [("b", True, EARLY)], "q")
    rows = spark.createDataFrame([(1, "a", "b"), (2, "x", None), (3, None, None)], "id bigint, one string, two string")
    refs = [Reference(c, "child", rows, F.col("id"), F.col(c), x) for c, x in (("one", p), ("two", q))]
    assert {(x["_ref"], x["_row"], x["_why"]) for x in orphan_cascade(refs, 10).collect()} == {("two", 1, "deleted"), ("one", 2, "missing")}
