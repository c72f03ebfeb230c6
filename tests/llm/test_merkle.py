from pyspark.sql import functions as F

from paperloom.llm import merkle


def firsts(spark, rows, kind="array<string>"):
    df = spark.createDataFrame(rows, f"id bigint, s string, r {kind}, _row string, first string".replace(", _row string, first string", ""))
    return {(r["first"], r["_row"]) for r in merkle.copies(merkle.records(df, "id", "s", "r"), 100).collect()}


def test_parts_in_any_order(spark):
    rows = [(1, "a", ["Fire Door", "EU"]), (2, "a", [" eu ", "fire-DOOR"]), (3, "b", ["EU", "Fire Door"]), (4, "a", ["EU", "EU", "Fire Door"]), (5, "a", ["Fire Door", "", "EU", "--"])]
    assert firsts(spark, rows) == {(1, 2), (1, 5)}


def test_nulls_blanks_and_long_ones(spark):
    rows = [(1, None, ["x"]), (2, None, ["X "]), (3, "", ["x"]), (4, "a", None), (5, "a", []), (6, "a", ["-", None]), (7, "a", ["y" * 200_000]), (8, "a", ["Y " * 200_000])]
    assert firsts(spark, rows) == {(1, 2), (7, 8)}
    assert firsts(spark, []) == set()


def test_case_of_letters_without_a_twin(spark):
    assert firsts(spark, [(1, "a", ["Maß"]), (2, "a", ["MASS"]), (3, "a", ["ｘ１"]), (4, "a", ["x1"])]) == {(1, 2)}


def test_nested_records(spark):
    kind = "struct<b:string,a:array<struct<k:string,v:int>>,m:map<string,string>>"
    rows = [
        (1, "s", ("X y", [("p", 1), ("q", 2)], {"u": "1", "w": "2"})), (2, "s", ("xY", [("Q", 2), ("P", 1)], {"w": "2", "u": "1"})),
        (3, "s", ("xy", [("q", 1), ("p", 2)], {"u": "1", "w": "2"})), (4, "s", ("xy", [("p", 1), ("q", 2)], {"u": "2", "w": "1"})),
    ]
    assert firsts(spark, rows, kind) == {(1, 2)}


def test_a_collision_joins_nothing(spark):
    found = spark.createDataFrame([(1, "=a", 7, "(x)"), (2, "=a", 7, "(y)"), (3, "=a", 7, "(x)")], "_row bigint, _scope string, _root bigint, _form string")
    assert {tuple(r) for r in merkle.copies(found, 10).collect()} == {(1, 3)}
    assert {(r["first"], r["copies"]) for r in merkle.collapse(found).collect()} == {(1, 2), (2, 1)}


def test_one_group_with_most_rows(spark):
    rows = spark.range(40_000).select(F.col("id"), F.lit("s").alias("s"), F.array(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).alias("r"))
    got = merkle.copies(merkle.records(rows, "id", "s", "r"), 40_000)
    assert got.count() == 13_333 and got.select("first").distinct().collect()[0][0] == 0


def test_letters_of_one_upper_case_meet(spark):
    rows = [(1, "s", ["ΟΔΟΣ"]), (2, "s", ["οδος"]), (3, "s", ["οδοσ"]), (4, "s", ["MASS"]), (5, "s", ["maſs"]), (6, "s", ["maß"])]
    assert firsts(spark, rows) == {(1, 2), (1, 3), (4, 5), (4, 6)}
