"""Manifests at the edge: JSON and CSV in, answer files, one file per task and pages out."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that an export of items must have.
ITEM_COLUMNS = ("table", "id", "identifier", "name", "template", "archived")


def read_manifest(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A JSON manifest of a declared schema; a missing file is named, a malformed one fails."""
    try:
        return spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST")
    except Exception as x:
        raise FileNotFoundError(f"{path}: the step that writes it has not run") from x


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """An export of items: six required columns, all text; a byte order mark is dropped, nulls become empty."""
    raw = spark.read.csv(path, header=True, multiLine=True, inferSchema=False, escape='"', encoding="UTF-8")
    names = [c.lstrip("﻿").strip() for c in raw.columns]
    raw = raw.toDF(*names)
    missing = [c for c in ITEM_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias("itemtable" if c == "table" else c) for c in ITEM_COLUMNS])


def read_answers(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One answer for each file: its fields, the file, and ``fault`` where it cannot be parsed."""
    raw = spark.read.text(folder, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    parsed = F.from_json("value", schema)
    return raw.withColumn("answer", parsed).select("file", "answer.*", F.when(F.try_parse_json("value").isNull(), "not JSON").alias("fault"))


def answer_outcomes(tasks: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Each task with what came back: ``answered``, ``missing``, ``unreadable`` or ``wrong id``; then the answer's fields.

    tasks: key.  answers: file, fault and fields, the key among them, as of ``read_answers``; a task's file is named by
    it.  An answer counts only under the id it names, so that of another form is refused; null fields unless answered.
    """
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    back = answers.select(stem.alias(key), F.col(key).alias("_said"), "fault", F.struct(*[c for c in answers.columns if c not in ("file", "fault", key)]).alias("_answer"), F.lit(True).alias("_there"))
    first = back.groupBy(key).agg(F.min_by(F.struct("_said", "fault", "_answer", "_there"), F.to_json(F.struct("_said", "fault", "_answer"))).alias("b"))
    joined = tasks.select(key).distinct().join(first, key, "left")
    outcome = F.when(F.col("b._there").isNull(), "missing").when(F.col("b.fault").isNotNull(), "unreadable").when(~F.col("b._said").eqNullSafe(F.col(key).cast("string")), "wrong id").otherwise("answered")
    told = joined.withColumn("outcome", outcome)
    fields = [c for c in answers.columns if c not in ("file", "fault", key)]
    return told.select(key, "outcome", *[F.when(F.col("outcome") == "answered", F.col(f"b._answer.{c}")).alias(c) for c in fields])


def read_types(spark: SparkSession, path: str) -> DataFrame:
    """(type_id, canonical, phrase) of lines ``N: Name | other | other``; lines without a number have none."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    number = F.regexp_extract("value", r"^\s*(\d+):", 1)
    body = F.split(F.regexp_replace("value", r"^\s*\d+:", ""), r"\|")
    return lines.select(F.nullif(number, F.lit("")).cast("int").alias("type_id"), F.trim(body[0]).alias("canonical"), F.explode(F.transform(body, lambda w: F.trim(w))).alias("phrase"))


def fenced(text, name: str, schema: str):
    """The JSON of a fenced block in a text; null where there is none."""
    return F.from_json(F.nullif(F.regexp_extract(text, rf"(?s)```{name}\s*\n(.*?)```", 1), F.lit("")), schema)


def fenced_fault(text, name: str):
    """Why a text has no usable fenced block: none there, or not JSON; null if it has."""
    body = F.regexp_extract(text, rf"(?s)```{name}\s*\n(.*?)```", 1)
    return F.when(F.coalesce(body, F.lit("")) == "", "no block").when(F.try_parse_json(body).isNull(), "not JSON")


def data_sheets(rows: DataFrame, identifiers: dict[str, str]) -> dict[str, DataFrame]:
    """One frame for each table, its first column named as the table names its identifier.

    rows: itemtable, identifier and the other columns of a data sheet; identifiers: table -> name of its identifier.
    """
    rest = [c for c in rows.columns if c not in ("itemtable", "identifier")]
    return {t: rows.filter(F.col("itemtable") == t).select(F.col("identifier").alias(name), *rest) for t, name in identifiers.items()}


def shown(df: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The first rows of a report and how many more there are; manifests are never cut."""
    return df.limit(most), max(df.count() - most, 0)


def same_export(first: str, second: str) -> bool:
    """Whether two files come from one export: the last parts of their stems are equal."""
    stem = lambda p: p.rsplit("/", 1)[-1].rsplit(".", 1)[0].rsplit("_", 1)[-1]
    return stem(first) == stem(second)


def write_manifest(df: DataFrame, path: str) -> None:
    """A manifest as JSON lines, one file; for reports and small lists only."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_tasks(df: DataFrame, path: str, by: str) -> None:
    """The rows of each task as JSON in a folder of its own."""
    fields = [c for c in df.columns if c != by]
    df.select(by, F.to_json(F.struct(*fields)).alias("value")).repartition(by).write.mode("overwrite").partitionBy(by).text(path)


def page(template: str, data: object, placeholder: str) -> str:
    """A page with the data in place of the placeholder, safe inside a script element."""
    text = json.dumps(data, ensure_ascii=False)
    for sign in ("<", " ", " "):
        text = text.replace(sign, f"\\u{ord(sign):04x}")
    if placeholder not in template:
        raise ValueError("the template has no place for the data")
    return template.replace(placeholder, text)
