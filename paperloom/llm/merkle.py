"""Duplicates hidden by formatting: Merkle-style digests of nested records, made bottom-up as column expressions.

A leaf is normalised to its letters and digits, case-blind, and hashed.  An inner node hashes the sorted digests of its
children, so the order of list elements, of map entries and of struct fields does not matter.  Records group by root
digest; the canonical form beside it is compared in full, so a collision of digests never joins two records.

Null, empty and symbol-only leaves are no leaves; a record without leaves has a null digest and is no record.
Repeated children count as often as they occur.  Everything runs in the JVM; the only shuffle is the pre-aggregated
grouping, and rows come back to their group by a join that never shuffles the rows of a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.text import casefold
from paperloom.operators.skew import lookup


def leaf(c: Column) -> Column:
    """Letters and digits of the value, case-blind; null where there is none."""
    return F.nullif(F.regexp_replace(casefold(c.cast("string")), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def _compact(c: Column) -> Column:
    return F.filter(c, lambda x: x.isNotNull())


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def normalised(c: Column, kind: T.DataType) -> tuple[Column, T.DataType]:
    """The record with its leaves normalised, and its type; maps become lists of key and value."""
    if isinstance(kind, T.ArrayType):
        inner: list[T.DataType] = []

        def one(x: Column) -> Column:
            got, of = normalised(x, kind.elementType)
            inner.append(of)
            return got

        return F.transform(c, one), T.ArrayType(inner[0])
    if isinstance(kind, T.StructType):
        parts = {f.name: normalised(c[f.name], f.dataType) for f in kind.fields}
        return F.struct(*[v.alias(n) for n, (v, _) in parts.items()]), T.StructType([T.StructField(n, t) for n, (_, t) in parts.items()])
    if isinstance(kind, T.MapType):
        types: list[T.DataType] = []

        def pair(e: Column) -> Column:
            (key, of_key), (value, of_value) = normalised(e["key"], kind.keyType), normalised(e["value"], kind.valueType)
            types.append(T.StructType([T.StructField("key", of_key), T.StructField("value", of_value)]))
            return F.struct(key.alias("key"), value.alias("value"))

        entries = F.transform(F.map_entries(c), pair)
        return entries, T.MapType(types[0]["key"].dataType, types[0]["value"].dataType)
    return leaf(c), T.StringType()


def canonical(c: Column, kind: T.DataType) -> Column:
    """The record in one spelling: children in sorted order, brackets around each inner node; null without leaves.

    c, kind: as of ``normalised``.
    """
    if isinstance(kind, T.ArrayType):
        parts = _compact(F.transform(c, lambda x: canonical(x, kind.elementType)))
    elif isinstance(kind, T.StructType):
        parts = _compact(F.array(*[F.concat(F.lit(f.name + ":"), canonical(c[f.name], f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]))
    elif isinstance(kind, T.MapType):
        parts = _compact(F.transform(c, lambda e: F.concat_ws(":", canonical(e["key"], kind.keyType), canonical(e["value"], kind.valueType))))
    else:
        return c
    return _let(parts, lambda p: F.when(F.size(p) > 0, F.concat(F.lit("("), F.array_join(F.array_sort(p), ","), F.lit(")"))))


def digest(c: Column, kind: T.DataType) -> Column:
    """The Merkle root of the record: 64 bits; null without leaves.  Each child is digested once.

    c, kind: as of ``normalised``.
    """
    if isinstance(kind, T.ArrayType):
        kids = _compact(F.transform(c, lambda x: digest(x, kind.elementType)))
    elif isinstance(kind, T.StructType):
        named = [_let(digest(c[f.name], f.dataType), lambda d, name=f.name: F.when(d.isNotNull(), F.xxhash64(F.lit(name), d))) for f in kind.fields]
        kids = _compact(F.array(*named))
    elif isinstance(kind, T.MapType):
        kids = _compact(F.transform(c, lambda e: F.xxhash64(digest(e["key"], kind.keyType), digest(e["value"], kind.valueType))))
    else:
        return F.when(c.isNotNull(), F.xxhash64(c))
    return _let(kids, lambda k: F.when(F.size(k) > 0, F.xxhash64(F.array_sort(k))))


def records(df: DataFrame, row: str, scope: str, record: str) -> DataFrame:
    """(_row, _scope, _root, _form): the rows that hold a record.  A null scope is a scope of its own.

    Leaves are normalised once; root and form are made of them, and rows without a root are left out by a generator,
    since a filter would be moved before the projection and compute the root twice.
    """
    scoped = F.when(F.col(scope).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(scope).cast("string")))
    leaves, kind = normalised(F.col(record), df.schema[record].dataType)
    held = df.select(F.col(row).alias("_row"), scoped.alias("_scope"), leaves.alias("_leaves"))
    made = F.filter(F.array(F.struct(digest(F.col("_leaves"), kind).alias("_root"), canonical(F.col("_leaves"), kind).alias("_form"))), lambda r: r["_root"].isNotNull())
    return held.select("_row", "_scope", F.inline(made))


def collapse(found: DataFrame) -> DataFrame:
    """(_scope, _root, _form, first, copies): one row for each distinct record of a scope."""
    return found.groupBy("_scope", "_root", "_form").agg(F.min("_row").alias("first"), F.count("*").alias("copies"))


def copies(found: DataFrame, rows: int) -> DataFrame:
    """(first, _row): each row of a record beside its first one."""
    groups = collapse(found).filter(F.col("copies") > 1).select("_scope", "_root", "_form", "first")
    return lookup(found, groups, ["_scope", "_root", "_form"], rows).filter(F.col("_row") != F.col("first")).select("first", "_row")
