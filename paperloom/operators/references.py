"""References to records that do not exist: direct orphans with a reason, and the cascade to what hangs on them.

Tables refer to each other by keys.  A reference is an orphan when it names no row (``missing``), only withdrawn rows
(``deleted``) or rows that arrive after the referring row (``late``); the first that applies is its reason.  A row whose
parent row is itself an orphan is an inherited orphan.  The cascade goes down the graph by semi-joins until no round
finds a new row, so cycles end as well, and never before.

Nulls and blanks are no references and give no row.  Empty tables give no rows (an empty parent makes every reference
``missing``).  Repeated rows of a child each give a row.  Other columns of the tables are dropped before any join, so
their names never clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.skew import lookup
from paperloom.sources.tables import cut


@dataclass(frozen=True)
class Parent:
    """What may be referred to: rows with a key, and per row whether it is withdrawn and since when it is there."""

    table: str
    rows: DataFrame
    key: Column
    scope: Column = field(default_factory=lambda: F.lit(""))
    withdrawn: Column = field(default_factory=lambda: F.lit(False))
    since: Column = field(default_factory=lambda: F.lit(None).cast("timestamp_ntz"))

    def dimension(self, name: str) -> DataFrame:
        """One row for each key: all of its rows withdrawn, earliest arrival."""
        return (
            self.rows.select(F.lit(name).alias("_ref"), self.scope.alias("_scope"), self.key.alias("_key"), self.withdrawn.alias("w"), self.since.alias("s"))
            .filter(F.col("_key").isNotNull())
            .groupBy("_ref", "_scope", "_key")
            .agg(F.min("w").alias("_withdrawn"), F.min("s").alias("_since"))
        )


@dataclass(frozen=True)
class Reference:
    """A column of a child table that names rows of a parent.  row: the child's own key; at: its time."""

    name: str
    child: str
    rows: DataFrame
    row: Column
    key: Column
    parent: Parent
    at: Column = field(default_factory=lambda: F.lit(None).cast("timestamp_ntz"))
    scope: Column = field(default_factory=lambda: F.lit(""))
    #: The key of the child's rows by which other tables refer to it, if any do, and the scope it is unique in.
    own: Column | None = None
    own_scope: Column = field(default_factory=lambda: F.lit(""))

    def entry(self) -> Column:
        """The reference as one entry of the long form; null where there is none."""
        own = self.own.cast("string") if self.own is not None else F.lit(None).cast("string")
        values = {"_ref": F.lit(self.name), "_row": self.row, "_at": self.at, "_scope": self.scope, "_key": self.key, "_own": own, "_own_scope": self.own_scope}
        return F.when(self.key.isNotNull(), F.struct(*[v.alias(n) for n, v in values.items()]))


def long_form(references: list[Reference]) -> DataFrame:
    """(_ref, _row, _at, _scope, _key, _own, _own_scope): every reference of all tables; each table is read once."""
    by_rows: dict[int, list[Reference]] = {}
    for r in references:
        by_rows.setdefault(id(r.rows), []).append(r)
    parts = [group[0].rows.select(F.inline(F.array_compact(F.array(*[r.entry() for r in group])))) for group in by_rows.values()]
    return reduce(DataFrame.unionByName, parts)


def direct_orphans(references: list[Reference], rows: int) -> DataFrame:
    """(_ref, _row, _at, _own, _own_scope, _why): every orphan reference of all tables, by one join of the long form.

    rows: how many rows the children have together, or more; decides from when on a key counts as hot.
    """
    dims = reduce(DataFrame.unionByName, [r.parent.dimension(r.name) for r in references])
    why = (
        F.when(F.col("_withdrawn").isNull(), "missing").when(F.col("_withdrawn"), "deleted").when(F.col("_since") > F.col("_at"), "late")
    )
    return lookup(long_form(references), dims, ["_ref", "_scope", "_key"], rows).withColumn("_why", why).filter(F.col("_why").isNotNull()).select("_ref", "_row", "_at", "_own", "_own_scope", "_why")


def orphan_cascade(references: list[Reference], rows: int) -> DataFrame:
    """(_ref, _row, _at, _why, _round): direct orphans in round 0, inherited ones (why ``inherited``) after it.

    A round takes the rows that became orphans in the round before, by their own key, and semi-joins the references
    to their table, within the scope of the reference.  A row is told once for each of its references that is an orphan,
    with its first reason.  Only tables that are both child and parent can hand anything on; without one round 0 is all.
    """
    direct = direct_orphans(references, rows)
    owners = {r.child for r in references if r.own is not None}
    downward = [r for r in references if r.parent.table in owners]
    seen = cut(direct.withColumn("_round", F.lit(0)))
    if not downward:
        return seen.drop("_own", "_own_scope")
    child_of = reduce(lambda e, r: e.when(F.col("_ref") == r.name, r.child), references, F.when(F.lit(False), F.lit("")))
    parent_of = reduce(lambda e, r: e.when(F.col("_ref") == r.name, r.parent.table), downward, F.when(F.lit(False), F.lit("")))
    below = long_form(downward)
    fresh, number = seen, 0
    while True:
        number += 1
        gone = fresh.filter(F.col("_own").isNotNull()).select(child_of.alias("_table"), F.col("_own_scope").alias("_scope"), F.col("_own").alias("_key")).distinct()
        # The rows below by a join that holds when one parent has a third of them.
        met = lookup(below.withColumn("_table", parent_of), gone.withColumn("_gone", F.lit(True)), ["_table", "_scope", "_key"], rows).filter("_gone")
        new = met.select("_ref", "_row", "_at", "_own", "_own_scope", F.lit("inherited").alias("_why"), F.lit(number).alias("_round"))
        fresh = cut(new.join(seen.select("_ref", "_row").distinct(), ["_ref", "_row"], "left_anti").dropDuplicates(["_ref", "_row"]))
        if fresh.isEmpty():
            return seen.drop("_own", "_own_scope")
        seen = seen.unionByName(fresh)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans by reference, month of the referring row and reason; a null time is its own period."""
    return orphans.groupBy(F.col("_ref").alias("fieldname"), F.date_format("_at", "yyyy-MM").alias("month"), F.col("_why").alias("why")).agg(F.count("*").alias("orphans"))
