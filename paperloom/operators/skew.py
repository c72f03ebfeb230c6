"""Joins that hold when one key has a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows; so there are at most 1 / HOT_SHARE hot keys, whatever the size of the input.
HOT_SHARE = 1 / 1000
#: Rows of one key that one task takes; a key that is not hot but has more of them is spread over several.
TASK_ROWS = 2_000_000


def lookup(big: DataFrame, dim: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``big`` left-joined to ``dim``, which has one row for each key at most.

    rows: the number of rows of ``big``.  Rows of hot keys meet the at most 1 / HOT_SHARE rows that ``dim`` has for
    them by broadcast and are never shuffled; all others meet ``dim`` by an ordinary join.  Where a key that is not hot
    can still have more than ``TASK_ROWS`` rows, ``dim`` is repeated under so many salts that none has.  Null keys find
    nothing and are never shuffled either.
    """
    least = max(10_000, int(rows * HOT_SHARE))
    salts = -(-least // TASK_ROWS)

    def joined(df: DataFrame) -> DataFrame:
        if salts == 1:
            return df.join(dim, keys, "left")
        salted = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.hash(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))
        return df.withColumn("_salt", salt).join(salted, [*keys, "_salt"], "left").drop("_salt")

    if rows < least:
        return joined(big)
    hot = big.groupBy(*keys).count().filter(F.col("count") >= least).select(*keys, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot.join(dim, keys, "left"))
    no_key = reduce(lambda e, k: e | F.col(k).isNull(), keys, F.lit(False))
    marked = big.join(hot, keys, "left")
    done = marked.filter(F.col("_hot") | no_key).drop("_hot")
    rest = joined(marked.filter(F.col("_hot").isNull() & ~no_key).select(*big.columns))
    return rest.select(*done.columns).unionByName(done)


#: Rows of a kept frame up to which it is broadcast.
BROADCAST_ROWS = 300_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, marked for broadcast if it has few rows; Spark chooses another join otherwise."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
