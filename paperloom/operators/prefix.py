"""Running sums and row numbers over a global order, without bringing a group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.skew import small
from paperloom.sources.tables import cut


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` up to and with each row, in the order, per group.

    Rows are range-partitioned by group and order and kept (a range partitioning is sampled, so it is never computed
    twice); each partition adds the sums of the partitions before it, one number for each partition and group that meet
    there; these are broadcast if they are few.  No group is in one task.
    """
    ranged = cut(df.repartitionByRange(*groups, *order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part", *groups).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn(out, F.sum(value).over(inside))
    return summed.join(small(offsets), ["_part", *groups]).withColumn(out, F.col(out) + F.col("_offset")).drop("_part", "_offset")


def row_numbers(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``out``: 0, 1, 2 ... in the global order, which must be total."""
    numbered = running_sum(df.withColumns({"_all": F.lit(0), "_one": F.lit(1)}), ["_all"], order, "_one", out)
    return numbered.withColumn(out, F.col(out) - 1).drop("_all", "_one")
