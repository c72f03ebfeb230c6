"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are put in a shuffled order that depends only on their keys.  A copy's virtual finish time is
the source's tokens up to its end, earlier repeats included, divided by the source's weight.  All copies are sorted by
finish time over the whole cluster and taken until the total budget is used.

Weights are the shares of the sources that have tokens, scaled to sum to 1.  Without a given budget it is the largest
total at which no source runs dry, so every share is met to within a document; with a larger one dry sources stop and
the others go on.  Documents whose source is null or not listed, or that have no tokens (null and empty texts), are not
used.  Ties are broken by source, repeat and key; repeated keys are separate documents.  Cumulative sums come from
range partitions with per-partition offsets, so a source with a third of all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.prefix import running_sum


def level(budget: float, sources: dict[str, tuple[float, float]]) -> float:
    """The virtual time at which sources of (weight, tokens they can give) have given the budget together."""
    left, time = budget, 0.0
    for name in sorted(sources, key=lambda s: sources[s][1] / sources[s][0]):
        open_weight = sum(w for s, (w, c) in sources.items() if c / w > time)
        dry = sources[name][1] / sources[name][0]
        if (dry - time) * open_weight >= left:
            return time + left / open_weight if open_weight else time
        left -= (dry - time) * open_weight
        time = dry
    return time


def mix(sized: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 0) -> DataFrame:
    """(doc_id, source, repeat, tokens, finish, total): the chosen copies.

    sized: doc_id, source, tokens (kept by the caller).  targets: source, share, maxrepeats, a few rows.
    total: tokens of the mixture up to and with this copy, in order of finish time.
    """
    wanted = {r[0]: (float(r[1]), int(r[2])) for r in targets.select("source", "share", "maxrepeats").collect() if r[0] is not None and r[1] and r[2] and r[1] > 0 and r[2] > 0}
    spark = sized.sparkSession
    used = sized.filter(F.col("tokens") > 0).join(targets.select("source"), "source", "left_semi")
    sums = [r for r in used.groupBy("source").agg(F.sum("tokens"), F.max("tokens")).collect() if r[0] in wanted]
    have = {r[0]: int(r[1]) for r in sums}
    scale = sum(wanted[s][0] for s in have)
    plan = {s: (wanted[s][0] / scale, float(have[s] * wanted[s][1])) for s in have}
    total = budget if budget is not None else int(min((c / w for w, c in plan.values()), default=0))
    time = level(total, plan) if plan else 0.0
    # One document later in every source the budget is used up, so the total decides before that; 1 is for rounding.
    late = (time + max((r[2] / plan[r[0]][0] for r in sums), default=0.0)) * (1 + 1e-9) + 1
    # How often a source is gone through until then; never more than it may be.
    rows = [(s, plan[s][0], have[s], min(wanted[s][1], int(late * plan[s][0] / have[s]) + 1)) for s in sorted(plan)]
    rates = spark.createDataFrame(rows, "source string, weight double, per_pass bigint, passes int")
    shuffled = used.join(F.broadcast(rates), "source").withColumn("_place", F.xxhash64("doc_id", F.lit(seed)))
    summed = running_sum(shuffled, ["source"], ["_place", "doc_id"], "tokens", "_upto")
    copies = summed.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    copies = copies.withColumn("finish", ((F.col("repeat") - 1) * F.col("per_pass") + F.col("_upto")) / F.col("weight"))
    near = copies.filter(F.col("finish") <= F.lit(late)).select("doc_id", "source", "repeat", "tokens", "finish", F.lit(0).alias("_all"))
    taken = running_sum(near, ["_all"], ["finish", "source", "repeat", "doc_id"], "tokens", "total")
    return taken.filter(F.col("total") <= F.lit(total)).drop("_all")


def shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target: what was asked, and what was reached; sources without documents reach nothing."""
    got = chosen.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("copies"), F.count_distinct("doc_id").alias("documents"), F.max("repeat").alias("mostrepeats"))
    every = Window.partitionBy(F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        targets.select("source", "share", "maxrepeats").join(got, "source", "left")
        .withColumn("tokens", zero("tokens")).withColumn("reached", F.col("tokens") / F.nullif(F.sum("tokens").over(every), F.lit(0)))
        .withColumns({"copies": zero("copies"), "documents": zero("documents"), "mostrepeats": zero("mostrepeats")})
    )
