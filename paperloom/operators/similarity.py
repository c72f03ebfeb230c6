"""Similarity joins of signatures: which sets of words are at least so much alike.

Equal signatures are one class, so copies are never paired.  Where there are few words, as in signatures by a floor,
most classes share some word, and all are held against all as rows of bits: stretches of classes go to every task, no pair
is shuffled, and only similar ones leave a block.  Where there are many, words are ordered by how many classes have them,
rarest first; two sets over a threshold share one of the first n - ceil(t n) + 1 words of each, so only those are listed
and met.  A pair is told once, at its first common word, when the words that follow can still make it similar.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators import bits as B
from paperloom.operators.skew import lookup
from paperloom.sources.tables import cut

#: Different words up to which classes are held against each other as rows of bits, and the most classes sent at once.
BIT_WORDS, SENT = 20_000, 65_536


def signature_classes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: sha, class; classes: class, signature): equal signatures go by the smallest sha that has them.

    signed: sha, signature.  Empty signatures are similar to nothing and are each a class of their own, not listed.
    """
    some = cut(signed.filter(F.size("signature") > 0).select("sha", "signature", F.xxhash64("signature").alias("_h")))
    classes = cut(some.groupBy("_h", "signature").agg(F.min("sha").alias("class")))
    members = lookup(some, classes, ["_h", "signature"], some.count()).select("sha", "class")
    empty = signed.filter(F.size("signature") == 0).select("sha", F.col("sha").alias("class"))
    return members.unionByName(empty), classes.select("class", "signature")


def similarity_edges(classes: DataFrame, threshold: Fraction) -> DataFrame:
    """(a, b, shared, united) with a < b: the pairs of classes whose Jaccard similarity is the threshold or more.

    classes: class, signature (words, each once, not empty).  Exact; shared / united is the similarity.
    """
    if not 0 < threshold <= 1:
        raise ValueError("a threshold is over 0 and at most 1")
    if classes.select(F.explode("signature").alias("w")).distinct().limit(BIT_WORDS + 1).count() <= BIT_WORDS:
        return _edges_by_bits(classes, threshold)
    return _edges_by_lists(classes, threshold)


def _edges_by_bits(classes: DataFrame, threshold: Fraction) -> DataFrame:
    spark, num, den = classes.sparkSession, threshold.numerator, threshold.denominator
    rows, width = B.with_bits(classes.filter(F.col("class").isNotNull()).select(F.col("class").alias("sha"), "signature"))
    nodes = B.ranked_nodes(rows)
    step, stretch = B.height(width), max(B.ROWS, min(SENT, (1 << 25) // max(width, 1)))

    def against(first: int) -> DataFrame:
        """Pairs of a class from this rank on with an earlier one of the stretch that begins here."""
        sent = nodes.filter((F.col("rank") >= first) & (F.col("rank") < first + stretch)).orderBy("rank").toArrow()
        held = spark.sparkContext.broadcast((sent["node"].to_pylist(), sent["size"].to_numpy(), B.matrix(sent["bits"])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            others, sizes, packed = np.array(held.value[0], object), *held.value[1:]
            for whole in batches:
                ranked = whole.take(np.argsort(whole.column(0).to_numpy()))
                for begin in range(0, ranked.num_rows, step):
                    b = ranked.slice(begin, step)
                    rank, size, matrix = b.column(0).to_numpy(), b.column(2).to_numpy(), B.unpacked(B.matrix(b.column(4)), width)
                    names = np.array(b.column(1).to_pylist(), object)
                    for at in range(0, len(sizes), step):
                        # Sizes fall with the rank: rows before the block are met elsewhere, those far smaller are not alike.
                        low, high = np.searchsorted(rank, first + at, "right"), np.searchsorted(-size * den, -int(sizes[at : at + step].min()) * num, "right")
                        if low >= high:
                            continue
                        i, j, shared = B.alike(matrix[low:high], size[low:high], B.unpacked(packed[at : at + step], width), sizes[at : at + step], num / den)
                        i, j = i + low, j + at
                        united = size[i].astype(np.int64) + sizes[j] - shared
                        true = (rank[i] > first + j) & (shared * den >= united * num)
                        mine, theirs, shared, united = names[i[true]], others[j[true]], shared[true], united[true]
                        less = mine < theirs
                        out = [np.where(less, mine, theirs), np.where(less, theirs, mine)]
                        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in out), pa.array(shared), pa.array(united)], ["a", "b", "shared", "united"])

        return nodes.filter(F.col("rank") > first).mapInArrow(run, "a string, b string, shared bigint, united bigint")

    return reduce(DataFrame.unionByName, [against(k) for k in range(0, max(nodes.count(), 1), stretch)])


def _edges_by_lists(classes: DataFrame, threshold: Fraction) -> DataFrame:
    num, den = threshold.numerator, threshold.denominator
    words = classes.select("class", F.size("signature").alias("n"), F.explode("signature").alias("word"))
    held = words.groupBy("word").agg(F.count("*").alias("held"))
    place = F.row_number().over(Window.partitionBy("class").orderBy("held", "word"))
    ordered = words.join(held, "word").withColumn("place", place)
    kept = ordered.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * num / F.lit(den) - F.lit(1e-9)) + 1)
    lists = cut(kept.select("word", "class", "n", "place"))
    a, b = lists.alias("a"), lists.alias("b")
    needed = F.ceil((F.col("a.n") + F.col("b.n")) * num / F.lit(num + den) - F.lit(1e-9))
    ahead = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")) + 1
    fits = (F.col("a.word") == F.col("b.word")) & (F.col("a.class") < F.col("b.class")) & (F.least(F.col("a.n"), F.col("b.n")) * den >= F.greatest(F.col("a.n"), F.col("b.n")) * num)
    # At the first word both have, all that they share lies ahead; at later words of a pair less may, so any one is enough.
    pairs = a.join(b, fits).groupBy(F.col("a.class").alias("a"), F.col("b.class").alias("b")).agg(F.max(ahead - needed).alias("room")).filter("room >= 0").select("a", "b")
    left = pairs.join(classes.select(F.col("class").alias("a"), F.col("signature").alias("sa")), "a")
    both = left.join(classes.select(F.col("class").alias("b"), F.col("signature").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    united = (F.size("sa") + F.size("sb")).cast("bigint") - F.col("shared")
    return both.withColumn("shared", shared).withColumn("united", united).filter(F.col("shared") * den >= F.col("united") * num).select("a", "b", "shared", "united")


def as_fraction(threshold: float) -> Fraction:
    """The threshold as it is written in decimals."""
    digits = max(0, -math.floor(math.log10(abs(threshold) or 1))) + 6
    return Fraction(round(threshold * 10**digits), 10**digits)
