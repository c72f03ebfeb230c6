"""Near-duplicate sets: bottom-k sketches, inverted lists of the retained values, estimates, exact verification.

Every element gets one 64-bit hash.  Elements are ordered by (how common, hash): common means to be in the table of the
most frequent elements, which is bounded in size whatever the input; all others come first, by hash alone.  A set's
sketch is its bottom k in that order, with k = n - ceil(t n) + 1 for a set of n elements and threshold t: two sets at or
over t then share at least one retained value, so the inverted lists miss no pair.

The length of the sketch so follows from the set's size (it is the prefix of prefix filtering); a fixed k would miss
pairs of large sets.

Inverted lists of ``LONG_LIST`` and more postings are refined, whatever their share of the input: two sets that first
meet in such a value must meet in a second one of the first k + 1 too, so such a value is listed together with each of
the values that follow it there.  The long values are broadcast while they are few and joined to their sets beyond
that.  Lists are joined in partitions by value; nothing is capped.

In the join each pair is held against two bounds that lose no pair: what can still be shared beyond the place in both
orders, and the 256-bit parity bitmap of each whole set, whose differing bits never exceed the differing elements.
What is left is estimated from the union of the two sketches' plain bottom values and then verified by exact Jaccard.
The estimate has an allowance of five standard deviations, so of the pairs that lie just at the threshold it may lose
one in about three million, and far fewer above it.

Elements are compared as 64-bit hashes, sets as two more hashes of those and their size.  Equal sets are collapsed to a
class first; only class representatives are compared.  Null elements, null sets and sets below the least size are left
out; repeated elements count once; rows repeated under one key are one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.skew import lookup
from paperloom.sources.tables import cut

#: An element is common from this share of all elements; so the table of common ones has at most 1 / COMMON rows.
COMMON = 1 / 200_000
#: Postings of one value that are joined directly; longer lists are refined by a second value.
LONG_LIST = 4_000
#: Rows of a kept table up to which it is broadcast.
BROADCAST_ROWS = 300_000
#: Plain bottom values for the estimate.
BOTTOM = 32
#: Rows of a class that are paired in one group; larger classes are paired in several.
CLASS_BLOCK = 2_000


def word_set(text):
    """Distinct lower-cased runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def classes(sets: DataFrame, least: int) -> DataFrame:
    """(origin, key, hashes, same): each set of enough elements, its sorted hashes, and what equal sets have in common.

    sets: origin, key bigint, elements array<string> without repeats and nulls.
    """
    hashed = sets.filter(F.size("elements") >= least).select(
        "origin", "key", F.array_sort(F.transform("elements", lambda e: F.xxhash64(e))).alias("hashes")
    )
    return hashed.withColumn("same", F.struct(F.xxhash64("hashes"), F.xxhash64(F.reverse("hashes")), F.size("hashes")))


def _rank(values: np.ndarray, common: np.ndarray, places: np.ndarray) -> np.ndarray:
    """0 for the others, from 1 on for common elements, the more frequent the higher."""
    if not len(common):
        return np.zeros(len(values), np.int32)
    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
    return np.where(common[at] == values, places[at], 0).astype(np.int32)


def _postings(common_var, long_var, threshold: Fraction):
    """Batches of (origin, key, hashes[, long]) to postings; long: those of the hashes whose lists are long."""
    num, den = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, places = common_var.value
        long_lists = long_var.value if long_var is not None else None
        for whole in batches:
            for cut_at in range(0, whole.num_rows, 2000):
                batch = whole.slice(cut_at, 2000)
                lists = batch.column(2)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                row = np.repeat(np.arange(len(size)), size)
                rank = _rank(values, common, places)
                order = np.lexsort((values, rank, row))
                v = values[order]
                begin = np.cumsum(size) - size
                place = np.arange(len(v)) - begin[row]
                k = size - (-(-size * num // den)) + 1
                # Parity bitmap of the whole set.
                bit = (v.view(np.uint64) >> np.uint64(7)) & np.uint64(255)
                odd = (np.bincount(row * 256 + bit.astype(np.int64), minlength=256 * len(size)) & 1).astype(np.uint8)
                words = np.packbits(odd.reshape(len(size), 256), axis=1, bitorder="little").view(np.int64)
                inside = place < k[row]
                p = np.flatnonzero(inside)
                own = batch.column(3) if batch.num_columns > 3 else None
                if long_lists is None and (own is None or own.null_count == len(own)):
                    out_v, out_r, out_p = v[p], row[p], place[p]
                else:
                    if own is None:
                        hot = np.isin(v, long_lists)
                    else:
                        # Long values by set: value and row together.
                        long_row = np.repeat(np.arange(len(size)), np.diff(own.fill_null([]).offsets.to_numpy()))
                        long_value = own.fill_null([]).flatten().to_numpy(zero_copy_only=False)
                        at = np.lexsort((long_value, long_row))
                        pair = np.rec.fromarrays([row, v], names="r,v")
                        hot = np.isin(pair, np.rec.fromarrays([long_row[at], long_value[at]], names="r,v"))
                    direct = p[~hot[p]]
                    first, second = [], []
                    for a in p[hot[p]].tolist():
                        end = int(begin[row[a]] + min(k[row[a]] + 1, size[row[a]]))
                        first.append(np.full(max(end - a - 1, 0), a))
                        second.append(np.arange(a + 1, end))
                    if first:
                        a, b = np.concatenate(first), np.concatenate(second)
                        mixed = (v[a].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ v[b].view(np.uint64)).view(np.int64)
                        out_v, out_r, out_p = np.concatenate([v[direct], mixed]), np.concatenate([row[direct], row[a]]), np.concatenate([place[direct], place[a]])
                    else:
                        out_v, out_r, out_p = v[direct], row[direct], place[direct]
                take = pa.array(out_r)
                columns = [pa.array(out_v), batch.column(0).take(take), batch.column(1).take(take), pa.array(size[out_r].astype(np.int32)), pa.array(out_p.astype(np.int32))]
                columns += [pa.array(np.ascontiguousarray(words[out_r, j])) for j in range(4)]
                yield pa.RecordBatch.from_arrays(columns, ["value", "origin", "key", "n", "place", "b0", "b1", "b2", "b3"])

    return run


POSTING = "value bigint, origin string, key bigint, n int, place int, b0 bigint, b1 bigint, b2 bigint, b3 bigint"


def candidates(sets: DataFrame, threshold: Fraction) -> DataFrame:
    """(origin, a, b) with a < b: every pair of sets that the bounds do not rule out; sets: origin, key, hashes."""
    spark = sets.sparkSession
    counts = cut(sets.select(F.explode("hashes").alias("value")).groupBy("value").count().filter("count > 1"))
    elements = sets.agg(F.sum(F.size("hashes"))).first()[0] or 0
    rows = counts.filter(F.col("count") >= max(2, int(elements * COMMON) + 1)).toArrow()
    value, count = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(value)
    places = np.empty(len(value), np.int32)
    places[np.lexsort((value, count))] = np.arange(1, len(value) + 1)
    common = spark.sparkContext.broadcast((value[order], places[order]))
    long_values = counts.filter(F.col("count") >= LONG_LIST).select("value")
    long_count = long_values.count()
    bare = sets.select("origin", "key", "hashes")
    if long_count <= BROADCAST_ROWS:
        held = spark.sparkContext.broadcast(np.sort(long_values.toArrow().column(0).to_numpy())) if long_count else None
        lists = bare.mapInArrow(_postings(common, held, threshold), POSTING)
    else:
        # Which of its values are long is told each set by a join; at most so many as are in its sketch.
        told = bare.mapInArrow(_postings(common, None, threshold), POSTING).select("origin", "key", "value").join(long_values, "value")
        told = told.groupBy("origin", "key").agg(F.collect_set("value").alias("long"))
        lists = bare.join(told, ["origin", "key"], "left").select("origin", "key", "hashes", "long").mapInArrow(_postings(common, None, threshold), POSTING)
    a, b = lists.alias("a"), lists.alias("b")
    n, d = threshold.numerator, threshold.denominator
    both = F.col("a.n") + F.col("b.n")
    # Shared elements needed: ceil(t / (1 + t) (n + m)); elements that may differ: the rest.
    needed = F.ceil(both * F.lit(n) / F.lit(n + d) - F.lit(1e-9))
    differing = sum((F.bit_count(F.col(f"a.b{j}").bitwiseXOR(F.col(f"b.b{j}"))) for j in range(4)), F.lit(0))
    fits = (
        (F.col("a.origin") == F.col("b.origin")) & (F.col("a.key") < F.col("b.key"))
        & (F.col("a.n") - F.col("a.place") >= needed) & (F.col("b.n") - F.col("b.place") >= needed)
        & (differing <= both - 2 * needed)
    )
    pairs = a.join(b, (F.col("a.value") == F.col("b.value")) & fits).select("a.origin", F.col("a.key").alias("a"), F.col("b.key").alias("b"))
    return pairs.distinct()


def _by_size(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join with a kept side: broadcast if it has few rows, an ordinary join otherwise."""
    return df.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, how)


def similar(sets: DataFrame, threshold: Fraction) -> DataFrame:
    """(origin, a, b, shared, united), a < b: the pairs of sets whose exact Jaccard is the threshold or more."""
    pairs = cut(candidates(sets, threshold))
    hashes = sets.select("origin", "key", "hashes")
    left = _by_size(hashes.withColumnsRenamed({"key": "a", "hashes": "ha"}), pairs, ["origin", "a"], "inner")
    wanted = cut(pairs.select("origin", "b").distinct())
    right = _by_size(hashes.withColumnsRenamed({"key": "b", "hashes": "hb"}), wanted, ["origin", "b"], "left_semi")
    full = left.join(right, ["origin", "b"])
    # Union-sketch estimate: of the lowest values of the union, how many both have.  Hashes are sorted, so the lowest
    # of each come first.
    low_a, low_b = F.slice("ha", 1, BOTTOM), F.slice("hb", 1, BOTTOM)
    low = F.slice(F.array_sort(F.array_union(low_a, low_b)), 1, BOTTOM)
    in_both = F.size(F.array_intersect(F.array_intersect(low, low_a), low_b))
    t = float(threshold)
    least = F.size(low) * F.lit(t) - 5 * F.sqrt(F.size(low) * F.lit(t * (1 - t)))
    shared = F.size(F.array_intersect("ha", "hb"))
    checked = full.filter(in_both >= least).withColumn("shared", shared).withColumn("united", F.size("ha") + F.size("hb") - F.col("shared"))
    return checked.filter(F.col("shared") * F.lit(threshold.denominator) >= F.col("united") * F.lit(threshold.numerator)).select("origin", "a", "b", "shared", "united")


def near_duplicates(sets: DataFrame, least: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """(members: origin, key, class; links between class representatives: origin, a, b, shared, united).

    least: elements a set needs; times the threshold it must be over 1, so that two similar sets share two elements.
    """
    if least * threshold <= 1:
        raise ValueError("sets this small can be similar by one element")
    # Texts are split and hashed once; everything after reads the kept hashes.
    hashed = cut(classes(sets, least))
    bare = hashed.select("origin", "key", "same")
    several = bare.groupBy("origin", "same").agg(F.min("key").alias("class"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    members = cut(lookup(bare, several, ["origin", "same"], hashed.count()).select("origin", "key", F.coalesce("class", "key").alias("class")).distinct())
    copies = members.filter("key <> class").select("origin", "key")
    one = _by_size(hashed, copies, ["origin", "key"], "left_anti")
    return members, cut(similar(one, threshold))


def all_pairs(members: DataFrame, links: DataFrame, block: int = CLASS_BLOCK) -> DataFrame:
    """(origin, firstkey, secondkey): every similar pair of rows, copies of one text included.

    A class is cut into blocks of about ``block`` rows, and its rows meet one block in a group, so a class with a third
    of all rows is spread over as many tasks as it has blocks.  Links of classes meet the members likewise.
    """
    many = members.groupBy("origin", "class").agg(F.count("*").alias("_n")).filter("_n > 1")
    sized = _by_size(members, many.select("origin", "class", F.ceil(F.col("_n") / block).cast("int").alias("_blocks")), ["origin", "class"], "inner")
    b = sized.withColumn("_block", F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int")).select("origin", "class", "_block", F.col("key").alias("y"))
    a = sized.select("origin", "class", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"), F.col("key").alias("x"))
    same = a.join(b, ["origin", "class", "_block"]).filter("x < y").select("origin", F.col("x").alias("firstkey"), F.col("y").alias("secondkey"))
    across = _by_size(members.withColumnsRenamed({"class": "a", "key": "x"}), links.select("origin", "a", "b"), ["origin", "a"], "inner")
    across = across.join(members.withColumnsRenamed({"class": "b", "key": "y"}), ["origin", "b"])
    return same.unionByName(across.select("origin", F.least("x", "y").alias("firstkey"), F.greatest("x", "y").alias("secondkey")))


def components(links: DataFrame) -> DataFrame:
    """(origin, key, group): for each linked class the smallest class that links reach, by contraction.

    A round hooks each label to the smallest label beside it, follows the hooks to their roots, whose number of joins is
    the logarithm of the longest chain of hooks, and keeps the links between different roots.  Of two rounds each label
    is hooked or hooked to in at least one, so the rounds are about the logarithm of the largest group.  It ends when no
    link is left, never before.
    """
    both = links.select("origin", F.col("a").alias("x"), F.col("b").alias("y"))
    edges = cut(both.unionByName(both.select("origin", F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut(edges.select("origin", F.col("x").alias("key"), F.col("x").alias("group")).distinct())
    edges = edges.filter("x <> y")
    while not edges.isEmpty():
        hooks = cut(edges.groupBy("origin", F.col("x").alias("group")).agg(F.min("y").alias("y")).select("origin", "group", F.least("group", "y").alias("root")))
        while True:
            further = hooks.select("origin", F.col("group").alias("root"), F.col("root").alias("further"))
            fresh = cut(hooks.join(further, ["origin", "root"]).select("origin", "group", "root", "further"))
            done = fresh.filter("further <> root").isEmpty()
            hooks = fresh.select("origin", "group", F.col("further").alias("root"))
            if done:
                break
        labels = cut(labels.join(hooks, ["origin", "group"], "left").select("origin", "key", F.coalesce("root", "group").alias("group")))
        for end in ("x", "y"):
            edges = edges.join(hooks.withColumnRenamed("group", end), ["origin", end]).drop(end).withColumnRenamed("root", end)
        edges = cut(edges.filter("x <> y").distinct())
    return labels


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(origin, key, class, links, group): one row for each row compared; links: how many different sets are similar."""
    ends = links.select("origin", F.explode(F.array("a", "b")).alias("class")).groupBy("origin", "class").agg(F.count("*").alias("links"))
    found = components(links).withColumnRenamed("key", "class")
    joined = members.join(ends, ["origin", "class"], "left").join(found, ["origin", "class"], "left")
    return joined.select("origin", "key", "class", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group", "class").alias("group"))
