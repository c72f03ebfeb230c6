"""Checks across answers, names against the closed list, and the account that every file ends up somewhere."""

from __future__ import annotations

import difflib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import folded, folded_hard
from paperloom.options import AnswerOptions
from paperloom.sources.tables import cut

#: Rows of a list of names up to which it is broadcast; longer lists are joined.
BROADCAST_NAMES = 100_000
#: Names, or identifiers, that one task compares a value with at a time.
NAME_BLOCK = 2_000


def one_at_a_time(answers: DataFrame) -> DataFrame:
    """The answers given for single readings: not by form, with a reading and a name; the first path of each reading.

    ``called``: the template's name, else the proposal.
    """
    called = F.coalesce(F.nullif(F.trim("documenttemplate"), F.lit("")), F.concat(F.lit("proposed: "), F.nullif(F.trim("proposedtemplate"), F.lit(""))))
    some = answers.filter(F.col("viaform").isNull() & F.col("readingid").isNotNull()).withColumn("called", called).filter(F.col("called").isNotNull())
    first = F.min_by(F.struct("called", "quote", "evidence", "sha"), F.struct("path", "resultid"))
    return some.groupBy("readingid").agg(first.alias("f")).select("readingid", "f.called", "f.quote", "f.evidence", "f.sha")


def quote_collisions(answers: DataFrame, options: AnswerOptions = AnswerOptions()) -> DataFrame:
    """Quotes that stand under several names: names, answers.  answers: readingid, called, quote."""
    q = answers.withColumn("quote", folded(F.coalesce("quote", F.lit("")))).filter(F.length("quote") >= options.least_quote)
    each = q.groupBy("quote", "called").agg(F.count("*").alias("n"))
    # A list of the names under one quote, of which there are at most as many as templates and proposals.
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("called", "n"))), lambda x: F.concat(x["called"], F.lit("="), x["n"])), "|")
    return each.groupBy("quote").agg(F.count("*").alias("names"), F.sum("n").alias("answers"), names.alias("templates")).filter("names > 1")


def evidence_reuse(answers: DataFrame, options: AnswerOptions = AnswerOptions()) -> DataFrame:
    """Evidence given in the same words for documents of several forms.  answers: evidence, form."""
    e = answers.withColumn("evidence", folded(F.coalesce("evidence", F.lit("")))).filter(F.length("evidence") >= options.least_quote)
    return e.groupBy("evidence").agg(F.count_distinct("form").alias("forms"), F.count("*").alias("answers")).filter("forms > 1")


def phrases(types: DataFrame) -> DataFrame:
    """Spellings of the types that are long enough to be looked for, also without what stands in brackets."""
    bare = F.trim(F.regexp_replace(F.regexp_replace("phrase", r"\([^)]*\)", " "), " +", " "))
    both = types.filter(F.col("phrase").isNotNull()).select(F.explode(F.array(F.trim("phrase"), bare)).alias("phrase"))
    # More than 8 characters, at most 60.
    return both.select(folded(F.col("phrase")).alias("phrase")).filter((F.length("phrase") > 8) & (F.length("phrase") <= 60)).distinct()


def _grams(c: Column, n: int) -> Column:
    """The distinct runs of n characters of a text; none in shorter ones."""
    last = F.length(c) - (n - 1)
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda k: F.substring(c, k, F.lit(n)))))


def named_but_not_picked(answers: DataFrame, types: DataFrame) -> DataFrame:
    """(phrase, answers): phrases found in quote or evidence of answers that were called something else.

    A phrase is looked for anywhere in the text, inside words too.  Text and phrase meet on one run of six characters
    of the phrase, the one that the fewest phrases have, and the whole phrase is looked for only then; phrases are at
    least nine characters long.  answers: readingid, called, quote, evidence.
    """
    text = folded(F.concat_ws(" ", "quote", "evidence"))
    told = answers.select("readingid", folded(F.col("called")).alias("called"), text.alias("told"))
    grams = phrases(types).select("phrase", F.explode(_grams(F.col("phrase"), 6)).alias("gram"))
    held = grams.groupBy("gram").agg(F.count("*").alias("n"))
    keyed = cut(grams.join(held, "gram").groupBy("phrase").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram")))
    met = told.withColumn("gram", F.explode(_grams(F.col("told"), 6))).join(F.broadcast(keyed) if keyed.count() <= BROADCAST_NAMES else keyed, "gram")
    met = met.filter(F.contains("told", F.col("phrase")) & ~F.contains(F.coalesce("called", F.lit("")), F.col("phrase")))
    return met.select("readingid", "phrase").distinct().groupBy("phrase").agg(F.count("*").alias("answers"))


# Words that tell no kind of document from another.
COMMON_WORDS = frozenset({
    "document", "documents", "form", "forms", "sheet", "sheets", "statement", "statements", "certificate", "certificates", "information", "product", "products", "raw", "material", "materials",
    "report", "reports", "the", "of", "and", "for", "a", "an",
})


def name_similarity(left: str, right: str, common: frozenset[str]) -> float:
    """Share of matching blocks in two names of words (twice the matched characters by all characters).

    Names that have a word outside ``common`` together, or share over 0.9, count in full; all others 0.4 at most.
    """
    # Nearly equal from over 0.9, at most 0.4 without a telling word.
    nearly, held_down = 0.9, 0.4
    ratio = difflib.SequenceMatcher(None, left, right).ratio()
    telling = set(left.split()).intersection(right.split()).difference(common)
    return ratio if telling or ratio > nearly else min(held_down, ratio)


def _letters(texts: list[str], index: dict[str, int]) -> np.ndarray:
    """How often each character of the index occurs in each text; characters it lacks are left out."""
    out = np.zeros((len(texts), len(index)), np.int32)
    for row, text in enumerate(texts):
        for c in text:
            k = index.get(c)
            if k is not None:
                out[row, k] += 1
    return out


def _best(value: str, names: list[str], counts: np.ndarray, index: dict[str, int], score: Callable[[str, str], float], most: int, least: float) -> list[tuple[float, str]]:
    """The ``most`` best names over ``least`` by score, ties by name, without scoring those that cannot be among them.

    Matched characters are never more than those both have, so names are scored by falling bound until none is left
    that could still come in.  ``names`` ascend, so of those with one bound the later can only lose ties.
    """
    size = counts.sum(axis=1)
    mine = _letters([value], index)[0]
    # Characters the index lacks are in no name, so they count for the length only.
    bound = 2.0 * np.minimum(counts, mine).sum(axis=1) / np.maximum(size + len(value), 1)
    best: list[tuple[float, str]] = []
    for k in np.argsort(-bound, kind="stable").tolist():
        if bound[k] < least - 1e-12 or (len(best) == most and (-bound[k], names[k]) > best[-1]):
            break
        got = score(value, names[k])
        if got >= least:
            best = sorted([*best, (-got, names[k])])[:most]
    return [(-s, n) for s, n in best]


def nearest_names(titles: DataFrame, names: DataFrame, options: AnswerOptions = AnswerOptions(), common: frozenset[str] = COMMON_WORDS) -> DataFrame:
    """(title, name, score, place): the most similar names of the closed list, for each distinct title.

    titles: title, words; names: name, words; each once.  Every name counts, since the third best may be a poor one;
    titles meet the list in blocks of ``NAME_BLOCK`` names, and the best of each block are ranked.  In a block names are
    compared in full only while their letters allow them to be among the best.
    """
    blocks = -(-names.count() // NAME_BLOCK)
    spread = names.groupBy(F.pmod(F.xxhash64("name"), F.lit(max(blocks, 1))).alias("_block")).agg(F.sort_array(F.collect_list(F.struct("name", "words"))).alias("_names"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for _, group in pdf.groupby("_block", sort=False):
                listed = [(r["name"], r["words"]) for r in group["_names"].iloc[0]]
                index = {c: k for k, c in enumerate(sorted({c for _, w in listed for c in w}))}
                counts = _letters([w for _, w in listed], index)
                # Names may share their words, so the places stand for them in the order of the names.
                width = len(str(len(listed)))
                keys = [f"{k:0{width}d}" for k in range(len(listed))]
                for title, words in zip(group["title"], group["words"]):
                    score = lambda v, key: name_similarity(v, listed[int(key)][1], common)  # noqa: B023, E731
                    out += [(title, listed[int(key)][0], s) for s, key in _best(words, keys, counts, index, score, options.nearest, 0.0)]
            yield pd.DataFrame(out, columns=["title", "name", "score"])

    pairs = titles.select("title", "words").join(F.broadcast(spread) if blocks * NAME_BLOCK <= BROADCAST_NAMES else spread)
    best = pairs.mapInPandas(run, "title string, name string, score double")
    k = F.row_number().over(Window.partitionBy("title").orderBy(F.desc("score"), "name"))
    return best.withColumn("place", k).filter(F.col("place") <= options.nearest)


def _without(c: Column, places: Column) -> Column:
    """All that is left of the text when just so many (0, 1 or 2) of its more characters are taken out."""
    n = F.length(c)
    part = lambda start, stop: F.substring(c, start, F.greatest(stop - start, F.lit(0)))
    once = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(part(F.lit(1), i), part(i + 1, n + 1)))
    twice = lambda i: F.transform(F.sequence(i + 1, n), lambda j: F.concat(part(F.lit(1), i), part(i + 1, j), part(j + 1, n + 1)))
    return F.when(places == 0, F.array(c)).when(places == 1, F.array_distinct(once)).otherwise(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), n - 1), twice))))


def _ratio_to(value: str) -> Callable[[str, str], float]:
    """The ratio of names to one value, which is taken apart once."""
    matcher = difflib.SequenceMatcher(None, "", value)

    def ratio(_: str, name: str) -> float:
        matcher.set_seq1(name)
        return matcher.ratio()

    return ratio


def near_misses(values: DataFrame, index: DataFrame, options: AnswerOptions = AnswerOptions(), longest: int = 40) -> DataFrame:
    """(itemtable, identifier, near, ratio, place): unmatched identifiers and the most similar ones of their table.

    Identifiers of one table look alike (``RM-00000123``), so parts of them select nothing.  Two that differ by few
    characters are equal once these are taken out of both: they meet in a join on what is left with one character out,
    then with two out.  The lengths that a table's identifiers have tell how many characters of a pair must match for
    the least ratio, so no more are taken out than that, and how near one that was not met can be: an identifier is
    decided once so many have been found that are nearer, or if none not met can have the least ratio.  Those that stay
    undecided, and those over ``longest`` characters, are held against all of their table in blocks, by falling bound of
    the characters both have.  So the result is that of a full comparison, at every length.

    values, index: itemtable, identifier; blank ones are not looked up, repeated ones count once.
    """
    some = lambda df: df.select("itemtable", "identifier").filter((F.col("identifier") != "") & F.col("itemtable").isNotNull()).distinct()
    index, wanted = cut(some(index).withColumnRenamed("identifier", "near")), cut(some(values))
    spark = index.sparkSession
    n, m, least = F.col("_n"), F.col("_m"), F.col("_least")
    found_type = "itemtable string, identifier string, near string, ratio double"
    # A row for each table and two lengths that it has, with the characters that must match at least.
    lengths = wanted.select("itemtable", F.length("identifier").alias("_n")).distinct().join(index.select("itemtable", F.length("near").alias("_m")).distinct(), "itemtable")
    ways = cut(lengths.withColumn("_least", F.ceil(options.near_miss * (n + m) / 2 - 1e-9).cast("int")).filter(least <= F.least(n, m)))

    def rated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for (t, value), group in pdf.groupby(["itemtable", "identifier"], sort=False)["near"]:
                names = sorted(group)
                chars = {c: k for k, c in enumerate(sorted({c for x in names for c in x}))}
                counts = _letters(names, chars)
                out += [(t, value, x, s) for s, x in _best(value, names, counts, chars, _ratio_to(value), options.nearest, options.near_miss)]
            yield pd.DataFrame(out, columns=["itemtable", "identifier", "near", "ratio"])

    def close(some: DataFrame, places: int) -> DataFrame:
        """The best of those that are equal with so many characters out of the longer one."""
        kept = F.greatest(F.greatest(n, m) - places, least)
        steps = ways.filter((n <= longest) & (kept <= F.least(n, m)))
        if places > 1:
            # Otherwise all that count were met with fewer out.
            steps = steps.filter(least <= F.greatest(n, m) - places)

        def parts(df: DataFrame, value: str, size: str) -> DataFrame:
            out = F.broadcast(steps.select("itemtable", F.col(size).alias("_size"), (F.col(size) - kept).alias("_out")).distinct())
            left = df.withColumn("_size", F.length(value)).join(out, ["itemtable", "_size"]).select("itemtable", value, F.explode(_without(F.col(value), F.col("_out"))).alias("_left"))
            # Planned sizes do not count what explode adds, so a broadcast of this is ruled out; a number stands for the text.
            return left.select("itemtable", value, F.xxhash64("_left").alias("_left")).hint("merge")

        pairs = parts(some, "identifier", "_n").join(parts(index, "near", "_m"), ["itemtable", "_left"]).select("itemtable", "identifier", "near")
        pairs = pairs.repartition("itemtable", "identifier").distinct().sortWithinPartitions("itemtable", "identifier")
        return cut(pairs.mapInPandas(rated, found_type))

    def undecided(some: DataFrame, found: DataFrame, places: int) -> DataFrame:
        """Those of which too few are found that nothing not met with so many characters out could come before."""
        match = F.least(n, m, F.greatest(n, m) - places - 1)
        beyond = ways.filter(least <= match).groupBy("itemtable", "_n").agg(F.max(2 * match / (n + m)).alias("_beyond"))
        open_ = lambda df: df.withColumn("_n", F.length("identifier")).join(F.broadcast(beyond), ["itemtable", "_n"])
        sure = open_(found).filter(F.col("ratio") > F.col("_beyond") + 1e-9).groupBy("itemtable", "identifier").count().filter(F.col("count") >= options.nearest)
        return open_(some).join(sure, ["itemtable", "identifier"], "left_anti").select("itemtable", "identifier")

    long = F.length("identifier") > longest
    short = wanted.filter(~long)
    once = close(short, 1)
    rest = cut(undecided(short, once, 1))
    twice = close(rest, 2)
    last = cut(undecided(rest, twice, 2).unionByName(wanted.filter(long)))

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for t, wanted_, listed in zip(pdf["itemtable"], pdf["_wanted"], pdf["_names"]):
                names = list(listed)
                chars = {c: k for k, c in enumerate(sorted({c for x in names for c in x}))}
                counts = _letters(names, chars)
                for value in wanted_:
                    out += [(t, value, x, s) for s, x in _best(value, names, counts, chars, _ratio_to(value), options.nearest, options.near_miss)]
            yield pd.DataFrame(out, columns=["itemtable", "identifier", "near", "ratio"])

    # Both sides in blocks of one length each, so most blocks are out of each other's reach and none is sent for one value.
    def blocked(df: DataFrame, value: str, size: str, block: int, out: str) -> DataFrame:
        sized = df.select("itemtable", value, F.length(value).alias(size))
        most = sized.groupBy("itemtable", size).count().agg(F.max("count")).first()[0] or 1
        return sized.groupBy("itemtable", size, F.pmod(F.xxhash64(value), F.lit(-(-most // block))).alias("_block")).agg(F.sort_array(F.collect_list(value)).alias(out)).drop("_block")

    found = once.unionByName(twice)
    if not last.isEmpty():
        names = blocked(index.join(F.broadcast(last.select("itemtable").distinct()), "itemtable", "left_semi"), "near", "_m", NAME_BLOCK, "_names")
        reach = 2 * F.least(n, m) >= options.near_miss * (n + m) - 1e-9
        full = blocked(last, "identifier", "_n", NAME_BLOCK // 20, "_wanted").join(names, "itemtable").filter(reach).select("itemtable", "_wanted", "_names")
        full = full.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        found = found.unionByName(full.mapInPandas(compared, found_type))
    k = F.row_number().over(Window.partitionBy("itemtable", "identifier").orderBy(F.desc("ratio"), "near"))
    return found.distinct().withColumn("place", k).filter(F.col("place") <= options.nearest)


def proposed_names(answers: DataFrame) -> DataFrame:
    """Proposals by their case- and punctuation-blind form: how many, and the first spelling."""
    p = answers.filter(F.trim(F.coalesce("proposedtemplate", F.lit(""))) != "").withColumn("k", folded_hard(F.col("proposedtemplate")))
    return p.groupBy("k").agg(F.count("*").alias("documents"), F.min("proposedtemplate").alias("spelling")).select("spelling", "documents")


def conservation(everything: DataFrame, outcomes: list[tuple[str, DataFrame]]) -> DataFrame:
    """(path, outcomes): paths that are not in exactly one outcome, or in one but not in the tree.

    everything and each outcome: path.
    """
    parts = None
    for name, df in outcomes:
        one = df.select("path", F.lit(name).alias("outcome"))
        parts = one if parts is None else parts.unionByName(one)
    counted = parts.groupBy("path").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("outcome")), "|").alias("outcomes"))
    both = everything.select("path").distinct().withColumn("_there", F.lit(True)).join(counted, "path", "full_outer")
    return both.filter(F.col("_there").isNull() | F.col("n").isNull() | (F.col("n") != 1)).select("path", F.coalesce("outcomes", F.lit("")).alias("outcomes"), F.coalesce("n", F.lit(0)).alias("n"))

