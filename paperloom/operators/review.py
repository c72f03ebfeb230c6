"""Looking at forms by eye: which members are shown, and what the marks lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import normalise
from paperloom.operators.forms import chance
from paperloom.options import ReviewOptions
from paperloom.sources.tables import cut

# What a reviewer can say of a form's grouping and of its name; anything else counts as the first.
GROUPINGS, NAMINGS = ("ok", "mixed", "split"), ("ok", "wrong")


def fill_ratio(text: Column) -> Column:
    """Digits by characters, as numerator over denominator; 0 for an empty text."""
    n = F.length(text)
    return F.when(n > 0, F.regexp_count(text, F.lit(r"\p{Nd}")).cast("double") / n).otherwise(F.lit(0.0))


def first_lines(text: Column, most: int = 14) -> Column:
    """The first lines of a text that are not blank; none for null."""
    return F.slice(F.filter(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), lambda line: normalise(line) != ""), 1, most)


def shown_members(members: DataFrame, options: ReviewOptions = ReviewOptions(), seed: int = 0) -> DataFrame:
    """(form, sha, block): a random block, then the least fitting of the rest, then both ends by fill of the rest.

    members: form, sha, fit, filled; each once.  Ties by sha.  The ends never overlap: of three left two are shown, of
    one that one.  Each block is chosen among the first few of its order, as many more as can have been shown before,
    so Spark keeps only those of a form in a task and never a whole form.
    """

    def first(df: DataFrame, order: list[Column], most: int) -> DataFrame:
        k = F.row_number().over(Window.partitionBy("form").orderBy(*order))
        return df.withColumn("_k", k).filter(F.col("_k") <= most)

    keys = ["form", "sha"]
    random = cut(first(members, [chance(seed), F.col("sha")], options.random).select(*keys, F.lit("random").alias("block")))
    low = first(members, [F.col("fit"), F.col("sha")], options.random + options.suspect).drop("_k").join(random.select(*keys), keys, "left_anti")
    suspect = first(low, [F.col("fit"), F.col("sha")], options.suspect).select(*keys, F.lit("suspect").alias("block"))
    taken = cut(random.unionByName(suspect))
    sizes = members.groupBy("form").agg(F.count("*").alias("_n")).join(taken.groupBy("form").agg(F.count("*").alias("_t")), "form").select("form", (F.col("_n") - F.col("_t")).alias("_rest"))
    side = max(1, options.filled // 2)
    half = F.least(F.lit(side), F.floor(F.col("_rest") / 2))
    ends = []
    for order in ([F.col("filled"), F.col("sha")], [F.desc("filled"), F.desc("sha")]):
        near = first(members, order, options.random + options.suspect + side).drop("_k").join(taken.select(*keys), keys, "left_anti")
        # Of a single one left the lower end shows it.
        most = F.when((F.col("_rest") == 1) & F.lit(not ends), F.lit(min(1, options.filled))).otherwise(half if options.filled else F.lit(0))
        ends.append(first(near, order, side).join(sizes, "form").filter(F.col("_k") <= most).select(*keys, F.lit("filled").alias("block")))
    return taken.unionByName(ends[0]).unionByName(ends[1])


def sanitised(value: Column, known: tuple[str, ...]) -> Column:
    """What a reviewer said, if it is one of the known words; the first of them otherwise, also for null."""
    return F.when(value.isin(*known), value).otherwise(known[0])


def review_results(shown: DataFrame, answers: DataFrame) -> DataFrame:
    """One row for each form shown: grouping, naming, splitsinto, random_shown, random_marked, marked, strays, answered.

    shown: form, sha, block; answers: form, grouping, naming, splitsinto, marked array<string> of shas.  Of several
    answers to one form the first by its text counts, so the order of rows does not matter; answers to forms that were
    not shown are dropped; a mark given twice counts once; marks of members not shown are strays.
    """
    fields = ["grouping", "naming", "splitsinto", "marked"]
    one = answers.groupBy("form").agg(F.min_by(F.struct(*fields), F.to_json(F.struct(*fields))).alias("a"))
    marks = one.select("form", F.explode("a.marked").alias("sha")).filter(F.col("sha").isNotNull()).distinct()
    rates = failure_rates(shown, marks.join(shown.select("form").distinct(), "form", "left_semi"))
    held = shown.select("form", "sha").distinct().join(marks, ["form", "sha"]).groupBy("form").agg(F.count("*").alias("marked"))
    said = rates.join(held, "form", "left").join(one, "form", "left")
    split = F.nullif(normalise(F.col("a.splitsinto")), F.lit(""))
    return said.select(
        "form", sanitised(F.col("a.grouping"), GROUPINGS).alias("grouping"), sanitised(F.col("a.naming"), NAMINGS).alias("naming"), split.alias("splitsinto"),
        "random_shown", "random_marked", F.coalesce("marked", F.lit(0)).alias("marked"), "strays", F.col("a").isNotNull().alias("answered"),
    )


def review_block(results: DataFrame) -> DataFrame:
    """(form, line, json): a sentence for each form that is not simply right, and its machine-readable row.

    results: as of ``review_results``.  The JSON rows of all forms make up the fenced block that is read back.
    """
    bad = (F.col("grouping") != "ok") | (F.col("naming") != "ok") | (F.col("marked") > 0)
    line = F.concat(
        F.col("form").cast("string"), F.lit(": grouping "), "grouping", F.lit(", naming "), "naming", F.lit(", marked "), F.col("random_marked").cast("string"), F.lit("/"), F.col("random_shown").cast("string"),
        F.coalesce(F.concat(F.lit(", by "), "splitsinto"), F.lit("")),
    )
    row = F.to_json(F.struct(F.col("form").alias("formId"), "grouping", "naming", F.col("random_shown").alias("randomShown"), F.col("random_marked").alias("randomMarked"), F.col("splitsinto").alias("splitsInto")))
    return results.select("form", F.when(bad, line).alias("line"), row.alias("json"))


def failure_rates(shown: DataFrame, marks: DataFrame) -> DataFrame:
    """Per form: random members shown, of those marked; strays are marks of members not shown.  marks: form, sha."""
    m = marks.select("form", "sha").distinct().withColumn("_m", F.lit(True))
    both = shown.join(m, ["form", "sha"], "full_outer")
    random = F.coalesce(F.col("block") == "random", F.lit(False))
    return both.groupBy("form").agg(F.count_if(random).alias("random_shown"), F.count_if(random & F.col("_m").isNotNull()).alias("random_marked"), F.count_if(F.col("block").isNull()).alias("strays"))


def separating_wording(members: DataFrame, words: DataFrame, options: ReviewOptions = ReviewOptions(), most: int = 3) -> DataFrame:
    """(form, word, direction, marked, held): words that tell marked members from held ones, the best three.

    members: form, sha, marked boolean; words: sha, word.
    """
    sizes = members.groupBy("form").agg(F.count_if("marked").alias("m"), F.count_if(~F.col("marked")).alias("h"))
    have = members.join(words, "sha").groupBy("form", "word").agg(F.count_if("marked").alias("wm"), F.count_if(~F.col("marked")).alias("wh"))
    both = have.join(sizes, "form").filter("m > 0 AND h > 0").withColumn("a", F.col("wm") / F.col("m")).withColumn("b", F.col("wh") / F.col("h"))
    direction = F.when((F.col("a") >= options.present) & (F.col("b") <= options.absent), "marked").when((F.col("b") >= options.present) & (F.col("a") <= options.absent), "held")
    told = both.withColumn("direction", direction).filter(F.col("direction").isNotNull())
    k = F.row_number().over(Window.partitionBy("form").orderBy(F.abs(F.col("a") - F.col("b")).desc(), F.desc("word")))
    return told.withColumn("_k", k).filter(F.col("_k") <= most).select("form", "word", "direction", F.col("wm").alias("marked"), F.col("wh").alias("held"))


def outcome(grouping: Column, marked: Column, shown: Column, splits_into: Column, wording: Column, threshold: Column, options: ReviewOptions = ReviewOptions()) -> Column:
    """Where a reviewed form goes: by value; marked ones alone; by wording; by a stricter threshold; dissolved."""
    failing = (grouping == "mixed") | F.coalesce(marked / F.nullif(shown, F.lit(0)) >= options.fail, F.lit(False))
    return (
        F.when(F.coalesce(splits_into, F.lit("")) != "", "split by value").when(~failing & (marked > 0), "marked read alone").when(~failing, "kept")
        .when(wording, "split by wording").when(threshold.isNotNull(), "split by threshold").otherwise("dissolved")
    )
