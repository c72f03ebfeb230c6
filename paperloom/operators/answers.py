"""Answers of outside readers: roll call, checks against what was shown, rounds settled, verdicts."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import folded, folded_hard, normalise
from paperloom.options import AnswerOptions


class AnswerProvider(Protocol):
    """Whoever reads: tasks in, answers out; the ids of the tasks come back unchanged."""

    def __call__(self, tasks: DataFrame) -> DataFrame: ...


class PhraseReader:
    """A reader by rule, the same each time: the template of the longest phrase that a task's text contains.

    phrases: phrase, documenttemplateid.  Tasks: readingid, text.  A text without any phrase is answered with neither
    template nor quote; equally long phrases by their text.  Confidence is 1 where one template fits, else 0.5.
    """

    def __init__(self, phrases: DataFrame):
        self.phrases = phrases.filter(F.col("phrase").isNotNull() & F.col("documenttemplateid").isNotNull()).select(folded(F.col("phrase")).alias("phrase"), "documenttemplateid").filter("phrase <> ''").distinct()

    def __call__(self, tasks: DataFrame) -> DataFrame:
        told = tasks.select("readingid", folded(F.coalesce("text", F.lit(""))).alias("_told"))
        # The list of phrases is one short row, so no pair of task and phrase is ever a row.
        listed = self.phrases.agg(F.array_sort(F.collect_list(F.struct((-F.length("phrase")).alias("n"), "phrase", F.col("documenttemplateid").alias("id")))).alias("_all"))
        fits = told.withColumn("_k", F.lit(0)).join(F.broadcast(listed.withColumn("_k", F.lit(0))), "_k").withColumn("_fit", F.filter("_all", lambda x: F.contains("_told", x["phrase"])))
        best = F.get("_fit", F.lit(0))
        one = F.size(F.array_distinct(F.transform("_fit", lambda x: x["id"]))) == 1
        return fits.select("readingid", F.lit(True).alias("received"), best["id"].alias("documenttemplateid"), best["phrase"].alias("quote"), F.when(best.isNotNull(), F.when(one, 1.0).otherwise(0.5)).alias("confidence"))


def confidence_of(text: Column) -> Column:
    """The number clamped to 0 and 1; null where it is none (NaN included)."""
    n = text.try_cast("double")
    return F.when(n.isNotNull() & ~F.isnan(n), F.greatest(F.lit(0.0), F.least(F.lit(1.0), n)))


def first_answers(tasks: DataFrame, answers: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of each task its first answer in the order; answers to other tasks are dropped, tasks without one keep nulls."""
    k = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    first = answers.join(tasks.select(key), key, "left_semi").withColumn("_k", k).filter("_k = 1").drop("_k")
    return tasks.join(first, key, "left")


def roll_call(tasks: DataFrame, answers: DataFrame, key: str, batch: str) -> DataFrame:
    """Per batch: tasks sent, answered, missing; tasks: key and batch."""
    got = answers.select(key).distinct().withColumn("_got", F.lit(True))
    return tasks.join(got, key, "left").groupBy(batch).agg(F.count("*").alias("sent"), F.count("_got").alias("answered"), F.count_if(F.col("_got").isNull()).alias("missing"))


def quote_fault(shown: Column, quote: Column, options: AnswerOptions = AnswerOptions()) -> Column:
    """Why a quote does not hold up: none, too short, or not in the text; null if it holds.  No text, nothing to check."""
    q = folded(F.coalesce(quote, F.lit("")))
    return (
        F.when(F.coalesce(shown, F.lit("")) == "", F.lit(None).cast("string")).when(q == "", "no quote")
        .when(F.length(q) < options.least_quote, "quote too short").when(~F.contains(folded(shown), q), "quote not in the text")
    )


def answer_fault(received: Column, shown: Column, quote: Column, options: AnswerOptions = AnswerOptions()) -> Column:
    """Why an answer does not hold up; a missing word about receipt is no fault."""
    return F.when(received.eqNullSafe(F.lit(False)), "not received").otherwise(quote_fault(shown, quote, options))


def form_answer_fault(received: Column, template: Column, proposal: Column, offered: Column, shown: Column, quote: Column, options: AnswerOptions = AnswerOptions()) -> Column:
    """Why a form's answer is refused; here a quote must always be found."""
    q = folded(F.coalesce(quote, F.lit("")))
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    return (
        F.when(received.eqNullSafe(F.lit(False)), "not received").when(blank(template) & blank(proposal), "neither template nor proposal")
        .when(~blank(template) & ~F.coalesce(F.array_contains(offered, template), F.lit(False)), "template not offered")
        .when(F.length(q) < options.least_quote, "quote too short").when(~F.coalesce(F.contains(folded(shown), q), F.lit(False)), "quote not in the samples")
    )


def settle(answers: DataFrame) -> DataFrame:
    """One verdict for each reading over its rounds.

    answers: readingid, round, template, proposal, fault.  Answers that do not hold up are dropped first; the first of
    the rest counts, every later one either agrees or contests it.  Without a template the case-blind proposal is
    compared.  Without any that holds up the first fault is the reason.  ``agreed``: at least two, all alike.
    """
    same = F.when(F.coalesce("template", F.lit("")) != "", F.concat(F.lit("t:"), "template")).otherwise(F.concat(F.lit("p:"), folded_hard(F.coalesce("proposal", F.lit("")))))
    good = F.col("fault").isNull()
    return (
        answers.withColumn("_same", same).groupBy("readingid")
        .agg(
            F.min_by(F.struct("template", "proposal", "round"), F.when(good, F.col("round"))).alias("first"), F.count_if(good).alias("held_up"),
            F.count_distinct(F.when(good, F.col("_same"))).alias("different"), F.min_by("fault", F.when(~good, F.col("round"))).alias("first_fault"), F.count("*").alias("answers"),
        )
        .select(
            "readingid", "first.template", "first.proposal", "answers", "held_up", ((F.col("held_up") > 1) & (F.col("different") == 1)).alias("agreed"), (F.col("different") > 1).alias("contested"),
            F.when(F.col("held_up") == 0, F.col("first_fault")).alias("fault"),
        )
    )


def verdict(unread: Column, fault: Column, template: Column, known: Column, allowed: Column, proposal: Column) -> Column:
    """What comes of an answer, the first that applies."""
    has = F.coalesce(template, F.lit("")) != ""
    return (
        F.when(unread, "unread").when(fault.isNotNull(), "unverified").when(has & ~known, "unknown template").when(has & ~allowed, "template not allowed")
        .when(has, "pick").when(F.trim(F.coalesce(proposal, F.lit(""))) != "", "proposal").otherwise("nothing")
    )


def thin_margin(template: Column, agreed: Column, confidence: Column, options: AnswerOptions = AnswerOptions()) -> Column:
    """Whether a template was chosen with too little confidence and no second round agreed."""
    return (F.coalesce(template, F.lit("")) != "") & ~F.coalesce(agreed, F.lit(False)) & F.coalesce(confidence < options.floor, F.lit(True))


def confidence_bucket(confidence: Column) -> Column:
    # The buckets of the histogram.
    return F.when(confidence.isNull(), "none").when(confidence >= 0.9, ">=0.9").when(confidence >= 0.7, ">=0.7").when(confidence >= 0.5, ">=0.5").otherwise("<0.5")


def trimmed(text: Column, limit: int, options: AnswerOptions = AnswerOptions()) -> Column:
    """White space collapsed; cut at the limit, back to the last space if that is far enough; stray marks off the end."""
    clean = normalise(text)
    head = F.left(clean, F.lit(limit))
    last = F.length(head) - F.instr(F.reverse(head), " ")
    cut = F.when((F.instr(head, " ") > 0) & (last > limit * options.back_off), F.left(head, last)).otherwise(head)
    return F.when(F.length(clean) <= limit, clean).otherwise(F.regexp_replace(cut, "[ .,;:-]+$", ""))
