"""Readings: one for each content and table; their ids, what to read, and batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.prefix import row_numbers
from paperloom.options import ReadingOptions
from paperloom.sources.tables import cut


def reading_ids(pairs: DataFrame) -> DataFrame:
    """(sha, itemtable, readingid): the first 8 digits of the hash, numbered from the second on where they collide."""
    k = F.row_number().over(Window.partitionBy(F.left("sha", F.lit(8))).orderBy("sha", "itemtable"))
    stem = F.left("sha", F.lit(8))
    return pairs.select("sha", "itemtable").distinct().withColumn("_k", k).select("sha", "itemtable", F.when(F.col("_k") == 1, stem).otherwise(F.concat_ws("-", stem, "_k")).alias("readingid"))


def has_stand_in(options: ReadingOptions = ReadingOptions()) -> Column:
    """Whether the text read from a scan stands in for its pictures."""
    return F.coalesce(F.col("ocrtextfile").isNotNull() & (F.col("ocrchars") >= options.ocr_chars), F.lit(False))


def read_from(options: ReadingOptions = ReadingOptions()) -> Column:
    """What to read of a record, by kind; a scan's text replaces pictures only."""
    pictures = F.when(has_stand_in(options), F.array(F.lit("ocrtextfile"))).otherwise(F.array(F.lit("images")))
    kind = F.col("kind")
    return (
        F.when(kind == "text", F.array(F.lit("textfile"))).when(kind == "sparse-text", F.concat(F.array(F.lit("textfile")), pictures))
        .when(kind == "image-only", pictures).when(kind == "image", F.when(has_stand_in(options), F.array(F.lit("ocrtextfile"))).otherwise(F.array(F.lit("path"))))
    )


def images_of(options: ReadingOptions = ReadingOptions()) -> Column:
    """How many pictures the reading hands over."""
    shown = F.coalesce(read_from(options), F.array().cast("array<string>"))
    return F.when(F.array_contains(shown, "images"), F.coalesce(F.size("images"), F.lit(0))).when(F.array_contains(shown, "path"), 1).otherwise(0)


def readings(attachments: DataFrame) -> DataFrame:
    """One row for each content and table: how many files, the first, how many hints, what the first readable copy offers.

    attachments: sha, itemtable, relativepath, hint, read (null where there is nothing), images.  The files and hints
    themselves are rows of ``reading_files`` and ``reading_hints``: a content may have any number of copies.
    """
    first = F.min_by(F.struct("read", "images", "relativepath"), F.when(F.col("read").isNotNull(), F.col("relativepath")))
    return attachments.groupBy("sha", "itemtable").agg(F.count("*").alias("files"), F.min("relativepath").alias("first_file"), first.alias("first")).select(
        "sha", "itemtable", "files", "first_file", F.col("first.read").alias("read"), F.coalesce("first.images", F.lit(0)).alias("images")
    )


def reading_files(attachments: DataFrame) -> DataFrame:
    """(sha, itemtable, relativepath): the files of each reading."""
    return attachments.select("sha", "itemtable", "relativepath")


def reading_hints(attachments: DataFrame) -> DataFrame:
    """(sha, itemtable, hint): the folder hints of each reading, each once."""
    return attachments.filter(F.col("hint").isNotNull()).select("sha", "itemtable", "hint").distinct()


def again(readings: DataFrame, wanted: DataFrame) -> DataFrame:
    """The readings of a later round: those that a round before could not settle.  Both: readingid."""
    return readings.join(wanted.select("readingid").distinct(), "readingid", "left_semi")


def with_split_rule(readings: DataFrame, members: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``splitsinto``: the sentence that says into what the form of a reading splits; null for all others.

    readings: sha; members: form, sha; rules: form, splitsinto.  A content of several forms takes the first form's.
    """
    of = members.join(rules.filter(F.col("splitsinto").isNotNull()), "form").groupBy("sha").agg(F.min_by("splitsinto", "form").alias("splitsinto"))
    return readings.join(of, "sha", "left")


def _next_start(images: np.ndarray, options: ReadingOptions) -> np.ndarray:
    """For each row the row at which the next batch begins if one begins here; rows past the end count as no limit."""
    n = len(images)
    sums = np.concatenate([[0], np.cumsum(images)])
    at = np.arange(n)
    end = np.minimum(at + options.batch_size, n)
    # The first row before which pictures are carried and with which there would be too many.
    over = np.searchsorted(sums, sums[at] + options.most_images, side="right") - 1
    carried = np.searchsorted(sums, sums[at], side="right")
    return np.minimum(end, np.maximum(over, carried))


def batches(ready: DataFrame, options: ReadingOptions = ReadingOptions(), least_chunk: int = 20_000) -> DataFrame:
    """readingid, itemtable, images and batch: cut in order at so many readings or when the pictures would be too many.

    ready: readingid, itemtable, first_file, images.  The cut is a fold with resets over one global order.  Where the
    batch after next begins depends only on where this one begins, within ``batch_size`` rows; so each chunk of rows is
    told for every way to enter it how it is left, the ways are put together in the driver (chunks x batch_size
    numbers, at most 10,000 chunks), and each chunk is cut from where it is entered.
    """
    size = options.batch_size
    ordered = cut(row_numbers(ready.select("itemtable", "first_file", "readingid", F.col("images").cast("bigint").alias("images")), ["itemtable", "first_file", "readingid"], "_at"))
    rows = ordered.count()
    chunk = max(least_chunk, size, rows // 10_000 + 1)
    own = F.floor(F.col("_at") / chunk).cast("bigint")
    both = F.when(F.col("_at") % chunk < size, F.array(own, own - 1)).otherwise(F.array(own))
    spread = ordered.withColumn("_chunk", F.explode(both)).filter("_chunk >= 0")

    def ways(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        begin = int(pdf["_chunk"].iloc[0]) * chunk
        after = _next_start(pdf["images"].to_numpy(), options)
        n = int((pdf["_at"] < begin + chunk).sum())
        out = []
        for entry in range(min(size, n)):
            at, count = entry, 0
            while at < n:
                at, count = int(after[at]), count + 1
            out.append((int(pdf["_chunk"].iloc[0]), entry, at - n, count))
        return pd.DataFrame(out, columns=["chunk", "entry", "leave", "batches"])

    table = {(r[0], r[1]): (r[2], r[3]) for r in spread.groupBy("_chunk").applyInPandas(ways, "chunk bigint, entry bigint, leave bigint, batches bigint").collect()}
    entry, number, starts = 0, 1, []
    for k in range(-(-rows // chunk)):
        starts.append((k, entry, number))
        # Beyond a chunk of fewer rows than the entry no batch begins; that is only ever the last one.
        entry, more = table.get((k, entry), (0, 0))
        number += more
    begun = ordered.sparkSession.createDataFrame(starts, "_chunk bigint, _entry bigint, _number bigint")

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        after = _next_start(pdf["images"].to_numpy(), options)
        begin = np.zeros(len(pdf), np.int64)
        at = int(pdf["_entry"].iloc[0])
        while at < len(pdf):
            begin[at] = 1
            at = int(after[at])
        pdf["batch"] = int(pdf["_number"].iloc[0]) - 1 + np.cumsum(begin)
        return pdf[["readingid", "itemtable", "images", "batch"]]

    chunked = ordered.withColumn("_chunk", own).join(F.broadcast(begun), "_chunk")
    return chunked.groupBy("_chunk").applyInPandas(assign, "readingid string, itemtable string, images bigint, batch bigint")
