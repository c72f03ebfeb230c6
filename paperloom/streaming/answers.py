"""Answers that arrive as files over time, kept as they come and merged when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fields of an answer.
ANSWER = "readingId string, round int, received boolean, documentTemplateId string, proposedTemplate string, confidence string, quote string, evidence string"


def answer_stream(spark: SparkSession, folder: str, files_at_once: int = 1000) -> DataFrame:
    """A stream of the answers in a folder of JSON lines; answers have no event time, so there is no watermark."""
    return spark.readStream.schema(ANSWER).option("maxFilesPerTrigger", files_at_once).json(folder)


def merge(arrived: DataFrame) -> DataFrame:
    """The first answer of each reading and round, by batch; answers of one batch by their text.

    arrived: the fields of an answer and ``batch``.  Answers without a reading or a round are kept as one each.
    """
    k = F.row_number().over(Window.partitionBy("readingId", "round").orderBy("batch", "quote", "evidence", "documentTemplateId", "proposedTemplate"))
    return arrived.withColumn("_k", k).filter("_k = 1").drop("_k", "batch")


def collect_stream(spark: SparkSession, folder: str, target: str, checkpoint: str):
    """Starts to add new answers to parquet at ``target``, a folder for each batch.

    A batch is written once, whatever is there already, and a batch that is repeated after a failure replaces itself.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates().write.mode("overwrite").parquet(f"{target}/batch={number}")

    return answer_stream(spark, folder).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def answers_so_far(spark: SparkSession, target: str) -> DataFrame:
    """The answers that count of all that have arrived."""
    return merge(spark.read.schema(f"{ANSWER}, batch bigint").parquet(target))
