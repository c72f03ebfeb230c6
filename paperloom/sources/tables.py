"""Reading the tables of one data folder, and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; only where it is unset in local mode an own one.

    On a cluster a folder of one machine would be of no use to the others, so without the setting this fails.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="paperloom-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The frame, materialised once in the shared folder: survives lost executors and ends the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
