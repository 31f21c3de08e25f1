"""Intermediate data in the folder that the cluster provides for it."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate data; a temporary one only in local mode, in one process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="article-warehouse-")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, so that every use of the result reads the same rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_folder(df.sparkSession))
    return df.checkpoint()
