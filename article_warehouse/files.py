"""Folders on any file system that Hadoop can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below ``folder``; none if it does not exist."""
    path, files = _located(spark, folder)
    if not files.exists(path):
        return []
    return [status.getPath().getName() for status in files.listStatus(path) if status.isDirectory()]


def partition_locations(spark: SparkSession, database: str, table: str) -> list[str]:
    """Where the partitions of a table are, one entry each, from the catalog."""
    option = spark._jvm.scala.Option
    name = spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier(table, option.apply(database))
    listed = spark._jsparkSession.sessionState().catalog().listPartitions(name, option.apply(None))
    return [listed.apply(i).location().toString() for i in range(listed.size())]


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _located(spark, folder)
    files.delete(path, True)


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Total size of the files below ``folder``, or of one file."""
    path, files = _located(spark, folder)
    return files.getContentSummary(path).getLength()
