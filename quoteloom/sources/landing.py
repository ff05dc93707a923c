"""Listing of landing folders by Spark, without opening a file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_feed(spark: SparkSession, path: str | list[str], source: str) -> DataFrame | None:
    """source, path, modified and length of every file below ``path`` (a file, a directory, a glob or several).

    None when there is no such path. Folders are listed by Spark, many at a time; hidden files are left out.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.select(F.lit(source).alias("source"), "path", F.col("modificationTime").alias("modified"), "length")
