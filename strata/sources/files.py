"""File listings as DataFrames (no driver-side loops over keys)."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.layout import NULL_PARTITION

UNFINISHED = ".inprogress"


def list_files(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """Finished data files under ``prefix`` (recursively): path, length, modification time.

    Folders, hidden files (``.``/``_``, which includes commit markers) and files
    whose name contains ``.inprogress`` are left out.  Uses Spark's file index
    (``binaryFile``); only the metadata columns are selected, so file contents are
    never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(prefix)
    except AnalysisException as exc:  # nothing written there yet: an empty listing
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], "path string, length bigint, modified timestamp")
    files = files.select("path", "length", F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return files.where(~name.contains(UNFINISHED))


def path_value(path, key: str):
    """Folder text of ``key=`` in a path (``event_type=click/part-0`` → ``click``).

    Empty when the path has no such folder; null for Spark's null-partition folder.
    The text is as written, i.e. with Spark's %XX escapes of special characters.
    """
    col = F.col(path) if isinstance(path, str) else path
    text = F.regexp_extract(col, rf"(?:^|/){re.escape(key)}=([^/]+)", 1)
    return F.when(text == NULL_PARTITION, F.lit(None)).otherwise(text)
