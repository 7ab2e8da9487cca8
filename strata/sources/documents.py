"""JSON document readers for the raw layer.

``json_docs``   a JSON document per file (object or top-level array) or JSON lines,
                read with an explicit schema; a top-level array gives a row per
                element.  Whole-document files are one task each, so large
                collections should be landed one item per line (see sinks.writers).
``whole_text``  each file as one text value (for documents walked as VARIANT).
``parse_docs``  the same parse for documents already held in a text column.
``ndjson``      JSON lines that tolerate blank and malformed lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

CORRUPT = "_corrupt_record"
# JSON text of timestamps with all six fractional digits (Spark's default keeps three).
JSON_TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def _schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def json_docs(spark: SparkSession, path: str | list[str], schema: StructType | str,
              multi_line: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """Read JSON with a declared schema (never inferred: an empty ``[]`` reads as 0 rows).

    ``multi_line=True``: one document per file (an object, or an array giving a row
    per element); ``False``: JSON lines.  ``FAILFAST`` (default) stops the job on a
    malformed document instead of passing a row of nulls on into the lake; use
    :func:`ndjson` to keep bad lines aside instead.
    """
    return (spark.read.schema(_schema(schema)).option("multiLine", multi_line)
                 .option("mode", mode).json(path))


def whole_text(spark: SparkSession, path: str | list[str], with_path: bool = False) -> DataFrame:
    """One row per file with its full content in ``value``."""
    df = spark.read.text(path, wholetext=True)
    if with_path:
        df = df.select("value", F.col("_metadata.file_path").alias("file_path"))
    return df


def parse_docs(df: DataFrame, text_col: str, schema: StructType | str,
               array: bool = False) -> DataFrame:
    """Parse a text column of JSON documents with ``schema``.

    ``array=True`` reads each document as a top-level array of ``schema`` and gives
    one row per element, as the file reader does for array documents.  A malformed
    document stops the job (``FAILFAST``) as it does in :func:`json_docs`.
    """
    s: DataType = _schema(schema)
    strict = {"mode": "FAILFAST"}
    if array:
        return df.select(F.explode(F.from_json(text_col, ArrayType(s), strict)).alias("_doc")).select("_doc.*")
    return df.select(F.from_json(text_col, s, strict).alias("_doc")).select("_doc.*")


def ndjson(spark: SparkSession, path: str, schema: StructType | str,
           path_filter: str | None = None, base_path: str | None = None,
           ignore_missing: bool = False) -> DataFrame:
    """JSON lines with blank lines skipped and malformed lines kept aside.

    The result has the schema's columns plus ``_corrupt_record`` (null on good
    lines) and ``_file`` (the source file), so callers can drop and count bad lines
    instead of losing them silently.  ``path_filter`` is a glob on file names;
    ``base_path`` keeps partition columns when ``path`` is a glob below it.
    A query must use a data column besides ``_corrupt_record`` (Spark rejects scans
    of raw JSON that need the corrupt-record column alone).  ``ignore_missing``
    skips files that a live writer renamed between listing and reading.
    """
    s = StructType(list(_schema(schema).fields)).add(CORRUPT, "string")  # never alter the caller's schema
    reader = spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if path_filter:
        reader = reader.option("pathGlobFilter", path_filter)
    if base_path:
        reader = reader.option("basePath", base_path)
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    return reader.json(path).withColumn("_file", F.col("_metadata.file_path"))
