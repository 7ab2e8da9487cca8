"""Writers with rerun-safe semantics.

``land_raw``        raw layer: one JSON item per line, the day's folder replaced.
``land_documents``  raw layer: one document per file.
``write_partition`` one leaf folder (e.g. ``dt=D``) replaced as a whole.
``write_keys``      many keys in one job: dynamic partition overwrite, plus removal
                    of requested keys that now have no rows (dynamic overwrite alone
                    leaves their old files in place).
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice
from operator import and_

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import passing_shuffles, ship_package
from strata.sinks.layout import partition_path

#: Files of a folder of landed documents (fixed value).
FOLDER_FILES = 1024
#: Compression level of landed documents (fixed value; the fastest).
GZIP_LEVEL = 1


def land_raw(df: DataFrame, path: str, value_col: str = "value") -> None:
    """Write a text column as lines into ``path``, replacing what a previous run wrote.

    Landing one item per line (not one document per file) keeps the raw layer
    splittable: a later read is parallel within a file.
    """
    df.select(value_col).write.mode("overwrite").text(path)


def land_documents(df: DataFrame, path: str, value_col: str = "value", together: int = 0,
                   compress: bool = False) -> list[str]:
    """Write each value of a text column as a file of its own below ``path``; returns the folders to read.

    For documents that must stay whole files.  Tasks write through ``pyarrow.fs``, into folders of
    at most FOLDER_FILES files: a file costs its bytes, not a folder, a listing and the commands by which Hadoop's
    local file system sets the rights of a file and of its checksum.  A folder belongs to one
    task attempt and is returned only if that attempt succeeded, so what a failed or repeated attempt
    left behind is never read.  The driver holds the folders' names.

    With ``together`` the values are elements (one or more, comma-separated) of JSON arrays, and a document is
    the array of that many successive values of a task, gathered as they pass: no shuffle carries the texts.
    Null and empty values hold no element and are passed over.
    With ``compress`` files are gzip, which Spark's readers tell by the name.  The shuffles that ``df``
    needed leave the disk once the files are there.
    """
    spark = df.sparkSession
    ship_package(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_store(path)
        attempt, folder = uuid.uuid4().hex, ""
        values = (value for batch in batches for value in batch.column(0).to_pylist())
        for n, value in enumerate(_arrays(values, together) if together else values):
            if n % FOLDER_FILES == 0:
                folder = f"{attempt}-{n // FOLDER_FILES}"
                store.create_dir(f"{root}/{folder}", recursive=True)
                yield pa.RecordBatch.from_arrays([pa.array([folder])], ["folder"])
            text = f"{value or ''}\n".encode()
            with store.open_output_stream(f"{root}/{folder}/{n % FOLDER_FILES:04d}{'.gz' if compress else ''}", compression=None) as out:
                out.write(gzip.compress(text, GZIP_LEVEL, mtime=0) if compress else text)

    with passing_shuffles(spark):
        folders = [f"{path}/{r.folder}" for r in df.select(F.col(value_col).cast("string")).mapInArrow(write, "folder string").collect()]
    if not folders:  # no document: an empty folder, which reads as no rows
        land_raw(df.limit(0), path, value_col)
    return folders or [path]


def _arrays(values: Iterator[str], together: int) -> Iterator[str]:
    """JSON arrays of ``together`` successive values each."""
    values = filter(None, values)
    while held := list(islice(values, together)):
        yield "[" + ",\n".join(held) + "]"


def _open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named as Spark names it (``file:/x``, ``s3a://b/x``, ``hdfs://…``)."""
    if uri.startswith("s3a://"):
        uri = "s3://" + uri.removeprefix("s3a://")
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def write_partition(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace one leaf folder with ``df`` (an empty ``df`` clears it)."""
    df.write.mode("overwrite").format(fmt).save(path)


def delete_paths(spark: SparkSession, paths: Sequence[str], empty_like: DataFrame | None = None,
                 fmt: str = "parquet") -> None:
    """Remove folders through the Hadoop file system Spark itself writes with.

    Uses the session's Hadoop configuration, so object-store credentials and
    endpoints are the ones of ``spark.hadoop.*``.  Sessions without a JVM gateway
    (Spark Connect) replace each folder with an empty dataset shaped like
    ``empty_like`` instead, which reads as no rows.
    """
    if not paths:
        return
    if getattr(spark, "_jsc", None) is None:
        if empty_like is None:
            raise RuntimeError("cannot clear partitions: no JVM gateway and no empty_like frame")
        for p in paths:
            empty_like.limit(0).write.mode("overwrite").format(fmt).save(p)
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        if fs.exists(jp):
            fs.delete(jp, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the file system Spark itself uses."""
    if getattr(spark, "_jsc", None) is None:  # Spark Connect: ask the reader
        from pyspark.errors import AnalysisException

        try:
            spark.read.text(path).schema  # noqa: B018
            return True
        except AnalysisException:
            return False
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jp)


def write_keys(df: DataFrame, base: str, keys: Sequence[str], requested: DataFrame | None = None,
               fmt: str = "parquet") -> None:
    """Write ``df`` partitioned by ``keys`` under ``base``; rerun-safe per key.

    * Keys present in ``df`` are replaced (dynamic partition overwrite); other
      existing keys are left alone.
    * ``requested`` (a DataFrame of key tuples — the job's work grid) lists keys
      this run is responsible for: those without rows now are removed, so a rerun
      that finds no data replaces old data with nothing.
    * With ``requested``, ``df`` is evaluated twice (its key columns alone, then in
      full): pass a scan or a staged table, not a costly or side-effecting plan.
    * Rows are rebalanced on the keys before writing (AQE splits a hot key over
      several tasks and packs small ones together), giving few files per key
      without pinning a hot key to one task.
    """
    (df.hint("rebalance", *keys)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys)
       .format(fmt)
       .save(base))
    if requested is not None:  # null keys are keys; what is cleared goes only after the write has succeeded
        asked, present = requested.select(*keys).distinct().alias("asked"), df.select(*keys).distinct().alias("present")
        same = reduce(and_, [F.col(f"asked.{k}").eqNullSafe(F.col(f"present.{k}")) for k in keys])
        for r in asked.join(present, same, "left_anti").toLocalIterator():
            delete_paths(df.sparkSession, [partition_path(base, r.asDict())], empty_like=df.drop(*keys), fmt=fmt)
