"""The last hours of a table by file statistics: which files can hold them, known without opening the rest.

``file_ranges``   smallest and largest time of every parquet file, from its footer, read in tasks.
``recent_rows``   the rows of the last hours of a parquet folder: the cut-off is the footers'
                  largest time, and only files that reach it are opened.
``recent_metrics``  the same over metric files, which are JSON and have no footers: the day
                  folders tell where the latest windows are, and only folders that reach the cut-off are opened.

All three find the cut-off from the data's own latest time, as :func:`strata.operators.metrics.recent` does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.metrics import recent
from strata.session import ship_package
from strata.sinks.layout import NULL_PARTITION
from strata.sources.files import list_files, path_value
from strata.sources.metric_files import load_metrics
from strata.sources.paged import _filesystem

#: File systems whose files pyarrow opens in tasks (others are asked through Spark's reader).
FOOTER_SCHEMES = ("", "file", "s3", "s3a", "hdfs", "gs", "abfs", "abfss")
#: Up to so many files are not worth a job over their footers: the column's maximum is asked directly,
#: and the pushed-down filter skips row groups by the same statistics.
FEW_FILES = 8
RANGE_SCHEMA = "path string, length bigint, n_rows bigint, low timestamp_ntz, high timestamp_ntz, known boolean"


def file_ranges(spark: SparkSession, path: str, time_col: str) -> DataFrame:
    """(path, length, n_rows, low, high, known) per parquet file under ``path``.

    ``known`` is false where a footer has no statistics of ``time_col`` for some row group
    that has values; such a file may hold any time.  Footers are read in tasks, a few kilobytes each.
    On file systems that only Spark's readers open, the column is scanned for its range instead.
    """
    if urlsplit(path).scheme not in FOOTER_SCHEMES:
        t = F.col(time_col).cast("timestamp_ntz")
        files = spark.read.parquet(path).select(t.alias("t"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
        return files.groupBy("path", "length").agg(F.count(F.lit(1)).alias("n_rows"), F.min("t").alias("low"), F.max("t").alias("high")) \
                    .withColumn("known", F.lit(True))
    ship_package(spark)

    def footers(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        from strata.sources import file_stats

        for batch in batches:
            out = []
            for file, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                filesystem, name = _filesystem(file)
                with filesystem.open_input_file(name) as f:
                    out.append((file, length, *file_stats.footer_range(pq.ParquetFile(f).metadata, time_col)))
            types = [pa.string(), pa.int64(), pa.int64(), pa.timestamp("us"), pa.timestamp("us"), pa.bool_()]
            names = [c.split()[0] for c in RANGE_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)] if out
                                             else [pa.array([], type=t) for t in types], names)

    files = list_files(spark, path).select("path", "length")
    parquet = files.where(F.col("path").rlike(r"\.parquet$"))
    return parquet.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(footers, RANGE_SCHEMA)


def footer_range(meta, time_col: str) -> tuple[int, datetime | None, datetime | None, bool]:
    """(rows, smallest, largest time, whether the statistics cover every value) of a parquet footer."""
    names = [meta.schema.column(i).path for i in range(meta.num_columns)]
    if time_col not in names:
        return meta.num_rows, None, None, False
    at, lows, highs, known = names.index(time_col), [], [], True
    for g in range(meta.num_row_groups):
        chunk = meta.row_group(g).column(at)
        stats = chunk.statistics
        if stats is not None and stats.has_min_max:
            lows.append(_plain(stats.min))
            highs.append(_plain(stats.max))
        elif not (stats is not None and stats.has_null_count and stats.null_count == chunk.num_values):
            known = False
    return meta.num_rows, min(lows, default=None), max(highs, default=None), known


def _plain(t) -> datetime:
    if isinstance(t, datetime):
        return t.replace(tzinfo=None)  # footers of instants are in UTC
    raise TypeError(f"not a time: {t!r}")


def recent_rows(spark: SparkSession, path: str, time_col: str, hours: float, before: timedelta = timedelta(0)) -> tuple[DataFrame, datetime | None]:
    """The rows of the last ``hours`` before the data's latest ``time_col``, and that latest time.

    ``before`` widens the read by so much (for windows that begin earlier).  Files whose
    largest time lies before the cut-off are never opened; inside the others the time filter
    is pushed down to row groups.  Files without statistics are asked for their maximum
    and always read.  The footers' summary is one row; of the files, the driver gets those to read.
    """
    whole = spark.read.parquet(path)
    if len(whole.inputFiles()) <= FEW_FILES:
        t = F.col(time_col)
        if whole.schema[time_col].dataType.typeName() not in ("timestamp", "timestamp_ntz"):
            raise TypeError(f"not a time: {time_col}")
        latest = whole.agg(F.max(t).cast("timestamp_ntz")).first()[0]
        if latest is None:
            return whole.where(F.lit(False)), None
        return whole.where(t >= F.lit(latest - timedelta(hours=hours) - before).cast(whole.schema[time_col].dataType)), latest
    ranges = file_ranges(spark, path, time_col).cache()
    try:
        schema = whole.schema
        latest = ranges.agg(F.max("high")).first()[0]
        blind = [r[0] for r in ranges.where(~F.col("known")).select("path").toLocalIterator()]
        if blind:
            seen = spark.read.schema(schema).parquet(*blind).agg(F.max(F.col(time_col).cast("timestamp_ntz"))).first()[0]
            latest = max((t for t in (latest, seen) if t is not None), default=None)
        if latest is None:
            return spark.createDataFrame([], schema), None
        cut = latest - timedelta(hours=hours) - before
        files = [r[0] for r in ranges.where(~F.col("known") | (F.col("high") >= F.lit(cut))).select("path").toLocalIterator()]
    finally:
        ranges.unpersist()
    rows = spark.read.schema(schema).parquet(*files)
    return rows.where(F.col(time_col) >= F.lit(cut).cast(schema[time_col].dataType)), latest


def metric_days(spark: SparkSession, root: str) -> list[date]:
    """Days of the ``dt=`` folders of a by-day metric sink, latest first (a folder listing; one value per day)."""
    days = list_files(spark, root).select(path_value("path", "dt").alias("dt")).distinct().where(F.col("dt") != "")
    return sorted((date.fromisoformat(r[0]) for r in days.collect() if r[0] != NULL_PARTITION and re.fullmatch(r"\d{4}-\d\d-\d\d", r[0])), reverse=True)


def recent_metrics(spark: SparkSession, root: str, hours: float, size: timedelta = timedelta(minutes=1),
                   sink_log: bool = False, compacted: bool = False) -> DataFrame:
    """The metrics of the last ``hours`` before the latest ``window_end`` in a by-day sink.

    A window that starts on day D ends before D + 1 + ``size``, so the latest end is in the newest
    folder that holds a window, and no folder older than the cut-off's day less ``size`` holds a wanted one.
    """
    read = dict(sink_log=sink_log, by_day=True, compacted=compacted)
    for day in metric_days(spark, root):  # the newest folder, unless its lines are all broken
        try:
            latest = load_metrics(spark, root, since=day, **read).agg(F.max("window_end")).first()[0]
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            latest = None
        if latest is not None:
            since = (latest - timedelta(hours=hours) - size).date()
            return recent(load_metrics(spark, root, since=since, **read), hours)
    return load_metrics(spark, root, since=date(9999, 12, 31), **read) if metric_days(spark, root) else spark.createDataFrame(
        [], "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, cnt bigint, total double, avg_value double")
