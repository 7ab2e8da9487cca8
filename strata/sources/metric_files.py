"""Read the windowed-metric files back: tolerant, typed, deduplicated.

Layout: ``<root>/event_type=<t>/part-*.json``, one JSON object per line, without
the ``event_type`` field (it is the partition value).  Rules:

* only files under an ``event_type=`` folder are read; unfinished files
  (``.inprogress`` anywhere in the name, or hidden ``.``/``_`` files) are skipped;
* blank lines are skipped, malformed lines and lines with a malformed number are
  set aside (``_corrupt_record``) and not returned;
* ``event_type`` stays text (``01`` is not the number 1);
* window times are parsed with 0–6 fractional digits; bad text gives null;
* ``total`` / ``avg_value`` are rounded to 2 / 4 digits; repeated windows are
  reduced to one row (largest cnt, total, avg_value).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.metrics import dedupe_windows, round_metrics
from strata.sinks.compaction import read_live
from strata.sources.documents import CORRUPT, ndjson

# Line format of the metric files (fixed values).
RAW_SCHEMA = ("window_start string, window_end string, cnt bigint, total double, "
              "avg_value double, event_type string")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
UNFINISHED = ".inprogress"


def _parse_time(col: str):
    return F.try_to_timestamp(F.col(col), F.lit(TIME_FORMAT)).cast("timestamp_ntz")


def metric_lines(spark: SparkSession, root: str, sink_log: bool = False, by_day: bool = False,
                 since: date | None = None, compacted: bool = False) -> DataFrame:
    """Every finished line under ``root`` with its parse status (``_corrupt_record``).

    ``sink_log=True`` reads ``root`` itself, so for the output folder of a Spark
    file sink the commit log ``_spark_metadata`` decides which files exist.
    ``by_day`` reads the ``dt=<day>/event_type=<t>/`` layout; with ``since`` only the
    folders of that day and later are listed and read (partition pruning).  Files that
    vanish between listing and reading are skipped, except under ``sink_log``: a file
    the log has committed must be there, and its loss fails the read.  ``compacted``
    reads through the manifest of :mod:`strata.sinks.compaction`, the log included.
    """
    root = root.rstrip("/")
    if compacted:
        return live_lines(spark, root, by_day, since)
    levels = "dt=*/event_type=*" if by_day else "event_type=*"
    path = root if sink_log else f"{root}/{levels}"
    schema = RAW_SCHEMA + (", dt date" if by_day else "")
    lines = ndjson(spark, path, schema, base_path=None if sink_log else root,
                   ignore_missing=not sink_log)
    if since is not None:
        if not by_day:
            raise ValueError("since needs the by_day layout")
        lines = lines.where(F.col("dt") >= F.lit(since))
    file_name = F.element_at(F.split(F.col("_file"), "/"), -1)
    return lines.where(~file_name.contains(UNFINISHED))


def live_lines(spark: SparkSession, root: str, by_day: bool = False, since: date | None = None) -> DataFrame:
    """The lines of :func:`metric_lines` as the sink's compaction manifest says which files hold them."""
    columns = ", ".join(c for c in RAW_SCHEMA.split(", ") if not c.startswith("event_type"))
    lines = read_live(spark, root, f"{columns}, {CORRUPT} string", "dt date, event_type string" if by_day else "event_type string",
                      "json", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines if since is None else lines.where(F.col("dt") >= F.lit(since))


def load_metrics(spark: SparkSession, root: str, dedupe: bool = True, sink_log: bool = False, by_day: bool = False,
                 since: date | None = None, compacted: bool = False) -> DataFrame:
    """Clean metric table: window_start, window_end, event_type, cnt, total, avg_value."""
    lines = metric_lines(spark, root, sink_log, by_day, since, compacted)
    # The tautology on window_end keeps a data column in the scan, so the lines are
    # parsed even when only a count is asked: Spark rejects JSON scans that would
    # need the corrupt-record column alone.
    parsed = F.col("window_end").isNull() | F.col("window_end").isNotNull()
    good = lines.where(F.col(CORRUPT).isNull() & parsed)
    typed = good.select(_parse_time("window_start").alias("window_start"),
                        _parse_time("window_end").alias("window_end"),
                        "event_type", "cnt", "total", "avg_value")
    out = round_metrics(typed)
    return dedupe_windows(out) if dedupe else out


def line_quality(spark: SparkSession, root: str, sink_log: bool = False, by_day: bool = False) -> DataFrame:
    """One row: lines read, lines set aside as malformed, lines with a count."""
    lines = metric_lines(spark, root, sink_log, by_day)
    return lines.agg(F.count(F.lit(1)).alias("lines"),
                     F.count(CORRUPT).alias("malformed"),
                     F.count("cnt").alias("with_cnt"))
