"""Read-side operators over a windowed metric table.

Input columns: window_start, window_end, <key> (default ``event_type``), cnt, total,
avg_value.  Every function returns a DataFrame; nothing is collected.  The one
exception is the pivot value discovery in :func:`pivot_metric` when no values are
given, which is what ``GroupedData.pivot`` itself does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_root

WINDOW_KEY = ("window_start", "window_end", "event_type")
TABLE_COLUMNS = ("window_start", "window_end", "event_type", "cnt", "total", "avg_value")


def round_metrics(df: DataFrame, total_digits: int = 2, avg_digits: int = 4) -> DataFrame:
    """Round ``total`` and ``avg_value`` as the reader presents them (2 and 4 digits)."""
    return (df.withColumn("total", F.round("total", total_digits))
              .withColumn("avg_value", F.round("avg_value", avg_digits)))


def dedupe_windows(df: DataFrame, keys: Sequence[str] = WINDOW_KEY) -> DataFrame:
    """One row per window key; the survivor has the largest (cnt, total, avg_value).

    A rerun or a replayed sink file can repeat a window.  The survivor is defined by
    a total order, so the result does not depend on file or partition order.  It is
    an aggregate of ``max(struct(...))`` with a partial step before the shuffle, so
    repeats of a hot key are combined map-side (Spark runs it sort-based, as struct
    buffers are not hash-aggregatable); no window function, no per-key sort of all rows.
    """
    metrics = [c for c in ("cnt", "total", "avg_value") if c not in keys]
    best = (df.groupBy(*keys)
              .agg(F.max(F.struct(*[F.col(c) for c in metrics])).alias("_best")))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in metrics])


def recent(df: DataFrame, hours: int, time_col: str = "window_end", materialise: bool = False) -> DataFrame:
    """Rows within ``hours`` of the data's own latest ``time_col`` (inclusive).

    The cut-off is a scalar subquery (one small aggregate job); empty input gives
    empty output because the maximum is null.  The input is evaluated twice (for
    the cut-off and for the rows): with ``materialise`` it is checkpointed once
    first, which pays off when it is an aggregate over much larger data.
    """
    if materialise:
        scratch_root(df.sparkSession)
        df = df.checkpoint(eager=True)
    latest = df.select(F.max(time_col)).scalar()
    return df.where(F.col(time_col) >= latest - F.make_dt_interval(hours=F.lit(hours)))


def kpis(df: DataFrame, key_col: str = "event_type") -> DataFrame:
    """One row: number of windows, distinct keys, window-weighted event count, last end.

    ``events_weighted`` sums ``cnt`` over overlapping hopping windows, so each event
    is counted once per window that contains it (size/slide times).
    """
    return df.agg(
        F.count(F.lit(1)).alias("windows"),
        F.countDistinct(key_col).alias("event_types"),
        F.sum("cnt").alias("events_weighted"),
        F.max("window_end").alias("last_window_end"),
    )


def pivot_metric(df: DataFrame, metric: str, how: str, values: Sequence[str] | None = None,
                 index: str = "window_end", key_col: str = "event_type") -> DataFrame:
    """Wide table: one row per ``index``, one column per key value, ``how`` of ``metric``.

    With ``values`` given, each column is a conditional aggregate
    (``sum(cnt) FILTER (WHERE event_type = v)``): one hash aggregate with a
    map-side combine, one shuffle on ``index``, and a fixed schema.  Without them
    Spark's ``pivot`` first runs a distinct job to discover the columns.  Missing
    combinations are null either way.
    """
    agg = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min}[how]
    if values is None:
        return df.groupBy(index).pivot(key_col).agg(agg(metric)).orderBy(index)
    if not values:  # no key values: the index alone
        return df.select(index).distinct().orderBy(index)
    cells = [agg(F.when(F.col(key_col) == F.lit(v), F.col(metric))).alias(str(v)) for v in values]
    return df.groupBy(index).agg(*cells).orderBy(index)


def totals(df: DataFrame, key_col: str = "event_type", digits: int = 2) -> DataFrame:
    """Sum of ``total`` per key, rounded, largest first (window-weighted, see kpis)."""
    return (df.groupBy(key_col)
              .agg(F.round(F.sum("total"), digits).alias("total_sum"))
              .orderBy(F.col("total_sum").desc(), F.col(key_col)))


def latest(df: DataFrame, n: int = 100, key_col: str = "event_type") -> DataFrame:
    """The ``n`` most recent windows in a fixed column order.

    Ties on ``window_end`` are broken by key and start, so the row set is
    deterministic; Spark plans this as a TakeOrderedAndProject (per-task top-n).
    """
    columns = [key_col if c == "event_type" else c for c in TABLE_COLUMNS]
    return (df.select(*columns)
              .orderBy(F.col("window_end").desc(), F.col(key_col), F.col("window_start").desc())
              .limit(n))
