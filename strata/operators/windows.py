"""Hopping-window metrics: count, sum and average of a value per window and key.

Two plans compute the same rows:

``direct``  Spark's ``window(ts, size, slide)``: every row is expanded into the
            size/slide windows that contain it, then a partial aggregate runs before
            the shuffle on (window, key).
``sliced``  rows are first aggregated into panes as wide as the greatest common divisor
            of size and slide (one partial aggregate, no expansion), and only the pane
            rows — at most one per pane and key — are expanded into their windows and
            rolled up.  Every window is a union of whole panes, for any size and slide.
            With many events per pane this moves the ×(size/slide) expansion off the raw rows.

Both work unchanged on ``timestamp`` and ``timestamp_ntz`` columns, on batch
DataFrames and on streams.  The sliced roll-up groups on ``window(window_time(slice))``,
so on a stream the two aggregations chain as stateful operators under one
watermark (append mode emits each window once, after the watermark passes it).
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
          "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}
_TERM = re.compile(rf"(\d+)\s*({'|'.join(_UNITS)})s?\b")


def interval_micros(text: str) -> int:
    """Microseconds in an interval string such as ``"10 seconds"`` or ``"interval 1 minute 30 seconds"``."""
    body = re.sub(r"^\s*interval\b", "", text.lower())
    if not body.strip() or _TERM.sub("", body).strip():
        raise ValueError(f"unsupported interval: {text!r}")
    return sum(int(n) * _UNITS[unit] for n, unit in _TERM.findall(body))


def interval_seconds(text: str) -> int:
    """Whole seconds in an interval string."""
    seconds, rest = divmod(interval_micros(text), 10**6)
    if rest:
        raise ValueError(f"not whole seconds: {text!r}")
    return seconds


def pane_width(size: str, slide: str) -> str:
    """The widest pane of which every window of ``size`` each ``slide`` is a whole number."""
    return f"{gcd(interval_micros(size), interval_micros(slide))} microseconds"


def _metric_columns(value: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("cnt"),
        F.sum(value).alias("total"),
        F.avg(value).alias("avg_value"),
    ]


def hop_metrics(df: DataFrame, time_col: str, key_col: str, value_col: str,
                size: str = "1 minute", slide: str = "10 seconds",
                method: str = "direct") -> DataFrame:
    """Per hopping window and key: ``cnt`` (rows), ``total`` (sum), ``avg_value``.

    Output columns: window_start, window_end, <key_col>, cnt, total, avg_value.
    Rows with a null time belong to no window and are dropped (as ``window`` does).
    """
    if method == "direct":
        return _direct(df, time_col, key_col, value_col, size, slide)
    if method == "sliced":
        return _sliced(df, time_col, key_col, value_col, size, slide)
    raise ValueError(f"unknown method {method!r}")


def look_back(latest: datetime, hours: float, size: str = "1 minute", slide: str = "10 seconds") -> tuple[datetime, datetime]:
    """(least end of a wanted window, least time of an event in one) for the last ``hours`` of hopping windows.

    The latest window starts at the latest event's slide and ends a size later; a window that
    ends at most ``hours`` before that holds no event from before its own start.
    """
    width, step = timedelta(microseconds=interval_micros(size)), interval_micros(slide)
    epoch = datetime(1970, 1, 1)
    start = epoch + timedelta(microseconds=(latest - epoch) // timedelta(microseconds=1) // step * step)
    end = start + width - timedelta(hours=hours)
    return end, end - width


def recent_hop_metrics(df: DataFrame, latest: datetime, time_col: str, key_col: str, value_col: str, hours: float,
                       size: str = "1 minute", slide: str = "10 seconds", method: str = "sliced") -> DataFrame:
    """:func:`hop_metrics` of the windows that end within ``hours`` of the latest one (``latest``: the latest event's time).

    Only events of those windows are aggregated; the bound is a literal, which a scan pushes down.
    """
    end, first = look_back(latest, hours, size, slide)
    needed = df.where(F.col(time_col) >= F.lit(first).cast(df.schema[time_col].dataType))
    out = hop_metrics(needed, time_col, key_col, value_col, size, slide, method)
    return out.where(F.col("window_end") >= F.lit(end).cast(out.schema["window_end"].dataType))


def _direct(df, time_col, key_col, value_col, size, slide):
    agg = (df.groupBy(F.window(time_col, size, slide).alias("_w"), F.col(key_col))
             .agg(*_metric_columns(F.col(value_col))))
    return agg.select(F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"),
                      key_col, "cnt", "total", "avg_value")


def _sliced(df, time_col, key_col, value_col, size, slide):
    value = F.col(value_col)
    panes = (df.groupBy(F.window(time_col, pane_width(size, slide)).alias("_s"), F.col(key_col))
                .agg(F.count(F.lit(1)).alias("_cnt"),
                     F.sum(value).alias("_total"),
                     F.count(value).alias("_n")))
    # window_time(pane) is the pane's last instant: it lies in exactly the windows that
    # contain the whole pane (window bounds are multiples of the pane's width).
    rolled = (panes.groupBy(F.window(F.window_time("_s"), size, slide).alias("_w"), F.col(key_col))
                    .agg(F.sum("_cnt").alias("_cnt"),
                         F.sum("_total").alias("_total"),
                         F.sum("_n").alias("_n")))
    return rolled.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        key_col,
        F.col("_cnt").alias("cnt"),
        F.col("_total").alias("total"),
        F.try_divide(F.col("_total"), F.col("_n")).alias("avg_value"),
    )
