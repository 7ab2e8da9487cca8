"""Event stream → hopping-window metrics → partitioned JSON files.

The same functions run on a batch DataFrame and on a stream:

    text  (Kafka ``value`` or JSON lines)  --parse_events-->  events
    events --rolling_metrics-->  window_start, window_end, event_type, cnt, total, avg_value
    metrics --start_metrics_stream / write_metric_files-->  <sink>/event_type=<t>/part-*.json

Malformed lines parse to all-null rows, which have no event time and so fall out
of every window (``json.ignore-parse-errors`` semantics); a malformed field only
nulls that field.  Late rows — behind the watermark of the previous micro-batch —
are dropped by Spark's stateful aggregation; windows are appended once, when the
watermark passes their end.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from strata.operators.windows import hop_metrics
from strata.session import pin_utc

# Event contract of the stream (fixed values).
EVENT_SCHEMA = "event_type string, user_id bigint, amount double, ts_ms bigint"
WATERMARK_DELAY = "5 seconds"
WINDOW_SIZE = "1 minute"
WINDOW_SLIDE = "10 seconds"
CHECKPOINT_EVERY = "30 seconds"
#: Name and counts of the metrics that the stream observes on its parsed events.
QUALITY, QUALITY_COUNTS = "event_quality", ("rows", "unparsed", "no_event_time", "no_amount")
# Text layout of window times in the sink files.
SINK_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def parse_events(text: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text → typed events with ``event_ts`` (UTC instant from epoch ms)."""
    parsed = text.select(F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA,
                                     {"mode": "PERMISSIVE"}).alias("e")).select("e.*")
    return parsed.withColumn("event_ts", F.timestamp_millis("ts_ms"))


def event_quality(events: DataFrame) -> DataFrame:
    """One row of counts over parsed events: rows, rows that are not JSON events at all
    (every field null), rows without an event time (dropped by the windows), rows
    whose amount is missing or malformed (counted in ``cnt``, not in sums)."""
    return events.agg(*_quality(events))


def _quality(events: DataFrame) -> list[Column]:
    fields = [F.col(c).isNotNull() for c in events.columns if c != "event_ts"]
    counts = {"rows": F.lit(True), "unparsed": ~reduce(or_, fields), "no_event_time": F.col("event_ts").isNull(),
              "no_amount": F.col("amount").isNull()}
    return [F.count(F.when(counts[c], 1)).alias(c) for c in QUALITY_COUNTS]


def event_lines(events: DataFrame, time_col: str = "ts", value_col: str = "value") -> DataFrame:
    """Driver-style events (``ts``, ``event_type``, ``user_id``, ``value``) → JSON lines
    in the stream's contract, ``ts_ms`` being epoch milliseconds (UTC)."""
    return events.select(F.to_json(F.struct(
        F.col("event_type"), F.col("user_id"), F.col(value_col).alias("amount"),
        F.unix_millis(F.col(time_col).cast("timestamp")).alias("ts_ms"))).alias("value"))


def rolling_metrics(events: DataFrame, delay: str = WATERMARK_DELAY, size: str = WINDOW_SIZE,
                    slide: str = WINDOW_SLIDE, method: str = "direct") -> DataFrame:
    """Per hopping window and event type: cnt, total, avg_value of ``amount``.

    The watermark bounds state on a stream (and is ignored in batch).  Window
    times come out as ``timestamp_ntz`` in UTC, the sink's zone-less type.
    ``method="sliced"`` pre-aggregates 10 s slices before the hopping roll-up.
    """
    watermarked = events.withWatermark("event_ts", delay)
    m = hop_metrics(watermarked, "event_ts", "event_type", "amount", size, slide, method=method)
    return (m.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
             .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def _sink_options() -> dict[str, str]:
    return {"timestampNTZFormat": SINK_TIME_FORMAT, "ignoreNullFields": "false"}


def _layout(metrics: DataFrame, by_day: bool) -> tuple[DataFrame, list[str]]:
    """Sink layout: ``event_type=<t>/`` (as the reference), or ``dt=<day>/event_type=<t>/``
    with ``by_day`` so readers of recent windows prune old days by folder."""
    if by_day:
        return metrics.withColumn("dt", F.to_date("window_start")), ["dt", "event_type"]
    return metrics, ["event_type"]


def write_metric_files(metrics: DataFrame, path: str, by_day: bool = False) -> None:
    """Batch writer with the stream sink's layout (JSON, partitioned by event type)."""
    df, keys = _layout(metrics, by_day)
    df.write.mode("overwrite").options(**_sink_options()).partitionBy(*keys).json(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines arriving as files in ``path`` (oldest first), as a text stream."""
    reader = spark.readStream.schema("value string").option("latestFirst", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def kafka_options(bootstrap: str, topic: str, group_id: str | None = None,
                  from_beginning: bool = False, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of ``readStream.format("kafka")`` for the event topic.

    ``startingOffsets`` applies to the first start only; afterwards the checkpoint
    holds the offsets (it replaces consumer-group auto-commit).  Offsets that the broker
    no longer has stop the query unless ``fail_on_data_loss`` is False.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_beginning else "latest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_stream(spark: SparkSession, **kwargs) -> DataFrame:
    """The event topic as a stream of ``value`` (needs the spark-sql-kafka package)."""
    return spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()


def read_topic(spark: SparkSession, bootstrap: str, topic: str, from_beginning: bool = True) -> DataFrame:
    """Bounded read of a topic as a batch (earliest offsets to the end at planning time):
    the drain-and-stop form of consuming.

    A batch read has no "from now on": it would start at the end it stops at.  To consume only new
    messages and stop, start :func:`kafka_stream` and :func:`drain_until_idle`.
    """
    if not from_beginning:
        raise ValueError("a batch read of only new messages is empty; use kafka_stream with drain_until_idle")
    opts = kafka_options(bootstrap, topic, from_beginning=True)
    opts["endingOffsets"] = "latest"
    return spark.read.format("kafka").options(**opts).load()


def drain_until_idle(query: StreamingQuery, idle_seconds: float, limit_seconds: float | None = None,
                     poll_seconds: float = 0.2) -> bool:
    """Let a running query consume until no rows have come for ``idle_seconds``, then stop it.

    Idle is judged by the query's progress: the time since a batch with rows ended, and
    never while a batch runs.  A query that fails raises its error here.  ``limit_seconds``
    bounds the whole wait; returns whether the query was idle (False: the limit came first).
    What is committed stays committed; the next start goes on from the checkpoint.
    """
    began = quiet_since = time.monotonic()
    seen = -1
    try:
        while query.isActive:
            now = time.monotonic()
            progress = query.lastProgress
            busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
            if progress is not None and progress["batchId"] != seen and progress["numInputRows"] > 0:
                seen, quiet_since = progress["batchId"], now
            if busy:
                quiet_since = now
            if now - quiet_since >= idle_seconds:
                return True
            if limit_seconds is not None and now - began >= limit_seconds:
                return False
            query.awaitTermination(poll_seconds)
        if query.exception() is not None:
            raise query.exception()
        return True  # it ended by itself: everything there was is consumed
    finally:
        if query.isActive:
            query.stop()


def window_losses(landed: DataFrame, emitted: DataFrame, delay: str = WATERMARK_DELAY, size: str = WINDOW_SIZE,
                  slide: str = WINDOW_SLIDE) -> DataFrame:
    """Per closed window and event type: events that landed for it, events it was emitted with, and the
    difference, ``lost``: rows that came behind the watermark.

    ``landed`` are all parsed events (``event_ts``, ``event_type``), late ones included, ``emitted``
    the sink's metrics.  A window is closed when the watermark after all of ``landed`` has
    passed its end.  The landed side is aggregated into panes before it is expanded; the two
    meet by window and type, which no skew of types or days piles up.
    """
    latest = landed.select((F.max("event_ts") - F.expr(f"interval {delay}")).cast("timestamp_ntz")).scalar()
    counted = hop_metrics(landed.withColumn("_one", F.lit(1)), "event_ts", "event_type", "_one", size, slide, method="sliced").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "event_type", F.col("cnt").alias("landed")).where(F.col("window_end") <= latest)
    seen = emitted.select(F.col("window_start").alias("_start"), F.col("event_type").alias("_type"), F.col("cnt").alias("_cnt"))
    same = (F.col("window_start") == F.col("_start")) & F.col("event_type").eqNullSafe(F.col("_type"))
    n = F.coalesce("_cnt", F.lit(0))
    return counted.join(seen, same, "left").select("window_start", "window_end", "event_type", "landed", n.alias("emitted"),
                                                   (F.col("landed") - n).alias("lost"))


class LossListener(StreamingQueryListener):
    """Per micro-batch of the metrics stream, what did not reach a window: register with ``spark.streams.addListener``.

    ``rows`` holds one dict per batch that saw input: query, batch, rows, unparsed (no JSON event at
    all), no_event_time, no_amount (counted in ``cnt``, in no sum) and late_groups, Spark's own count of
    (window, type) groups dropped behind the watermark, after its partial aggregation, so at least one
    row each; :func:`window_losses` counts the rows themselves.
    """

    def __init__(self):
        self.rows: list[dict] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        seen = p.observedMetrics.get(QUALITY)
        if seen is not None and seen["rows"]:
            self.rows.append({"query": str(p.id), "batch": p.batchId, **{c: int(seen[c]) for c in QUALITY_COUNTS},
                              "late_groups": sum(o.numRowsDroppedByWatermark for o in p.stateOperators)})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def kafka_write_options(bootstrap: str, topic: str) -> dict[str, str]:
    """Producer settings of the event topic: wait for all replicas, batch for 20 ms (fixed values)."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.linger.ms": "20",
    }


def write_to_kafka(df: DataFrame, bootstrap: str, topic: str, key_col: str | None = None) -> None:
    """Publish rows as JSON records (see :func:`to_kafka_rows`)."""
    (to_kafka_rows(df, key_col).write.format("kafka")
        .options(**kafka_write_options(bootstrap, topic)).save())


def start_metrics_stream(source: DataFrame | Callable[[SparkSession], DataFrame], sink: str, checkpoint: str,
                         trigger: str | None = CHECKPOINT_EVERY, available_now: bool = False,
                         query_name: str | None = None, method: str = "direct",
                         by_day: bool = False, state_partitions: int | None = None) -> StreamingQuery:
    """Start the streaming job: ``source`` (a text stream) → metrics → JSON sink.

    Append mode writes each window once, after the watermark passes its end.  The
    file sink commits every micro-batch to ``<sink>/_spark_metadata``; Spark
    readers of ``sink`` see only committed files (exactly-once with the checkpoint).
    ``available_now`` drains what is there and stops (a bounded run).  ``by_day``
    adds a ``dt`` folder level above ``event_type`` (see :func:`_layout`).  Counts of rows
    that reach no window are observed per batch (see :class:`LossListener`).

    ``state_partitions`` sets the partitions of the windowed state for a new
    checkpoint (later restarts keep the first value).  The key space is the windows
    in flight × event types, so tens to hundreds are enough; the session's shuffle
    width of a large batch cluster would make every micro-batch write that many
    files per event type.  A stream takes the setting from its session, so it needs one of its
    own: give ``source`` as a function of a session then (``lambda s: text_stream(s, path)``);
    the calling session's settings are not touched.
    """
    if state_partitions is not None:
        if not callable(source):
            raise ValueError("state_partitions needs source as a function of a session")
        own = SparkSession.active().newSession()
        pin_utc(own).conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        source = source(own)
    elif callable(source):
        source = source(SparkSession.active())
    events = parse_events(source)
    events = events.observe(QUALITY, *_quality(events))
    metrics, keys = _layout(rolling_metrics(events, method=method), by_day)
    writer = (metrics.writeStream.format("json").outputMode("append")
                     .options(**_sink_options())
                     .option("checkpointLocation", checkpoint)
                     .partitionBy(*keys))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:  # None: Spark's default (next batch as soon as one ends)
        writer = writer.trigger(processingTime=trigger)
    return writer.start(sink)


def to_kafka_rows(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Rows → (key, value) text for ``write.format("kafka")``.

    ``value`` is the row as JSON with null fields kept and non-ASCII text as is;
    ``key`` is the text of ``key_col`` (or null).
    """
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), value.alias("value"))
