import json
import os
import time
from datetime import datetime, timedelta

import pytest

from strata.sources.metric_files import line_quality, load_metrics
from strata.streaming import events as S

T0 = datetime(2024, 1, 1)
T0_MS = 1704067200000  # 2024-01-01T00:00:00Z


def _ev(sec, event_type="click", amount=1.0, **extra):
    row = {"event_type": event_type, "user_id": 7, "amount": amount, "ts_ms": T0_MS + int(sec * 1000)}
    row.update(extra)
    return json.dumps(row)


FILES = [
    [_ev(0, amount=1.0), _ev(15, amount=2.0), "garbage",
     json.dumps({"event_type": "view", "user_id": 1, "amount": "bad", "ts_ms": T0_MS + 5000}),
     json.dumps({"event_type": "click", "user_id": 1, "amount": 9.0})],
    [_ev(200)],
    [_ev(20, amount=4.0), _ev(198)],   # +20 s is 180 s late but Spark lags one batch: counted
    [_ev(400)],
    [_ev(420)],                         # moves the late filter past 400 s
    [_ev(21, amount=100.0)],            # late by more than two batches: dropped
]


def test_stream_late_data_and_garbage(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    now = time.time() - 1000
    for i, lines in enumerate(FILES):
        p = os.path.join(inbox, f"events-{i}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (now + i * 10, now + i * 10))  # one file per batch, in this order
    sink, ckpt = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")
    q = S.start_metrics_stream(S.text_stream(spark, inbox, max_files_per_trigger=1), sink, ckpt,
                               available_now=True)
    assert q.awaitTermination(300)
    out = load_metrics(spark, sink, sink_log=True)
    rows = {(r.event_type, r.window_start): r for r in out.collect()}
    at = lambda s: T0 + timedelta(seconds=s)
    assert rows[("click", at(0))].cnt == 3          # 0 s, 15 s and the late 20 s
    assert rows[("click", at(20))].cnt == 1         # the 21 s row was dropped
    assert rows[("click", at(0))].total == 7.0
    view = rows[("view", at(0))]
    assert view.cnt == 1 and view.total is None     # bad field → null, row kept
    # append mode: only windows whose end passed the final watermark (420 - 5 s)
    assert max(r.window_end for r in rows.values()) <= at(415)
    assert all(r.window_end - r.window_start == timedelta(minutes=1) for r in rows.values())


def test_stream_equals_batch_under_watermark(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox = os.path.join(tmp_dir, "inbox")
    S.event_lines(ev).write.text(inbox)
    sink, ckpt = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")
    q = S.start_metrics_stream(S.text_stream(spark, inbox), sink, ckpt, available_now=True)
    assert q.awaitTermination(300)
    streamed = load_metrics(spark, sink, sink_log=True)
    batch = S.rolling_metrics(S.parse_events(S.event_lines(ev)))
    wm = batch.agg({"window_end": "max"}).first()[0]
    from pyspark.sql import functions as F
    last_event = S.parse_events(S.event_lines(ev)).agg(F.max("event_ts")).first()[0]
    limit = last_event - timedelta(seconds=5)
    from strata.operators.metrics import round_metrics
    expected = round_metrics(batch).where(F.col("window_end") <= F.lit(limit).cast("timestamp_ntz"))
    assert wm is not None
    a = sorted(tuple(r) for r in streamed.select(*expected.columns).collect())
    b = sorted(tuple(r) for r in expected.collect())
    assert a == b


def test_kafka_rows_and_options(spark):
    df = spark.createDataFrame([(1, "клик", None)], "id long, name string, amount double")
    row = S.to_kafka_rows(df, "id").first()
    assert row.key == "1"
    assert json.loads(row.value) == {"id": 1, "name": "клик", "amount": None}
    assert "клик" in row.value  # not ASCII-escaped
    opts = S.kafka_options("broker:9092", "events", "g1")
    assert opts["startingOffsets"] == "latest" and opts["subscribe"] == "events"
    assert S.kafka_options("b", "t", from_beginning=True)["startingOffsets"] == "earliest"
    w = S.kafka_write_options("broker:9092", "events")
    assert (w["kafka.acks"], w["kafka.linger.ms"], w["topic"]) == ("all", "20", "events")


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _m(ws, we, cnt, total=1.23456, avg=0.123456):
    return json.dumps({"window_start": ws, "window_end": we, "cnt": cnt, "total": total, "avg_value": avg})


def test_metric_files_loader(spark, tmp_dir):
    root = os.path.join(tmp_dir, "metrics")
    _write(os.path.join(root, "event_type=click", "part-0.json"), [
        _m("2024-01-01 00:00:00", "2024-01-01 00:01:00", 5),
        "",
        "{oops",
        _m("2024-01-01 00:00:10.5", "2024-01-01 00:01:10.5", 1),
        _m("2024-01-01 00:00:20.123", "2024-01-01 00:01:20.123", 1),
        _m("2024-01-01 00:00:30.123456", "2024-01-01 00:01:30.123456", 1),
        _m("yesterday", "2024-01-01 00:01:40", 1),
        _m("2024-01-01 00:00:00", "2024-01-01 00:01:00", 3),   # duplicate with smaller cnt
        json.dumps({"window_start": "2024-01-01 00:00:50", "window_end": "2024-01-01 00:01:50",
                    "cnt": "x", "total": 1.0, "avg_value": 1.0}),  # bad number: set aside
    ])
    _write(os.path.join(root, "event_type=click", "part-1.inprogress.json"),
           [_m("2024-01-02 00:00:00", "2024-01-02 00:01:00", 9)])
    _write(os.path.join(root, "event_type=01", "part-0.json"), [_m("2024-01-01 00:00:00", "2024-01-01 00:01:00", 2)])
    _write(os.path.join(root, "stray.json"), [_m("2024-01-03 00:00:00", "2024-01-03 00:01:00", 4)])
    out = load_metrics(spark, root)
    rows = sorted(((r.event_type, r.window_start, r.cnt, r.total, r.avg_value) for r in out.collect()),
                  key=str)
    types = {r[0] for r in rows}
    assert types == {"click", "01"}
    click = [r for r in rows if r[0] == "click"]
    assert len(click) == 5
    starts = {r[1] for r in click}
    assert datetime(2024, 1, 1, 0, 0, 30, 123456) in starts and datetime(2024, 1, 1, 0, 0, 10, 500000) in starts
    assert None in starts
    first = [r for r in click if r[1] == datetime(2024, 1, 1)][0]
    assert first[2] == 5 and first[3] == 1.23 and first[4] == 0.1235
    q = line_quality(spark, root).first()
    assert q.malformed == 2


def test_stream_sliced_equals_direct(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox = os.path.join(tmp_dir, "inbox")
    S.event_lines(ev).repartition(4).write.text(inbox)
    out = {}
    for method in ("direct", "sliced"):
        sink, ckpt = os.path.join(tmp_dir, f"sink-{method}"), os.path.join(tmp_dir, f"ckpt-{method}")
        q = S.start_metrics_stream(S.text_stream(spark, inbox, max_files_per_trigger=1), sink, ckpt,
                                   available_now=True, method=method)
        assert q.awaitTermination(300)
        out[method] = sorted(tuple(r) for r in load_metrics(spark, sink, sink_log=True).collect())
    assert len(out["direct"]) > 0
    assert out["direct"] == out["sliced"]


def test_event_quality_counts(spark):
    lines = spark.createDataFrame([(l,) for l in FILES[0]], "value string")
    q = S.event_quality(S.parse_events(lines)).first()
    # two clicks, garbage, a view with a bad amount, a row without ts_ms
    assert (q.rows, q.unparsed, q.no_event_time, q.no_amount) == (5, 1, 2, 2)


def test_event_quality_partial_rows(spark):
    rows = ['{"user_id": 3}', '{"event_type": null, "ts_ms": 5}', "{}", "[1"]
    q = S.event_quality(S.parse_events(spark.createDataFrame([(r,) for r in rows], "value string"))).first()
    assert q.unparsed == 2 and q.no_event_time == 3


def test_stream_restart_from_checkpoint_is_exactly_once(spark, tmp_dir):
    """Two runs over one checkpoint (the second after new files arrive) give the same
    windows as one run over everything: nothing lost, nothing written twice."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = S.event_lines(ev.orderBy("ts")).coalesce(1)
    rows = [r.value for r in lines.collect()]
    half = len(rows) // 2
    inbox, sink, ckpt = (os.path.join(tmp_dir, d) for d in ("inbox", "sink", "ckpt"))
    os.makedirs(inbox)
    now = time.time() - 1000

    def drop(name, chunk, offset):
        p = os.path.join(inbox, name)
        with open(p, "w") as f:
            f.write("\n".join(chunk) + "\n")
        os.utime(p, (now + offset, now + offset))

    drop("a.json", rows[:half], 0)
    q = S.start_metrics_stream(S.text_stream(spark, inbox), sink, ckpt, available_now=True)
    assert q.awaitTermination(300)
    first = load_metrics(spark, sink, sink_log=True, dedupe=False).count()
    drop("b.json", rows[half:], 10)
    q = S.start_metrics_stream(S.text_stream(spark, inbox), sink, ckpt, available_now=True)
    assert q.awaitTermination(300)
    both = load_metrics(spark, sink, sink_log=True, dedupe=False)
    keys = both.select("window_start", "event_type")
    assert keys.count() == keys.distinct().count() > first > 0
    # one run over all files from scratch gives the same rows
    sink2, ckpt2 = os.path.join(tmp_dir, "sink2"), os.path.join(tmp_dir, "ckpt2")
    q = S.start_metrics_stream(S.text_stream(spark, inbox), sink2, ckpt2, available_now=True)
    assert q.awaitTermination(300)
    once = load_metrics(spark, sink2, sink_log=True, dedupe=False)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, once.collect()))


def test_day_partitioned_metrics_prune_old_days(spark, tmp_dir):
    import io
    import contextlib
    from datetime import date as _date
    from pyspark.sql import functions as F
    from strata.operators.windows import hop_metrics
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    m = hop_metrics(ev, "ts", "event_type", "value")
    root = os.path.join(tmp_dir, "by_day")
    S.write_metric_files(m, root, by_day=True)
    since = _date(2024, 1, 20)
    got = load_metrics(spark, root, by_day=True, since=since)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "PartitionFilters: [isnotnull(dt" in buf.getvalue()
    whole = load_metrics(spark, root, by_day=True)
    expected = whole.where(F.to_date("window_start") >= F.lit(since))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert got.count() < whole.count()


def test_list_files_and_path_value(spark, tmp_dir):
    from strata.sources.files import list_files, path_value
    root = os.path.join(tmp_dir, "lake")
    for rel in ("event_type=click/part-0.json", "event_type=click/.part-1.json.inprogress.x",
                "event_type=view/part-2.inprogress.json", "event_type=view/part-3.json", "_SUCCESS"):
        _write(os.path.join(root, rel), ["{}"])
    os.makedirs(os.path.join(root, "event_type=empty"))
    files = list_files(spark, root)
    got = sorted((os.path.basename(r.path), r.t) for r in files.select("path", path_value("path", "event_type").alias("t")).collect())
    assert got == [("part-0.json", "click"), ("part-3.json", "view")]


def test_state_partitions_option(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox = os.path.join(tmp_dir, "inbox")
    S.event_lines(ev).write.text(inbox)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ValueError):
        S.start_metrics_stream(S.text_stream(spark, inbox), os.path.join(tmp_dir, "sink"),
                               os.path.join(tmp_dir, "ckpt"), state_partitions=3)
    q = S.start_metrics_stream(lambda s: S.text_stream(s, inbox), os.path.join(tmp_dir, "sink"),
                               os.path.join(tmp_dir, "ckpt"), available_now=True, state_partitions=3)
    assert q.awaitTermination(300)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ops = q.lastProgress["stateOperators"]
    assert ops and ops[0]["numShufflePartitions"] == 3


def test_path_value_is_anchored_and_default_trigger(spark, tmp_dir):
    from strata.sources.files import path_value
    df = spark.createDataFrame([("s3://b/x/event_type=click/dt=2024-01-01/p.json",), ("audit_dt=9/dt=3/f",)], "p string")
    got = [tuple(r) for r in df.select(path_value("p", "type"), path_value("p", "dt"), path_value("p", "event_type")).collect()]
    assert got == [("", "2024-01-01", "click"), ("", "3", "")]
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox = os.path.join(tmp_dir, "inbox")
    S.event_lines(ev).write.text(inbox)
    q = S.start_metrics_stream(S.text_stream(spark, inbox), os.path.join(tmp_dir, "sink"),
                               os.path.join(tmp_dir, "ckpt"), trigger=None)
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()


def test_line_quality_by_day(spark, tmp_dir):
    from strata.sources.metric_files import line_quality
    root = os.path.join(tmp_dir, "q")
    _write(os.path.join(root, "dt=2024-01-01", "event_type=a", "p.json"),
           [_m("2024-01-01 00:00:00", "2024-01-01 00:01:00", 1), "{bad"])
    q = line_quality(spark, root, by_day=True).first()
    assert (q.lines, q.malformed) == (2, 1)


def test_list_files_missing_prefix_and_null_partition(spark, tmp_dir):
    from strata.sources.files import list_files, path_value
    assert list_files(spark, os.path.join(tmp_dir, "nothing-yet")).count() == 0
    df = spark.createDataFrame([("/x/k=__HIVE_DEFAULT_PARTITION__/f",), ("/x/k.v=1/f",)], "p string")
    assert [r[0] for r in df.select(path_value("p", "k")).collect()] == [None, ""]


def _land(inbox, name, lines):
    os.makedirs(inbox, exist_ok=True)
    with open(os.path.join(inbox, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_drain_until_idle(spark, tmp_dir):
    inbox, out, ckpt = (os.path.join(tmp_dir, d) for d in ("inbox", "out", "ckpt"))
    _land(inbox, "a.json", [_ev(0), _ev(1)])

    def start():
        return S.text_stream(spark, inbox).writeStream.format("parquet").option("checkpointLocation", ckpt).start(out)

    q = start()
    assert S.drain_until_idle(q, idle_seconds=2) and not q.isActive
    assert spark.read.parquet(out).count() == 2
    _land(inbox, "b.json", [_ev(2)])
    assert S.drain_until_idle(start(), idle_seconds=2)   # goes on from the checkpoint
    assert spark.read.parquet(out).count() == 3
    began = time.monotonic()
    assert not S.drain_until_idle(start(), idle_seconds=60, limit_seconds=1)
    assert time.monotonic() - began < 30
    broken = S.text_stream(spark, inbox).selectExpr("raise_error('broken')").writeStream.format("noop") \
        .option("checkpointLocation", ckpt + "2").start()
    with pytest.raises(Exception, match="broken"):
        S.drain_until_idle(broken, idle_seconds=5)


def test_batch_read_of_new_messages_is_refused(spark):
    with pytest.raises(ValueError):
        S.read_topic(spark, "broker:9092", "events", from_beginning=False)


def test_losses_per_batch(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    bad = json.dumps({"event_type": "view", "user_id": 1, "amount": "bad", "ts_ms": T0_MS})
    timeless = json.dumps({"event_type": "click", "user_id": 1, "amount": 9.0})
    for name, lines in (("0", [_ev(0), "garbage", bad, timeless, timeless]), ("1", [_ev(900)]), ("2", [_ev(950), _ev(5), "{"]), ("3", [_ev(960), _ev(1)])):
        _land(inbox, f"{name}.json", lines)
        os.utime(os.path.join(inbox, f"{name}.json"), (T0_MS / 1000 + int(name), T0_MS / 1000 + int(name)))
    log = S.LossListener()
    spark.streams.addListener(log)
    try:
        q = S.start_metrics_stream(S.text_stream(spark, inbox, 1), os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"), available_now=True)
        assert q.awaitTermination(300)
        for _ in range(100):  # events arrive on a thread of their own
            if len(log.rows) == 4:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    rows = sorted(log.rows, key=lambda r: r["batch"])
    counts = [tuple(r[c] for c in S.QUALITY_COUNTS) for r in rows]
    assert counts == [(5, 1, 3, 2), (1, 0, 0, 0), (3, 1, 1, 1), (2, 0, 0, 0)]
    # the watermark of a batch filters late rows from the next batch on
    assert [r["late_groups"] > 0 for r in rows] == [False, False, False, True]
