"""Compaction of a sink's small files, beside its stream and its readers."""

import os
import threading
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.plans.jobs import keep_compact
from strata.sinks import compaction as C
from strata.sources.metric_files import load_metrics
from strata.streaming import events as S

ODD = "a:b c+d%é"


def land(spark, sink, data, n=1):
    df = spark.createDataFrame(data, "event_type string, value string")
    for _ in range(n):
        df.repartition(1).write.mode("append").partitionBy("event_type").text(sink)


def read(spark, sink):
    return Counter((r.event_type, r.value) for r in C.read_live(spark, sink, "value string", "event_type string", "text").collect())


ROWS = [(ODD, "1"), (ODD, "2"), ("p", "3"), (None, "4"), ("01", "5")]


def test_rows_stay_and_files_become_few(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    land(spark, sink, ROWS, 4)
    want = read(spark, sink)
    assert want == Counter({k: 4 for k in ROWS})
    assert C.compact(spark, sink, fmt="text") == {"version": 1, "replaced": 16, "written": 4}
    assert read(spark, sink) == want and C.live_files(spark, sink).count() == 4
    plain = spark.read.schema("value string, event_type string").text(sink)  # readers that know no manifest
    assert plain.count() == sum(want.values())
    land(spark, sink, ROWS)                                                  # the stream goes on
    assert read(spark, sink) == Counter({k: 5 for k in ROWS}) and C.live_files(spark, sink).count() == 8
    assert C.compact(spark, sink, fmt="text")["replaced"] == 8               # its compacted files are packed again
    assert read(spark, sink) == Counter({k: 5 for k in ROWS})
    assert C.compact(spark, sink, fmt="text")["version"] == 0                # nothing left to merge


def test_files_committed_while_compacting(spark, tmp_dir, monkeypatch):
    sink = f"{tmp_dir}/sink"
    land(spark, sink, ROWS, 2)
    real = C._rows_of

    def late(*args):
        land(spark, sink, [("p", "late")])
        return real(*args)

    monkeypatch.setattr(C, "_rows_of", late)
    C.compact(spark, sink, fmt="text")
    assert read(spark, sink) == Counter({**{k: 2 for k in ROWS}, ("p", "late"): 1})


def test_a_compaction_that_stops_publishes_nothing(spark, tmp_dir, monkeypatch):
    sink = f"{tmp_dir}/sink"
    land(spark, sink, ROWS, 2)
    real, calls = C.manifest, []

    def stop(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(C, "manifest", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        C.compact(spark, sink, fmt="text")
    monkeypatch.undo()
    assert C.versions(spark, sink) == [] and read(spark, sink) == Counter({k: 2 for k in ROWS})
    assert C.compact(spark, sink, fmt="text")["version"] == 2
    assert read(spark, sink) == Counter({k: 2 for k in ROWS})
    later = datetime.now() + timedelta(hours=1)
    assert C.vacuum(spark, sink, timedelta(0), later) == 1 and not os.path.exists(f"{sink}/_compacted/v=1")


def test_vacuum_keeps_what_is_live(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    for _ in range(3):
        land(spark, sink, ROWS, 2)
        C.compact(spark, sink, fmt="text")
    want = read(spark, sink)
    assert C.vacuum(spark, sink, timedelta(days=1)) == 0
    assert C.vacuum(spark, sink, timedelta(0), datetime.now() + timedelta(hours=1)) > 0
    assert C.versions(spark, sink) == [3] and read(spark, sink) == want


def test_bins_fill_to_the_target(spark):
    files = spark.createDataFrame([(f"f{i:03d}", "k=a" if i % 3 else "k=b", 10 + i % 7) for i in range(300)] + [("big", "k=a", 80), ("alone", "k=c", 1)],
                                  "path string, folder string, length bigint")
    bins = C.plan_bins(files, 100)
    sizes = [r.s for r in bins.groupBy("folder", "bin").agg(F.sum("length").alias("s")).collect()]
    assert max(sizes) < 100 + 17 and sum(s >= 84 for s in sizes) >= len(sizes) - 2
    assert {r.path for r in files.collect()} - {r.path for r in bins.collect()} <= {"big", "alone", "f299", "f298", "f297"}


def test_lanes_bound_what_one_task_ranks(spark, monkeypatch):
    monkeypatch.setattr(C, "LANE_FILES", 10)
    files = spark.createDataFrame([(f"f{i}", "k=a", 10) for i in range(200)], "path string, folder string, length bigint")
    bins = C.plan_bins(files, 50)
    lanes = Counter(r.bin.split("-")[0] for r in bins.collect())
    assert len(lanes) > 10 and max(lanes.values()) < 30


def test_parquet_sink(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, "b")], "i int, x double, k string")
    for _ in range(3):
        df.repartition(1).write.mode("append").partitionBy("k").parquet(sink)
    schema = df.drop("k").schema
    assert C.compact(spark, sink, fmt="parquet", schema=schema)["written"] == 2
    got = C.read_live(spark, sink, schema, "k string", "parquet")
    assert sorted((r.i, r.x, r.k) for r in got.collect()) == sorted([(1, 2.5, "a"), (2, None, "b")] * 3, key=str)


def test_empty_sink(spark, tmp_dir):
    assert C.compact(spark, f"{tmp_dir}/none")["version"] == 0
    assert C.read_live(spark, f"{tmp_dir}/none", "value string", "k string", "text").count() == 0
    assert C.vacuum(spark, f"{tmp_dir}/none", timedelta(0)) == 0


def test_stream_sink(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    inbox, sink, ckpt = (f"{tmp_dir}/{d}" for d in ("inbox", "sink", "ckpt"))
    for i in range(3):
        S.event_lines(ev.where(F.col("event_id") % 3 == i).repartition(1)).write.mode("append").text(inbox)
        q = S.start_metrics_stream(lambda s: S.text_stream(s, inbox), sink, ckpt, available_now=True, state_partitions=3)
        assert q.awaitTermination(300)
        if i < 2:
            C.compact(spark, sink)
    want = sorted(map(tuple, load_metrics(spark, sink, sink_log=True).collect()))
    assert sorted(map(tuple, load_metrics(spark, sink, compacted=True).collect())) == want and want
    assert C.live_files(spark, sink).count() < C.committed_files(spark, sink).count()


def test_beside_a_running_stream(spark, tmp_dir):
    """The stream commits, a compaction loop merges, readers read: every row once at any time."""
    inbox, sink, ckpt = (f"{tmp_dir}/{d}" for d in ("inbox", "sink", "ckpt"))
    os.makedirs(inbox)
    schema = "event_type string, n int"
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(inbox)
    query = (lines.writeStream.format("json").option("checkpointLocation", ckpt).partitionBy("event_type")
                  .trigger(processingTime="200 milliseconds").start(sink))
    landed, seen = Counter(), 0
    loop = threading.Thread(target=lambda: done.append(keep_compact(query, spark, sink, 0.5)))
    done: list[int] = []
    loop.start()
    try:
        for i in range(12):
            with open(f"{tmp_dir}/new.json", "w") as f:
                f.writelines(f'{{"event_type": "{t}", "n": {i}}}\n' for t in "abc")
            os.rename(f"{tmp_dir}/new.json", f"{inbox}/{i}.json")
            landed.update((t, i) for t in "abc")
            if i % 3 == 2:
                got = Counter((r.event_type, r.n) for r in C.read_live(spark, sink, "n int", "event_type string").collect())
                assert max(got.values(), default=1) == 1 and set(got) <= set(landed) and len(got) >= seen
                seen = len(got)
        query.processAllAvailable()
    finally:
        query.stop()
        loop.join(120)
    assert done and done[0] >= 1
    assert Counter((r.event_type, r.n) for r in C.read_live(spark, sink, "n int", "event_type string").collect()) == landed
    assert C.live_files(spark, sink).count() < C.committed_files(spark, sink).count()
