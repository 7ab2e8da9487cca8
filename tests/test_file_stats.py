"""Recent rows by file statistics, and incremental listings."""

import os
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators.windows import hop_metrics, look_back, recent_hop_metrics
from strata.sources import file_stats as T
from strata.sources.metric_files import load_metrics
from strata.sources.snapshots import Snapshots, changes, process_new
from strata.streaming import events as S

DAY = datetime(2030, 1, 10)


def write(path, *times, stats=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    table = pa.table({"t": pa.array(times, pa.timestamp("us")), "x": pa.array(range(len(times)), pa.int64())})
    pq.write_table(table, path, write_statistics=stats, row_group_size=2)


def test_few_files_and_many_give_the_same(spark, tmp_dir, monkeypatch):
    for i in range(5):
        write(f"{tmp_dir}/t/{i}.parquet", *(DAY + timedelta(hours=5 * i + k) for k in range(4)), None)
    want = {DAY + timedelta(hours=n) for n in (18, 20, 21, 22, 23)}
    for few in (8, 0):
        monkeypatch.setattr(T, "FEW_FILES", few)
        rows, latest = T.recent_rows(spark, f"{tmp_dir}/t", "t", 4, before=timedelta(hours=1))
        assert latest == DAY + timedelta(hours=23) and {r.t for r in rows.collect()} == want


def test_ranges_and_recent_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(T, "FEW_FILES", 0)
    h = lambda n: DAY + timedelta(hours=n)
    write(f"{tmp_dir}/t/dt=1/a.parquet", h(0), h(1), h(2))
    write(f"{tmp_dir}/t/dt=2/b.parquet", h(5), None, h(8))
    write(f"{tmp_dir}/t/dt=2/c.parquet", None, None)
    write(f"{tmp_dir}/t/dt=3/d.parquet", h(9), h(10))
    got = {r.path.rsplit("/", 1)[-1]: (r.n_rows, r.low, r.high, r.known) for r in T.file_ranges(spark, f"{tmp_dir}/t", "t").collect()}
    assert got == {"a.parquet": (3, h(0), h(2), True), "b.parquet": (3, h(5), h(8), True), "c.parquet": (2, None, None, True),
                   "d.parquet": (2, h(9), h(10), True)}
    opened = lambda df: sorted(f.rsplit("/", 1)[-1] for f in df.inputFiles())
    rows, latest = T.recent_rows(spark, f"{tmp_dir}/t", "t", 2)
    assert latest == h(10) and sorted(r.t for r in rows.collect()) == [h(8), h(9), h(10)]
    assert opened(rows) == ["b.parquet", "d.parquet"]
    assert opened(T.recent_rows(spark, f"{tmp_dir}/t", "t", 0.5)[0]) == ["d.parquet"]
    assert sorted(r.t for r in T.recent_rows(spark, f"{tmp_dir}/t", "t", 1, before=timedelta(hours=1))[0].collect()) == [h(8), h(9), h(10)]
    write(f"{tmp_dir}/t/dt=0/blind.parquet", h(11), h(3), stats=False)   # no statistics: asked for its maximum and read
    rows, latest = T.recent_rows(spark, f"{tmp_dir}/t", "t", 2)
    assert latest == h(11) and sorted(r.t for r in rows.collect()) == [h(9), h(10), h(11)]


def test_a_store_that_only_spark_reads(spark, tmp_dir, monkeypatch):
    write(f"{tmp_dir}/t/a.parquet", DAY, DAY + timedelta(hours=1))
    write(f"{tmp_dir}/t/b.parquet", DAY + timedelta(hours=9))
    monkeypatch.setattr(T, "FOOTER_SCHEMES", ())
    monkeypatch.setattr(T, "FEW_FILES", 0)
    rows, latest = T.recent_rows(spark, f"{tmp_dir}/t", "t", 1)
    assert latest == DAY + timedelta(hours=9) and rows.count() == 1 and len(rows.inputFiles()) == 1


@pytest.mark.parametrize("few", [0, 8])
def test_no_rows(spark, tmp_dir, monkeypatch, few):
    monkeypatch.setattr(T, "FEW_FILES", few)
    write(f"{tmp_dir}/t/a.parquet")
    rows, latest = T.recent_rows(spark, f"{tmp_dir}/t", "t", 2)
    assert latest is None and rows.count() == 0 and rows.columns == ["t", "x"]
    write(f"{tmp_dir}/t/b.parquet", DAY)
    with pytest.raises(Exception, match="not a time"):
        T.recent_rows(spark, f"{tmp_dir}/t", "x", 2)


def test_recent_metrics_opens_recent_days(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    S.write_metric_files(hop_metrics(ev, "ts", "event_type", "value"), f"{tmp_dir}/m", by_day=True)
    got = T.recent_metrics(spark, f"{tmp_dir}/m", 30)
    full = load_metrics(spark, f"{tmp_dir}/m", by_day=True)
    last = full.agg(F.max("window_end")).first()[0]
    want = sorted(map(tuple, full.where(F.col("window_end") >= F.lit(last - timedelta(hours=30))).collect()))
    assert sorted(map(tuple, got.collect())) == want and want
    days = T.metric_days(spark, f"{tmp_dir}/m")
    assert len(days) > 20
    for day in days[3:]:  # a file that can't be opened in every older folder: nobody does
        with open(f"{tmp_dir}/m/dt={day}/event_type=click/part-x.json.gz", "w") as f:
            f.write("no gzip")
    assert T.recent_metrics(spark, f"{tmp_dir}/m", 30).count() == len(want)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load_metrics(spark, f"{tmp_dir}/m", by_day=True).collect()
    broken = f"{tmp_dir}/m/dt=2031-01-01/event_type=click"
    os.makedirs(broken)
    open(f"{broken}/part-0.json", "w").write("{cut off\n")   # the newest folder holds no window
    assert T.recent_metrics(spark, f"{tmp_dir}/m", 30).count() == len(want)
    assert T.recent_metrics(spark, f"{tmp_dir}/none", 30).count() == 0


@pytest.mark.parametrize("size, slide", [("1 minute", "10 seconds"), ("50 seconds", "20 seconds"), ("1 hour", "7 minutes")])
def test_look_back_equals_filtering_all_windows(spark, size, slide):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "event_type", "value")
    latest = ev.agg(F.max("ts")).first()[0]
    full = hop_metrics(ev, "ts", "event_type", "value", size, slide)
    last = full.agg(F.max("window_end")).first()[0]
    want = full.where(F.col("window_end") >= F.lit(last - timedelta(hours=20)))
    got = recent_hop_metrics(ev, latest, "ts", "event_type", "value", 20, size, slide)
    key = lambda df: sorted((r.window_start, r.event_type, r.cnt, round(r.total, 6)) for r in df.collect())
    assert key(got) == key(want)
    assert look_back(latest, 20, size, slide)[0] == last - timedelta(hours=20)


def test_changes_and_snapshots(spark, tmp_dir):
    inbox, snaps, seen = f"{tmp_dir}/in", Snapshots(spark, f"{tmp_dir}/snaps"), []
    os.makedirs(inbox)

    def put(name, text, age=0):
        with open(f"{inbox}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{inbox}/{name}", (time.time() - age,) * 2)

    run = lambda: process_new(spark, inbox, snaps, lambda paths: seen.append(sorted(p.rsplit("/", 1)[-1] for p in paths)))
    put("a.txt", "1", 100)
    put("b c.txt", "2", 100)
    put("d.inprogress", "3")
    assert run() == {"added": 2, "changed": 0, "removed": 0}
    assert run() == {"added": 0, "changed": 0, "removed": 0} and snaps.versions() == [1]
    put("a.txt", "1!", 50)
    put("e.txt", "4")
    os.remove(f"{inbox}/b c.txt")
    assert run() == {"added": 1, "changed": 1, "removed": 1}
    assert seen == [["a.txt", "b c.txt"], ["a.txt", "e.txt"]]
    put("f.txt", "5")

    def stop(paths):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        process_new(spark, inbox, snaps, stop)
    assert run()["added"] == 1 and seen[-1] == ["f.txt"]     # not stored, so seen as new again
    for n in range(3):
        put(f"g{n}.txt", "6")
        run()
    assert snaps.versions() == [5, 6]
    assert process_new(spark, f"{tmp_dir}/none", Snapshots(spark, f"{tmp_dir}/s2"), stop) == {"added": 0, "changed": 0, "removed": 0}


def test_changes_of_listings(spark):
    schema = "path string, length bigint, modified timestamp"
    t = datetime(2030, 1, 1)
    old = spark.createDataFrame([("a", 1, t), ("b", 2, t), ("c", 3, t), ("d", 4, None)], schema)
    new = spark.createDataFrame([("a", 1, t), ("b", 5, t), ("d", 4, None), ("e", 3, t)], schema)
    assert {(r.path, r.change) for r in changes(new, old).collect()} == {("b", "changed"), ("c", "removed"), ("e", "added")}
