"""Resumable loads: fingerprints, resuming, unchanged cells, cleared cells."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.plans.incremental import read_keyed
from strata.plans.progress import EMPTY, Progress, cell_fingerprints, load_days

SCHEMA = "id bigint, t timestamp_ntz, kind string, x double"
DAYS = [date(2030, 3, d) for d in (1, 2, 3, 4)]


def rows(spark, *data):
    return spark.createDataFrame([(i, datetime(2030, 3, d, 12, i % 60), k, x) for i, d, k, x in data], SCHEMA)


BASE = [(1, 1, "a", 1.0), (2, 1, "b", 2.0), (3, 2, "a", 3.0), (4, 3, "a", None), (5, 4, None, 5.0), (6, 4, "", 6.0)]


def files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


@pytest.fixture
def lake(spark, tmp_dir):
    base, progress = f"{tmp_dir}/out", Progress(spark, f"{tmp_dir}/progress")

    def load(df, days=DAYS, **more):
        return load_days(df, base, "t", days, "things", progress, keys=["kind"], **more)

    def read():
        got = read_keyed(spark, base, df_schema, {"dt": "date", "kind": "string"}).collect()
        return sorted((r.id, r.dt.day, r.kind, r.x) for r in got)

    df_schema = rows(spark, *BASE).schema
    return load, read, base, progress


def test_load_resume_and_skip(spark, lake):
    load, read, base, progress = lake
    df = rows(spark, *BASE)
    want = [(1, 1, "a", 1.0), (2, 1, "b", 2.0), (3, 2, "a", 3.0), (4, 3, "a", None), (5, 4, None, 5.0), (6, 4, None, 6.0)]

    def stop(step):
        if step == 2:
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        load(df, after_step=stop)
    assert read() == want[:3]
    before = files(base)
    assert load(df) == {"run": 2, "steps": 2, "cells": 2}    # days 3 and 4; null and empty text are one cell
    assert read() == want
    assert {f: m for f, m in files(base).items() if f in before} == before  # steps 1 and 2 were not written again
    after = files(base)
    assert load(df) == {"run": 3, "steps": 0, "cells": 0} and files(base) == after


def test_only_changed_cells_are_written(spark, lake):
    load, read, base, progress = lake
    load(rows(spark, *BASE))
    before = files(base)
    changed = [(1, 1, "a", 1.5) if r[0] == 1 else r for r in BASE if r[0] != 3]  # one changed, the only row of a cell gone
    assert load(rows(spark, *changed))["cells"] == 2
    assert [r for r in read() if r[0] in (1, 2, 3)] == [(1, 1, "a", 1.5), (2, 1, "b", 2.0)]
    same = {f for f in before if "/kind=b/" in f or "dt=2030-03-03" in f or "dt=2030-03-04" in f}
    assert all(files(base)[f] == before[f] for f in same) and len(same) >= 3
    known = {(r.dt.day, r.cell): r for r in progress.latest("things").collect()}
    assert known[2, '{"k0":"a"}'].fingerprint == EMPTY and known[2, '{"k0":"a"}'].n_rows == 0
    assert load(rows(spark, *changed))["cells"] == 0      # a cleared cell stays cleared
    assert load(rows(spark, *BASE))["cells"] == 2


def test_days_outside_are_left_alone(spark, lake):
    load, read, base, _ = lake
    load(rows(spark, *BASE))
    assert load(rows(spark), days=DAYS[:1])["cells"] == 2   # both cells of day 1 are gone from the source
    assert [r[0] for r in read()] == [3, 4, 5, 6]
    assert load(rows(spark), days=[])["steps"] == 0


def test_stop_between_write_and_record(spark, lake, monkeypatch):
    load, read, _, progress = lake
    monkeypatch.setattr(Progress, "record", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(RuntimeError, match="disk full"):
        load(rows(spark, *BASE))
    monkeypatch.undo()
    assert load(rows(spark, *BASE), step_days=3) == {"run": 1, "steps": 2, "cells": 5}
    assert [r[0] for r in read()] == [1, 2, 3, 4, 5, 6]


def test_requested_keys_and_version(spark, lake):
    load, _, _, progress = lake
    keys = spark.createDataFrame([("a",), ("z",)], "kind string")
    load(rows(spark, *BASE), requested_keys=keys)
    known = {(r.dt.day, r.cell): r.n_rows for r in progress.latest("things").collect()}
    assert known[1, '{"k0":"z"}'] == 0 and known[1, '{"k0":"a"}'] == 1 and len(known) == 5 + 4 + 1
    assert load(rows(spark, *BASE), requested_keys=keys)["cells"] == 0
    assert load(rows(spark, *BASE), requested_keys=keys, version="2")["cells"] == 5
    assert load(rows(spark, *BASE), requested_keys=keys, version="2", transform=lambda d: d.withColumn("x", F.col("x") + 1))["cells"] == 0


def test_fold_keeps_the_newest(spark, lake):
    load, _, _, progress = lake
    load(rows(spark, *BASE))
    load(rows(spark, *[(i, d, k, 9.0) for i, d, k, _ in BASE]))
    newest = sorted(map(tuple, progress.latest("things").collect()))
    assert progress.rows().count() > len(newest)
    progress.fold()
    assert progress.rows().count() == len(newest) and sorted(map(tuple, progress.latest("things").collect())) == newest
    assert progress.next_run("things") == 3 and progress.next_run("other") == 1


def test_fingerprints(spark):
    def prints(data):
        df = spark.createDataFrame(data, "c string, a string, b string")
        return {r.c: r.fingerprint for r in cell_fingerprints(df, ["c"]).collect()}

    one = prints([("k", "x", "y"), ("k", "p", "q"), ("l", None, "x")])
    assert one == prints([("l", None, "x"), ("k", "p", "q"), ("k", "x", "y")])            # any order
    assert one["k"] != prints([("k", "x", "y"), ("k", "p", "q"), ("k", "p", "q")])["k"]   # repeats count
    assert one["l"] != prints([("l", "x", None)])["l"]                                    # nulls have a place
    twice, thrice = prints([("k", "x", "y")] * 2)["k"], prints([("k", "x", "y")] * 4)["k"]
    assert len({twice, thrice, prints([("k", "x", "y")])["k"]}) == 3
