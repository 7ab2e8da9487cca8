"""Incremental merge by id, against a dictionary that does the same."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.plans import merge as M

SCHEMA = "id string, v int, name string, roles array<string>, tags array<struct<a: int, b: string>>, day string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def merge(spark, base, rows, **more):
    return M.merge_latest(frame(spark, rows), base, "id", ["v"], "day", unite=["roles", "tags"], **more)


def read(spark, base):
    got = M.read_merged(spark, base, frame(spark, []).schema, "day").collect()
    return {r.id: (r.v, r.name, r.roles, None if r.tags is None else [tuple(t) for t in r.tags], r.day) for r in got}


def files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


ONE = [("p", 1, "old", ["x"], [(1, "t")], "d1"), ("p", 1, "old", ["y"], None, "d1"), ("q", 1, "q", None, None, "d1"), ("r", 1, "r", [], [], "d2")]


def test_latest_wins_and_sets_unite(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    assert merge(spark, base, ONE) == {"ids": 3, "partitions": 2}
    assert read(spark, base) == {"p": (1, "old", ["x", "y"], [(1, "t")], "d1"), "q": (1, "q", None, None, "d1"), "r": (1, "r", [], [], "d2")}
    before = files(base)
    moved = [("p", 2, "new", ["z", "x", None], [(0, "s")], "d3")]
    assert merge(spark, base, moved) == {"ids": 1, "partitions": 2}    # d1 loses it, d3 gains it
    assert read(spark, base)["p"] == (2, "new", ["x", "y", "z"], [(0, "s"), (1, "t")], "d3")
    assert all(files(base)[f] == m for f, m in before.items() if "day=d2" in f)
    assert merge(spark, base, [("p", 1, "late", ["w"], None, "d1")])["partitions"] == 2   # an old version adds its roles only
    assert read(spark, base)["p"] == (2, "new", ["w", "x", "y", "z"], [(0, "s"), (1, "t")], "d3")
    again = read(spark, base)
    merge(spark, base, moved)
    assert read(spark, base) == again


def test_partition_that_loses_its_last_row_is_cleared(spark, tmp_dir):
    base = f"{tmp_dir}/t"
    merge(spark, base, [("p", 1, "a", [], [], "d1"), (None, 1, "n", ["k"], [], None)])
    merge(spark, base, [("p", 2, "b", [], [], "d2"), (None, 2, "n2", ["l"], [], "d2")])
    assert read(spark, base) == {"p": (2, "b", [], [], "d2"), None: (2, "n2", ["k", "l"], [], "d2")}
    assert merge(spark, base, []) == {"ids": 0, "partitions": 0}


def test_a_stopped_merge_is_finished(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/t"
    merge(spark, base, ONE)
    real = M._apply

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(M, "_apply", stop)
    with pytest.raises(RuntimeError):
        merge(spark, base, [("p", 2, "new", ["z"], None, "d3")], stage_root=f"{tmp_dir}/stages")
    monkeypatch.setattr(M, "_apply", real)
    merge(spark, base, [("s", 1, "s", [], [], "d4")], stage_root=f"{tmp_dir}/stages")
    got = read(spark, base)
    assert got["p"] == (2, "new", ["x", "y", "z"], [(1, "t")], "d3") and set(got) == {"p", "q", "r", "s"}
    assert not M.finish_merge(spark, base, frame(spark, []).schema, "day")


VERSION = st.tuples(st.sampled_from("pqr"), st.integers(1, 3), st.none() | st.lists(st.sampled_from("xyz"), max_size=3), st.sampled_from(["d1", "d2"]))


@given(st.lists(st.lists(VERSION, max_size=5), min_size=1, max_size=2))
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_loads(spark, loads):
    import tempfile

    base = tempfile.mkdtemp(prefix="strata-merge-") + "/t"
    best, roles = {}, {}
    for load in loads:
        merge(spark, base, [(i, v, f"n{v}", r, None, d) for i, v, r, d in load])
        for i, v, r, d in load:
            best[i] = max(best.get(i, (0, "")), (v, d))
            roles[i] = roles.get(i) if r is None else (roles.get(i) or set()) | set(r)
    want = {i: (v, f"n{v}", None if roles[i] is None else sorted(roles[i]), None, d) for i, (v, d) in best.items()}
    assert read(spark, base) == want


def test_without_sets(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "c"), (2, 5, "x")], "id int, v int, name string")
    assert sorted(map(tuple, M.latest_by_id(df, "id", ["v"]).collect())) == [(1, 1, "c"), (2, 5, "x")]
