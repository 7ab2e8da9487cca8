import json
import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.plans.incremental import work_grid
from strata.sources import paged


def _pages(root, key, day, pages, per_page=2, bare=False):
    folder = os.path.join(root, key, day)
    os.makedirs(folder, exist_ok=True)
    for n in range(pages):
        items = [{"id": f"{key}-{day}-{n}-{i}", "role": key} for i in range(per_page)]
        body = items if bare else {"items": items, "pages": pages, "page": n}
        with open(os.path.join(folder, f"{n}.json"), "w") as f:
            json.dump(body, f)


def _grid(spark, keys, days, exclude=None):
    k = spark.createDataFrame([(x,) for x in keys], "role_id string")
    ex = spark.createDataFrame([(x,) for x in exclude], "role_id string") if exclude else None
    return work_grid(k, days, exclude=ex)


@pytest.fixture
def page_root(tmp_dir):
    root = os.path.join(tmp_dir, "pages")
    _pages(root, "1", "2026-06-01", 1)
    _pages(root, "2", "2026-06-01", 3)
    _pages(root, "3", "2026-06-01", 7)
    _pages(root, "1", "2026-06-02", 0)
    return root


def test_pages_collected_and_reported(spark, page_root):
    days = [date(2026, 6, 1), date(2026, 6, 2)]
    df = paged.read_paged(spark, _grid(spark, ["1", "2", "3", "96"], days, exclude=["96"]),
                          "strata.sources.paged:file_pages", key_col="role_id",
                          params={"root": page_root}, max_pages=5)
    items = paged.items_of(df)
    counts = {(r.key, r.day): r["count"] for r in items.groupBy("key", "day").count().collect()}
    assert counts == {("1", days[0]): 2, ("2", days[0]): 6, ("3", days[0]): 10}
    report = {(r.key, r.day): (r.pages_fetched, r.truncated) for r in paged.fetch_report(df).collect()}
    assert len(report) == 6                       # 3 keys × 2 days; deprecated key excluded
    assert report[("3", days[0])] == (5, True)    # 7 pages, cap 5: reported, not silent
    assert report[("2", days[0])] == (3, False)
    assert report[("1", days[1])] == (1, False)   # empty unit still reported
    # no cap: every page is read
    full = paged.read_paged(spark, _grid(spark, ["3"], days[:1]), "strata.sources.paged:file_pages",
                            key_col="role_id", params={"root": page_root})
    assert paged.items_of(full).count() == 14


def test_bare_list_pages_stop_at_empty(spark, tmp_dir):
    root = os.path.join(tmp_dir, "bare")
    _pages(root, "7", "2026-06-01", 3, bare=True)
    df = paged.read_paged(spark, _grid(spark, ["7"], [date(2026, 6, 1)]), "strata.sources.paged:file_pages",
                          key_col="role_id", params={"root": root}, start_page=0)
    assert paged.items_of(df).count() == 6
    assert paged.fetch_report(df).first().pages_fetched == 4   # three pages + the empty one


def test_getter_retries(spark, tmp_dir):
    root = os.path.join(tmp_dir, "flaky")
    _pages(root, "5", "2026-06-01", 1)
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "paged_getters.py"))
    df = paged.read_paged(spark, _grid(spark, ["5"], [date(2026, 6, 1)]), "paged_getters:flaky_pages",
                          key_col="role_id", params={"root": root, "fail": 2}, retries=3, backoff=0.01)
    assert paged.items_of(df).count() == 2
    with pytest.raises(Exception):  # retries exhausted: the fetch fails (at the page-0 probe)
        paged.read_paged(spark, _grid(spark, ["5"], [date(2026, 6, 2)]), "paged_getters:flaky_pages",
                         key_col="role_id", params={"root": root, "fail": 5}, retries=2,
                         backoff=0.01).collect()


def test_where_prunes_units_before_fetching(spark, page_root):
    from pyspark.sql import functions as F
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "paged_getters.py"))
    days = [date(2026, 6, 1), date(2026, 6, 2)]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = paged.read_paged(spark, _grid(spark, ["1", "2", "3"], days), "paged_getters:counting_pages",
                              key_col="role_id", params={"root": page_root}, parallel_pages=False)
        got = df.where((F.col("key") == "2") & (F.col("day") >= F.lit(date(2026, 6, 1)))
                       & (F.col("day") < F.lit(date(2026, 6, 2))))
        assert paged.items_of(got).count() == 6
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    calls = os.listdir(os.path.join(page_root, "calls"))
    assert calls and all(c.startswith("2-2026-06-01-") for c in calls)


def test_parallel_pages_match_sequential(spark, page_root, tmp_dir):
    _pages(os.path.join(tmp_dir, "bare"), "8", "2026-06-01", 4, bare=True)
    days = [date(2026, 6, 1), date(2026, 6, 2)]
    for root, keys in ((page_root, ["1", "2", "3"]), (os.path.join(tmp_dir, "bare"), ["8"])):
        for cap in (None, 5, 1):
            runs = {}
            for parallel in (False, True):
                df = paged.read_paged(spark, _grid(spark, keys, days), "strata.sources.paged:file_pages",
                                      key_col="role_id", params={"root": root}, max_pages=cap,
                                      parallel_pages=parallel)
                items = sorted(tuple(r) for r in paged.items_of(df).collect())
                report = sorted((r.key, r.day, r.pages_fetched, r.truncated)
                                for r in paged.fetch_report(df).collect())
                runs[parallel] = (items, report)
            assert runs[False][0] == runs[True][0], (root, cap)
            if root == page_root:  # with page counts, reports agree exactly
                assert [x[:2] + (x[3],) for x in runs[False][1]] == [x[:2] + (x[3],) for x in runs[True][1]]


def test_integer_keys_and_no_retry(spark, page_root):
    keys = spark.createDataFrame([(2,), (None,)], "role_id bigint")
    grid = work_grid(keys, [date(2026, 6, 1)])
    df = paged.read_paged(spark, grid, "strata.sources.paged:file_pages", key_col="role_id",
                          params={"root": page_root}, retries=0)
    assert paged.items_of(df).count() == 6   # key cast to text; the null key is a unit of its own
    assert {r.key for r in paged.fetch_report(df).collect()} == {"2", None}
    with pytest.raises(ValueError):  # a cell without a day can't be asked for
        paged.read_paged(spark, grid.withColumn("dt", F.lit(None).cast("date")), "strata.sources.paged:file_pages",
                         key_col="role_id", params={"root": page_root})


def test_only_transient_errors_are_retried(spark, tmp_dir):
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "paged_getters.py"))
    reader = paged._PagedReader({"getter": "x:y", "retries": "3", "backoff": "0.01"})
    calls = []

    def gone(*_):
        calls.append(time.monotonic())
        raise LookupError("404")

    def busy(*_):
        calls.append(time.monotonic())
        if len(calls) < 3:
            raise paged.TransientError("429", retry_after=0.2)
        return {"items": [1], "pages": 1}

    with pytest.raises(LookupError):
        reader._fetch(gone, "k", "2026-06-01", 0)
    assert len(calls) == 1
    calls.clear()
    assert reader._fetch(busy, "k", "2026-06-01", 0)["items"] == [1]
    assert len(calls) == 3 and calls[1] - calls[0] >= 0.2
    assert paged.seconds_of("7") == 7 and paged.seconds_of(None) is None and paged.seconds_of("soon") is None
    assert paged.seconds_of("Wed, 01 Jan 2020 00:00:00 GMT") == 0


def test_short_reads_are_reported(spark, tmp_dir):
    root = os.path.join(tmp_dir, "short")
    _pages(root, "4", "2026-06-01", 5)
    os.replace(os.path.join(root, "4", "2026-06-01", "3.json"), os.path.join(root, "away.json"))
    for parallel, fetched in ((True, 4), (False, 4)):
        df = paged.read_paged(spark, _grid(spark, ["4"], [date(2026, 6, 1)]), "strata.sources.paged:file_pages",
                              key_col="role_id", params={"root": root}, parallel_pages=parallel)
        report = paged.fetch_report(df).first()
        assert (report.pages_fetched, report.truncated) == (fetched, True)


def test_ship_package_once(spark):
    from strata import session
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    # the workers can import the package (a tiny job that imports it on an executor)
    names = spark.sparkContext.parallelize([0], 1).map(lambda _: __import__("strata").__name__).collect()
    assert names == ["strata"]
