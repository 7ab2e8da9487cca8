"""Where rows could go missing without a word, there is an error, a count, or no loss."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.functions.json import json_value, to_variant
from strata.plans import documents, registry
from strata.sources.documents import parse_docs
from strata.sources.metric_files import load_metrics
from strata.streaming.events import kafka_options

SF = "/root/testdata/sf0.001"


def copy_of(spark, tmp_dir, **changed):
    """The smallest tables with some of them replaced."""
    for t in ("orders", "lineitem", "customer", "nation", "events"):
        df = changed.get(t)
        (df if df is not None else spark.read.parquet(f"{SF}/{t}.parquet")).write.parquet(f"{tmp_dir}/{t}.parquet")
    return tmp_dir


def test_a_large_order_is_one_posting(spark, tmp_dir):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    key = lines.agg(F.min("l_orderkey")).first()[0]
    one = lines.where(F.col("l_orderkey") == key).limit(1)
    many = one.crossJoin(spark.range(100, 300)).withColumn("l_linenumber", F.col("id").cast(one.schema["l_linenumber"].dataType)).drop("id")
    sf = copy_of(spark, tmp_dir, lineitem=lines.unionByName(many))
    rows = registry.q04_posting_fields(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/orders.parquet").count()
    assert sum(r.id == str(key) for r in rows) == 1
    assert registry.q02_nested_lists(spark, sf).count() == lines.count() + 200
    assert registry.q06_bundle(spark, sf).count() == 2 * (lines.count() + 200)
    assert "Window" not in documents.role_pages(spark, sf)._jdf.queryExecution().toString()


def test_null_event_types_come_through_the_paged_source(spark, tmp_dir):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn(
        "event_type", F.when(F.col("event_id") % 97 != 0, F.col("event_type")))
    sf = copy_of(spark, tmp_dir, events=events)
    out = registry.q19_paged_source(spark, sf)
    assert out.count() == events.count()
    assert out.where("event_type IS NULL").count() == events.where("event_type IS NULL").count() > 0


def test_malformed_documents_stop_the_job(spark):
    df = spark.createDataFrame([('{"id": "1"}',), ('{"id": ',)], "doc string")
    with pytest.raises(Exception):
        parse_docs(df, "doc", "id string").collect()


def test_salaries_of_any_size(spark):
    from strata.plans import postings
    df = spark.createDataFrame([('[{"id": "1", "salary": {"from": 3000000000, "to": 10.5}}]',)], "doc string")
    row = postings.vacancies(parse_docs(df, "doc", postings.SCHEMA, array=True)).first()
    assert (row.salary_from, row.salary_to) == (3e9, 10.5)


def test_json_true_is_no_number(spark):
    row = spark.createDataFrame([('{"a": true, "b": "1.5", "c": 2}',)], "doc string").select(
        *[json_value(to_variant("doc"), f"$.{k}", "double").alias(k) for k in "abc"]).first()
    assert tuple(row) == (None, 1.5, 2.0)


def test_committed_files_must_be_there(spark, tmp_dir):
    from strata.streaming import events as S
    lines = S.event_lines(spark.read.parquet(f"{SF}/events.parquet"))
    lines.write.text(f"{tmp_dir}/inbox")
    query = S.start_metrics_stream(S.text_stream(spark, f"{tmp_dir}/inbox"), f"{tmp_dir}/sink", f"{tmp_dir}/cp", available_now=True)
    query.awaitTermination()
    assert load_metrics(spark, f"{tmp_dir}/sink", sink_log=True).count() > 0
    os.replace(glob.glob(f"{tmp_dir}/sink/event_type=*/part-*.json")[0], f"{tmp_dir}/away.json")
    with pytest.raises(Exception):
        load_metrics(spark, f"{tmp_dir}/sink", sink_log=True).count()


def test_lost_offsets_stop_the_query():
    assert kafka_options("b", "t")["failOnDataLoss"] == "true"
    assert kafka_options("b", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_pruned_look_back_equals_the_whole_table(spark, tmp_dir):
    from strata.operators import metrics as M
    start = datetime(2024, 1, 1, 23, 59, 59, 999999)
    rows = [(i, start + timedelta(seconds=137.7 * i), None, f"t{i % 3}", float(i), "{}") for i in range(200)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    sf = copy_of(spark, tmp_dir, events=events)
    want = M.recent(registry._metrics(spark, sf, "direct"), registry.LOOKBACK_HOURS)
    got = registry.q14_recent(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and 0 < got.count() < registry._metrics(spark, sf).count()
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan
    empty = copy_of(spark, tmp_dir + "-empty", events=events.limit(0))
    assert registry.q14_recent(spark, empty).count() == 0


def test_registered_orders(spark):
    rows = [(int(r.category_id), int(r.role_id)) for r in registry.q02_nested_lists(spark, SF).collect()]
    assert rows == sorted(rows)
    dates = [(r.date, r.currency) for r in registry.q01_rates(spark, SF).collect()]
    assert [d for d, _ in dates] == sorted(d for d, _ in dates) or dates == sorted(dates, key=lambda x: x[1])


def test_scratch_folders_can_be_cleared(spark, tmp_dir, monkeypatch):
    from strata import session
    monkeypatch.setattr(session, "_MADE", [])
    path = session.new_scratch(spark, "t")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
