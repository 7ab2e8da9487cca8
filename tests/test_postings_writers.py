import json
import os
from datetime import date, datetime

from pyspark.sql import functions as F

from strata.plans import incremental, postings
from strata.sinks.layout import partition_path, processed_dir, processed_root, raw_dir
from strata.sinks.writers import land_raw, write_keys, write_partition
from strata.sources.documents import json_docs

POSTINGS = [
    {"id": "1", "name": "Dev", "area": {"id": "1", "name": "Moscow"}, "employer": {"id": "9", "name": "Co"},
     "salary": {"from": 100, "to": 200, "currency": "RUR", "gross": True},
     "published_at": "2026-06-12T10:00:00+0300", "created_at": "2026-06-12T09:00:00+0300",
     "alternate_url": "u1", "professional_roles": [{"id": "96", "name": "Dev"}, {"id": "10", "name": "An"}]},
    {"id": "2", "name": "QA", "salary": None, "professional_roles": []},
    {"id": "3", "name": "Ops", "professional_roles": None},
]


def test_vacancies_flatten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "vac.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(POSTINGS, f)
    out = postings.vacancies(json_docs(spark, path, postings.SCHEMA))
    rows = {r.id: r for r in out.collect()}
    assert rows["1"].area_name == "Moscow" and rows["1"].salary_from == 100 and rows["1"].salary_gross is True
    assert rows["1"].professional_role_ids == ["96", "10"]
    assert rows["1"].published_at == datetime(2026, 6, 12, 7, 0)  # UTC session
    assert rows["2"].salary_from is None and rows["2"].professional_role_ids == []
    assert rows["3"].professional_role_ids is None and rows["3"].area_id is None


def test_layout_paths():
    assert raw_dir("/lake", "bank", "rates", date(2026, 6, 12)) == "/lake/raw/bank/rates/dt=2026-06-12"
    assert processed_dir("/lake", "rates", "2026-06-12") == "/lake/processed/rates/dt=2026-06-12"
    assert partition_path("/b", {"dt": "2026-06-12", "role_id": "a/b"}) == "/b/dt=2026-06-12/role_id=a%2Fb"


def test_write_partition_rerun_replaces(spark, tmp_dir):
    path = processed_dir(tmp_dir, "ds", "2026-06-12")
    write_partition(spark.range(5), path)
    write_partition(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    write_partition(spark.range(0), path)  # a rerun with no rows clears the day
    assert spark.read.parquet(path).count() == 0


def _vac(spark, rows):
    return spark.createDataFrame(rows, "id string, dt date, role_id string")


def test_write_keys_rerun_and_empty_keys(spark, tmp_dir):
    base = processed_root(tmp_dir, "vacancies")
    d1, d2 = date(2026, 6, 1), date(2026, 6, 2)
    first = _vac(spark, [("a", d1, "01"), ("b", d1, "01"), ("a", d1, "96"), ("c", d2, "01")])
    grid = spark.createDataFrame([(d1, "01"), (d1, "96"), (d2, "01"), (d2, "96")], "dt date, role_id string")
    write_keys(first, base, ["dt", "role_id"], requested=grid)
    read = lambda: incremental.read_keyed(spark, base, first.schema,
                                          {"dt": "date", "role_id": "string"})
    assert read().count() == 4
    assert {r.role_id for r in read().collect()} == {"01", "96"}  # "01" stays text
    # rerun of day 1 only: role 96 now has no rows and must be cleared; day 2 untouched
    rerun = _vac(spark, [("z", d1, "01")])
    grid1 = grid.where(F.col("dt") == F.lit(d1))
    write_keys(rerun, base, ["dt", "role_id"], requested=grid1)
    got = sorted((r.id, r.dt, r.role_id) for r in read().collect())
    assert got == [("c", d2, "01"), ("z", d1, "01")]
    # the same vacancy under two roles is two rows: counts need a distinct on id
    assert read().select("id").distinct().count() == 2


def test_run_days_half_open_and_idempotent(spark, tmp_dir):
    rows = [(1, datetime(2024, 1, 1, 0, 0), "click"), (2, datetime(2024, 1, 1, 23, 59, 59), "view"),
            (3, datetime(2024, 1, 2, 0, 0), "click"), (4, datetime(2024, 1, 3, 12, 0), "click")]
    ev = spark.createDataFrame(rows, "id int, ts timestamp_ntz, event_type string")
    base = processed_root(tmp_dir, "events")
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    for _ in range(2):
        incremental.run_days(ev, base, "ts", days, keys=["event_type"])
    out = incremental.read_keyed(spark, base, ev.schema, {"dt": "date", "event_type": "string"})
    assert sorted((r.id, r.dt) for r in out.collect()) == [(1, days[0]), (2, days[0]), (3, days[1])]
    assert incremental.days_of(ev, "ts") == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]


def test_land_raw_lines(spark, tmp_dir):
    path = raw_dir(tmp_dir, "src", "items", "2026-06-12")
    df = spark.createDataFrame([('{"id": "1"}',), ('{"id": "2"}',)], "value string")
    land_raw(df, path)
    land_raw(df, path)
    assert json_docs(spark, path, "id string", multi_line=False).count() == 2


def test_partition_path_matches_spark_escaping(spark, tmp_dir):
    values = ["a/b", "x:y", "50%", "q?=1", "plain-1.0", "sp ace", "ы"]
    df = spark.createDataFrame([(v, 1) for v in values], "k string, n int")
    base = os.path.join(tmp_dir, "esc")
    df.write.partitionBy("k").parquet(base)
    written = {d for d in os.listdir(base) if d.startswith("k=")}
    expected = {partition_path("", {"k": v}).lstrip("/") for v in values}
    assert written == expected
    # a requested key without rows is found and cleared even when it needs escaping
    keep = spark.createDataFrame([("plain-1.0", 2)], "k string, n int")
    write_keys(keep, base, ["k"], requested=spark.createDataFrame([(v,) for v in values], "k string"))
    assert {d for d in os.listdir(base) if d.startswith("k=")} == {"k=plain-1.0"}


def test_partition_path_empty_and_boolean_values(spark, tmp_dir):
    df = spark.createDataFrame([("", True, 1), ("x", False, 2), (None, None, 3)], "s string, b boolean, n int")
    base = os.path.join(tmp_dir, "eb")
    df.write.partitionBy("s", "b").parquet(base)
    written = {f"{s_dir}/{b_dir}" for s_dir in os.listdir(base) if "=" in s_dir
               for b_dir in os.listdir(os.path.join(base, s_dir)) if "=" in b_dir}
    expected = {partition_path("", {"s": s, "b": b}).lstrip("/") for s, b in (("", True), ("x", False), (None, None))}
    assert written == expected


def test_run_days_only_touches_requested_days(spark, tmp_dir):
    rows = [(1, datetime(2024, 1, 1, 5), "a"), (2, datetime(2024, 1, 2, 5), "a"), (3, datetime(2024, 1, 3, 5), "a")]
    ev = spark.createDataFrame(rows, "id int, ts timestamp_ntz, event_type string")
    base = processed_root(tmp_dir, "gaps")
    incremental.run_days(ev, base, "ts", [date(2024, 1, 1), date(2024, 1, 3)], keys=["event_type"])
    out = incremental.read_keyed(spark, base, ev.schema, {"dt": "date", "event_type": "string"})
    assert sorted(r.id for r in out.collect()) == [1, 3]
    assert not os.path.exists(os.path.join(base, "dt=2024-01-02"))


def test_ndjson_leaves_caller_schema_alone(spark, tmp_dir):
    from pyspark.sql.types import StructType
    from strata.sources.documents import ndjson
    path = os.path.join(tmp_dir, "n.json")
    with open(path, "w") as f:
        f.write('{"a": 1}\n{bad\n')
    schema = StructType.fromDDL("a int")
    for _ in range(2):
        df = ndjson(spark, path, schema)
        assert df.where("a IS NOT NULL").count() == 1
    assert schema.fieldNames() == ["a"]


def test_run_days_staged(spark, tmp_dir):
    rows = [(1, datetime(2024, 1, 1, 5), "a"), (2, datetime(2024, 1, 2, 5), "b")]
    ev = spark.createDataFrame(rows, "id int, ts timestamp_ntz, event_type string")
    base = processed_root(tmp_dir, "staged")
    incremental.run_days(ev, base, "ts", [date(2024, 1, 1), date(2024, 1, 2)], keys=["event_type"],
                         transform=lambda d: d.withColumn("id", d.id * 10), stage=os.path.join(tmp_dir, "stage"))
    out = incremental.read_keyed(spark, base, ev.schema, {"dt": "date", "event_type": "string"})
    assert sorted(r.id for r in out.collect()) == [10, 20]


def test_partition_path_timestamps(spark, tmp_dir):
    vals = [datetime(2024, 2, 1, 1, 2, 3), datetime(2024, 2, 1, 1, 2, 3, 500000)]
    df = spark.createDataFrame([(v, 1) for v in vals], "t timestamp_ntz, n int")
    base = os.path.join(tmp_dir, "ts")
    df.write.partitionBy("t").parquet(base)
    written = {d for d in os.listdir(base) if d.startswith("t=")}
    assert written == {partition_path("", {"t": v}).lstrip("/") for v in vals}
