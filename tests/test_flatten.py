import glob
import gzip
import json
import os
import time
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.operators.flatten import explode_entries, flatten_tree, flatten_tree_sql, pluck
from strata.plans import catalog, documents, rates, registry
from strata.sinks import writers
from strata.sources.documents import json_docs, parse_docs, whole_text

RATES = {
    "Date": "2031-03-05T09:15:00+05:00",
    "Valute": {
        "XAA": {"Name": "Alpha øre", "Value": 0.25, "Nominal": 1000},
        "XBB": {"Name": "Beta", "Value": 1234.0625, "Nominal": 5},
    },
}


def _write(tmp_dir, name, obj):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, ensure_ascii=False))
    return path


def test_rates_unnest_and_types(spark, tmp_dir):
    out = rates.rates(json_docs(spark, _write(tmp_dir, "rates.json", RATES), rates.SCHEMA))
    assert out.columns == ["date", "currency", "name", "rate", "nominal"]
    assert dict(out.dtypes) == {"date": "date", "currency": "string", "name": "string",
                                "rate": "double", "nominal": "int"}
    assert [tuple(r) for r in out.collect()] == [
        (date(2031, 3, 5), "XAA", "Alpha øre", 0.25, 1000), (date(2031, 3, 5), "XBB", "Beta", 1234.0625, 5)]


def test_rates_offset_date_is_utc_day_and_empty(spark, tmp_dir):
    early = dict(RATES, Date="2031-03-05T02:15:00+05:00")
    out = rates.rates(json_docs(spark, _write(tmp_dir, "early.json", early), rates.SCHEMA))
    assert {r.date for r in out.collect()} == {date(2031, 3, 4)}
    empty = {"Date": "2033-01-09T20:00:00-04:00", "Valute": {}}
    assert rates.rates(json_docs(spark, _write(tmp_dir, "empty.json", empty), rates.SCHEMA)).count() == 0


def test_rates_bad_number_fails(spark, tmp_dir):
    bad = {"Date": "2033-01-09T20:00:00-04:00", "Valute": {"XCC": {"Name": "x", "Value": "7o", "Nominal": 1}}}
    with pytest.raises(Exception):
        rates.rates(json_docs(spark, _write(tmp_dir, "bad.json", bad), rates.SCHEMA)).collect()


ROLES = {"categories": [
    {"id": "10", "name": "Ten", "roles": [
        {"id": "2", "name": "r2", "accept_incomplete_resumes": True, "is_default": False,
         "select_deprecated": False, "search_deprecated": False},
        {"id": "10", "name": "r10"}]},
    {"id": "2", "name": "Two", "roles": [{"id": "5", "name": "r5"}, {"id": "2", "name": "r2"}]},
    {"id": "3", "name": "Empty", "roles": []},
    {"id": "4", "name": "Null", "roles": None},
]}


def test_professional_roles(spark, tmp_dir):
    out = catalog.professional_roles(json_docs(spark, _write(tmp_dir, "roles.json", ROLES), catalog.ROLES_SCHEMA))
    rows = [(r.category_id, r.role_id) for r in out.collect()]
    # ordered as integers; empty and null role lists vanish; role "2" kept under both
    assert rows == [("2", "2"), ("2", "5"), ("10", "2"), ("10", "10")]
    first = out.where("category_id = '10' AND role_id = '2'").first()
    assert first.accept_incomplete_resumes is True and first.role_name == "r2"


def test_industries_and_languages(spark, tmp_dir):
    groups = [{"id": "7", "name": "IT", "industries": [{"id": "7.1", "name": "Soft"}, {"id": "7.2", "name": "Web"}]},
              {"id": "8", "name": "None", "industries": []}]
    out = catalog.industries(json_docs(spark, _write(tmp_dir, "ind.json", groups), catalog.INDUSTRIES_SCHEMA))
    assert sorted(tuple(r) for r in out.collect()) == [("7", "IT", "7.1", "Soft"), ("7", "IT", "7.2", "Web")]
    langs = [{"id": "rus", "name": "Русский", "uid": "u1", "extra": 1}]
    out = catalog.languages(json_docs(spark, _write(tmp_dir, "lang.json", langs), catalog.LANGUAGES_SCHEMA))
    assert [tuple(r) for r in out.collect()] == [("rus", "Русский", "u1")]
    # an empty document reads as zero rows, not as a schema error
    assert json_docs(spark, _write(tmp_dir, "none.json", "[]"), catalog.LANGUAGES_SCHEMA).count() == 0


def _chain(depth):
    node = {"id": f"c{depth}", "parent_id": f"c{depth - 1}", "name": "leaf"}
    for d in range(depth - 1, 0, -1):
        node = {"id": f"c{d}", "parent_id": f"c{d - 1}" if d > 1 else None, "name": f"n{d}", "areas": [node]}
    return node


TREE = [
    {"id": "1", "parent_id": None, "name": "Root", "lat": "55.75", "lng": 37.61, "areas": [
        {"id": "2", "parent_id": "1", "name": "Mid", "lat": "bad", "lng": None, "areas": [
            {"id": "3", "parent_id": "2", "name": "Leaf", "lat": 1.5, "areas": []}]},
        {"id": "4", "parent_id": "1", "name": "NoAreas"}]},
    _chain(120),
]


def test_tree_flatten(spark, tmp_dir):
    texts = whole_text(spark, _write(tmp_dir, "areas.json", TREE))
    out = catalog.areas(texts)
    rows = {r.area_id: r for r in out.collect()}
    assert len(rows) == 4 + 120
    assert rows["1"].parent_id is None and rows["1"].lat == 55.75 and rows["1"].lng == 37.61
    assert rows["2"].lat is None and rows["2"].parent_id == "1"
    assert rows["3"].lat == 1.5
    assert rows["c120"].parent_id == "c119"  # deeper than Spark's default recursion limit


def test_tree_loop_equals_cte(spark, tmp_dir):
    # depth beyond 100 is covered by test_tree_flatten; equality needs no long chain
    texts = whole_text(spark, _write(tmp_dir, "areas2.json", TREE[:1] + [_chain(12)]))
    texts.createOrReplaceTempView("tree_docs")
    loop = flatten_tree(texts, "value", catalog.AREA_FIELDS)
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "-1")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    cte = flatten_tree_sql(spark, "tree_docs", "value", catalog.AREA_FIELDS)
    a = sorted(tuple(r) for r in loop.collect())
    b = sorted(tuple(r) for r in cte.collect())
    assert a == b


BUNDLE = {
    "currency": [{"id": "RUR", "name": "Рубли"}, {"id": "USD", "name": "Dollars"}],
    "gender": [{"id": "m", "name": "M"}],
    "codes": [{"code": "x", "name": "by code"}],
    "empty": [],
    "obj": {"id": "o", "name": "object"},
    "num": 3,
    "nothing": None,
    "version": "[not array]",
}


def test_bundle(spark, tmp_dir):
    out = catalog.dictionaries(whole_text(spark, _write(tmp_dir, "dict.json", BUNDLE)))
    rows = sorted((r.dict_name, r.id, r.name) for r in out.collect())
    assert rows == sorted([("currency", "RUR", "Рубли"), ("currency", "USD", "Dollars"),
                           ("gender", "m", "M"), ("codes", None, "by code")], key=str)


def test_explode_entries_map_and_pluck(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{}"), (3, None)], "id int, j string")
    parsed = df.select("id", F.from_json("j", "map<string,string>").alias("m"))
    out = explode_entries(parsed, "m", keep=["id"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "1"), (1, "b", "x")]
    arr = spark.createDataFrame([([{"id": "1", "name": "a"}],), (None,)],
                                "l array<struct<id:string,name:string>>")
    assert [r[0] for r in arr.select(pluck("l", "id")).collect()] == [["1"], None]


def test_parse_docs_array(spark):
    df = spark.createDataFrame([('[{"id": "1"}, {"id": "2"}]',), ("[]",)], "doc string")
    assert [r.id for r in parse_docs(df, "doc", "id string", array=True).collect()] == ["1", "2"]


def test_tree_keep_columns(spark):
    docs = spark.createDataFrame([("d1", json.dumps(TREE[:1])), ("d2", "[]"), ("d3", None)], "doc_id string, t string")
    out = flatten_tree(docs, "t", catalog.AREA_FIELDS, keep=["doc_id"])
    rows = sorted((r.doc_id, r.area_id) for r in out.collect())
    assert rows == [("d1", "1"), ("d1", "2"), ("d1", "3"), ("d1", "4")]


def test_professional_roles_non_numeric_ids(spark, tmp_dir):
    doc = {"categories": [{"id": "it-1", "name": "x", "roles": [{"id": "b"}, {"id": "3"}]},
                          {"id": "10", "name": "y", "roles": [{"id": "1"}]}]}
    out = catalog.professional_roles(json_docs(spark, _write(tmp_dir, "r.json", doc), catalog.ROLES_SCHEMA))
    assert [(r.category_id, r.role_id) for r in out.collect()] == [("10", "1"), ("it-1", "3"), ("it-1", "b")]


def test_json_docs_fails_fast_on_malformed_document(spark, tmp_dir):
    path = _write(tmp_dir, "broken.json", '{"Date": "2026-06-12", "Valute": {')
    with pytest.raises(Exception):
        rates.rates(json_docs(spark, path, rates.SCHEMA)).collect()


def test_four_levels_are_one_checkpoint(spark):
    def rounds():
        return len(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/rdd-*"))

    docs = spark.createDataFrame([(json.dumps([_chain(4)]),), (json.dumps(TREE[:1]),)], "t string")
    before = rounds()
    out = flatten_tree(docs, "t", catalog.AREA_FIELDS)
    assert rounds() - before == 1  # one pass for four levels, with the fields extracted
    assert sorted(r.area_id for r in out.collect()) == ["1", "2", "3", "4", "c1", "c2", "c3", "c4"]
    assert flatten_tree(docs.where("t = ''"), "t", catalog.AREA_FIELDS).count() == 0


def test_tree_children_of_other_kinds_are_leaves(spark):
    doc = [{"id": "a", "areas": [None, 1, {"id": "b", "areas": None}, {"id": "c", "areas": "x"}, {"id": "d", "areas": {}}]}, None]
    out = flatten_tree(spark.createDataFrame([(json.dumps(doc),)], "t string"), "t", catalog.AREA_FIELDS)
    assert sorted(str(r.area_id) for r in out.collect()) == ["None", "None", "None", "a", "b", "c", "d"]


def test_documents_land_as_files_of_few_folders(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(writers, "FOLDER_FILES", 3)
    docs = [json.dumps({"id": i, "name": "ж\n"}, indent=1, ensure_ascii=False) for i in range(10)]
    folders = writers.land_documents(spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1), f"{tmp_dir}/docs")
    files = [glob.glob(f"{f}/*") for f in folders]
    assert sorted(map(len, files)) == [1, 3, 3, 3]
    assert sorted(open(f, encoding="utf-8").read() for fs in files for f in fs) == sorted(d + "\n" for d in docs)
    os.makedirs(f"{tmp_dir}/docs/lost-0")  # what a failed attempt left behind
    with open(f"{tmp_dir}/docs/lost-0/0000", "w") as f:
        f.write(docs[0])
    assert sorted(r.id for r in json_docs(spark, folders, "id int, name string").collect()) == list(range(10))
    none = writers.land_documents(spark.createDataFrame([], "value string"), f"{tmp_dir}/none")
    assert whole_text(spark, none).count() == 0 and json_docs(spark, none, "id int").count() == 0


def _shuffles(spark):
    """Shuffles that have files on this process's disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def test_landed_arrays_need_no_shuffle_and_are_compressed(spark, tmp_dir):
    values = spark.createDataFrame([(f'{{"id":{i}}},{{"id":"ж{i}"}}',) for i in range(7)] + [(None,), ("",)], "value string")
    before = _shuffles(spark)
    folders = writers.land_documents(values.repartition(3, "value").coalesce(1), f"{tmp_dir}/docs", together=3, compress=True)
    for _ in range(100):
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.1)
    assert not left  # the shuffle under the documents went with their writing
    files = sorted(x for f in folders for x in glob.glob(f"{f}/*"))
    assert [os.path.basename(f) for f in files] == ["0000.gz", "0001.gz", "0002.gz"]
    lists = [json.loads(gzip.open(f, "rt", encoding="utf-8").read()) for f in files]
    assert sorted(map(len, lists)) == [2, 6, 6]
    assert Counter(str(x["id"]) for xs in lists for x in xs) == Counter([str(i) for i in range(7)] + [f"ж{i}" for i in range(7)])
    assert sorted(json.loads(r.value) == xs for r, xs in zip(whole_text(spark, folders).sort(F.col("_metadata.file_path")).collect(), lists)) == [True] * 3


def _orders_and_lines(spark, root):
    """Orders and lines with repeated, missing and null keys, several blocks of lines, lines without number or status."""
    lines = [(k, n, "R" if n % 2 else "N", "O" if n % 3 else "F", float(n), n / 100, 0.5) for k in (1, 2, 9, None) for n in (1, 2, 2, 64, 65, 130)]
    lines += [(1, None, "1.5", None, None, 0.25, None)] + [(3, n, "A", "O", 1.0, 0.0, 0.0) for n in range(1, 400)]
    orders = [(1, "a", 1.5, "2.5"), (2, "b", 2.5, "P"), (2, "c", None, "F"), (4, None, 4.5, None), (None, "n", 0.5, "O"), (3, "d", 1.0, "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double, "
                                 "l_discount double, l_tax double").write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_totalprice double, o_orderstatus string").write.parquet(f"{root}/orders.parquet")
    number = lambda x: float(x) if x in ("1.5", "2.5") else None
    out, copies = [], Counter(o[0] for o in orders)
    for k, name, price, status in orders:
        if k is not None:
            out.append((f"o{k}", None, name, price, number(status)))
    for k, n, flag, status, quantity, discount, tax in lines:
        first = n is None or 1 <= n <= 64
        own = None if k is None or n is None else f"{k}-{n}"
        line, ship = own and f"l{own}", own and f"s{own}"
        rows = [(line, None if k is None else f"o{k}", flag, quantity, discount)]
        rows += [(ship, line, status, number(flag), tax)] if status == "O" else []
        out += rows * (max(copies[k], 1) if first and k is not None else 1)  # under every order of its key
    return Counter(out)


@pytest.mark.parametrize("large", [registry.LARGE_FILE, 0, 220])
def test_tree_files_of_odd_rows(spark, tmp_dir, monkeypatch, large):
    expected = _orders_and_lines(spark, tmp_dir)
    monkeypatch.setattr(registry, "LARGE_FILE", large)
    monkeypatch.setattr(registry, "FOREST", 2)
    assert Counter(map(tuple, registry.q05_tree_files(spark, tmp_dir).collect())) == expected
    assert Counter(map(tuple, registry.q05_tree(spark, tmp_dir).collect())) == expected


def test_trees_move_lines_and_orders_once(spark, tmp_dir):
    _orders_and_lines(spark, tmp_dir)
    plan = documents.area_trees(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(moved) == 2, plan  # lines as read, and orders; the nested lines stay where they were made
