from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.json import is_json_array, json_doc, json_kind, json_length, json_string
from strata.operators.windows import hop_metrics

T0 = datetime(2024, 1, 1)

events = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]),
              st.integers(min_value=0, max_value=600_000_000),  # microseconds within 10 minutes
              st.one_of(st.none(), st.integers(min_value=-10_000, max_value=10_000).map(lambda c: c / 100))),
    min_size=0, max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events, size=st.sampled_from(["1 minute", "30 seconds"]), slide=st.sampled_from(["10 seconds", "5 seconds"]))
def test_sliced_equals_direct(spark, rows, size, slide):
    df = spark.createDataFrame([(k, T0 + timedelta(microseconds=us), v) for k, us, v in rows],
                               "k string, ts timestamp_ntz, v double")
    rnd = lambda m: sorted(tuple(r) for r in m.select(
        "window_start", "window_end", "k", "cnt", F.round("total", 6), F.round("avg_value", 6)).collect())
    assert rnd(hop_metrics(df, "ts", "k", "v", size, slide, "direct")) == \
        rnd(hop_metrics(df, "ts", "k", "v", size, slide, "sliced"))


def test_json_helpers(spark):
    docs = ['[1, 2]', '{"a": 1}', '"[x]"', "3", "1.5", "true", "null"]
    df = spark.createDataFrame([(d,) for d in docs], "t string").select(F.parse_json("t").alias("v"))
    got = [(r.kind, r.arr) for r in df.select(json_kind("v").alias("kind"), is_json_array("v").alias("arr")).collect()]
    assert [g[1] for g in got] == [True, False, False, False, False, False, False]
    assert [g[0] for g in got][:3] == ["ARRAY", "OBJECT", "STRING"]
    assert got[-1][0] == "VOID"
    obj = spark.createDataFrame([('{"id": 7, "n": null, "s": "x"}',)], "t string").select(F.parse_json("t").alias("v"))
    r = obj.select(json_string("v", "$.id").alias("id"), json_string("v", "$.n").alias("n"),
                   json_string("v", "$.missing").alias("m")).first()
    assert (r.id, r.n, r.m) == ("7", None, None)


def test_json_doc_and_length(spark):
    df = spark.createDataFrame([('{"areas": [{"id": 1}, {"id": 2}], "x": {"y": "z"}}',), ('{"areas": "no"}',)],
                               "t string").select(F.parse_json("t").alias("v"))
    rows = df.select(json_length("v", "$.areas").alias("n"),
                     json_string(json_doc("v", "$.x"), "$.y").alias("y")).collect()
    assert [(r.n, r.y) for r in rows] == [(2, "z"), (None, None)]


# ── flatten_tree against a brute-force walk ───────────────────────────────────

import json  # noqa: E402

from strata.operators.flatten import flatten_tree  # noqa: E402
from strata.plans.catalog import AREA_FIELDS  # noqa: E402

_leaf_value = st.one_of(st.none(), st.integers(-90, 90), st.floats(-90, 90, allow_nan=False, width=32),
                        st.sampled_from(["12.5", "bad", ""]))


def _node(children):
    return st.fixed_dictionaries(
        {"id": st.text("abc123", min_size=1, max_size=4), "name": st.text("xyz", max_size=3)},
        optional={"parent_id": st.text("abc", max_size=2), "lat": _leaf_value, "lng": _leaf_value,
                  "areas": st.one_of(children, st.just([]), st.just("not a list"), st.none())})


trees = st.lists(st.recursive(_node(st.just([])), lambda inner: _node(st.lists(inner, max_size=3)),
                              max_leaves=8), max_size=3)


def _walk(nodes):
    out = []
    for n in nodes:
        def num(v):
            if isinstance(v, bool) or v is None:
                return None
            try:
                return float(v)
            except ValueError:
                return None
        out.append((n["id"], n.get("parent_id"), n["name"], num(n.get("lat")), num(n.get("lng"))))
        kids = n.get("areas")
        if isinstance(kids, list):
            out += _walk(kids)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(trees, min_size=1, max_size=3))
def test_flatten_tree_matches_recursive_walk(spark, docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    got = sorted(((r.area_id, r.parent_id, r.name, None if r.lat is None else round(r.lat, 3),
                   None if r.lng is None else round(r.lng, 3))
                 for r in flatten_tree(df, "doc", AREA_FIELDS, checkpoint=False).collect()), key=repr)
    want = sorted(((a, p, n, None if la is None else round(la, 3), None if lo is None else round(lo, 3))
                   for d in docs for a, p, n, la, lo in _walk(d)), key=repr)
    assert got == want


# ── explode_bundle against a brute-force flatten ──────────────────────────────

from strata.operators.flatten import explode_bundle  # noqa: E402
from strata.plans.catalog import BUNDLE_FIELDS  # noqa: E402

_item = st.fixed_dictionaries({}, optional={"id": st.one_of(st.text("ab1", max_size=3), st.integers(0, 9)),
                                            "name": st.text("xy", max_size=3), "code": st.just("c")})
_entry = st.one_of(st.lists(_item, max_size=3), st.none(), st.integers(), st.text("[]x", max_size=4),
                   st.fixed_dictionaries({"id": st.just("o")}))
bundles_st = st.dictionaries(st.text("klmn", min_size=1, max_size=3), _entry, max_size=5)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs=st.lists(bundles_st, min_size=1, max_size=3))
def test_bundle_matches_brute_force(spark, docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    got = sorted(((r.dict_name, r.id, r.name) for r in explode_bundle(df, "doc", BUNDLE_FIELDS).collect()), key=repr)
    want = sorted(((k, None if it.get("id") is None else str(it["id"]), it.get("name"))
                   for d in docs for k, v in d.items() if isinstance(v, list) for it in v), key=repr)
    assert got == want


# ── read-side operators against brute force ───────────────────────────────────

from strata.operators import metrics as M  # noqa: E402

_metric_row = st.tuples(st.integers(0, 40), st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 3)),
                        st.one_of(st.none(), st.integers(0, 3).map(float)), st.integers(0, 3).map(float))
_SCHEMA = ("window_start timestamp_ntz, window_end timestamp_ntz, event_type string, "
           "cnt bigint, total double, avg_value double")


def _rows(raw):
    return [(T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 1), t, c, tot, avg) for m, t, c, tot, avg in raw]


def _key(v):  # nulls sort first, as in Spark's ascending order and struct comparison
    return tuple((x is not None, x if x is not None else 0) for x in v)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw=st.lists(_metric_row, max_size=40), hours=st.integers(0, 1), n=st.integers(1, 5))
def test_read_side_matches_brute_force(spark, raw, hours, n):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, _SCHEMA)
    # dedupe: the largest (cnt, total, avg_value) per window key
    best = {}
    for r in rows:
        k = r[:3]
        if k not in best or _key(r[3:]) > _key(best[k][3:]):
            best[k] = r
    assert sorted(map(tuple, M.dedupe_windows(df).collect()), key=repr) == sorted(best.values(), key=repr)
    # recent: window_end >= max(window_end) - hours
    if rows:
        cut = max(r[1] for r in rows) - timedelta(hours=hours)
        want = sorted((r for r in rows if r[1] >= cut), key=repr)
    else:
        want = []
    assert sorted(map(tuple, M.recent(df, hours).collect()), key=repr) == want
    # latest: top n by (window_end desc, event_type, window_start desc) — as a multiset of rows
    order = sorted(rows, key=lambda r: (-r[1].timestamp(), r[2], -r[0].timestamp()))
    got = [tuple(r) for r in M.latest(df, n).collect()]
    assert sorted([r[:3] for r in got]) == sorted([r[:3] for r in order[:n]])
