import re
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import filter_audit as A
from strata.llm.queries import op11_filter_audit
from tests.llm.helpers import EDGE, docs, prose

SF = "/root/testdata/sf0.001"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """Every ordering applied document by document, as the contract says it."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        first = least.get(t)
        f = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": first is not None and (i is None or first < i)}
        fails.append((i, lang or "", {k for k, v in f.items() if v}))
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in fails}:
        mine = [(i, f) for i, p, f in fails if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                shapley[part, name] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(name in f for _, f in mine) - len(gone), sum(f == {name} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert result(op11_filter_audit(spark, SF)) == brute(rows, labels)


def test_edges_ties_and_repeats(spark):
    long = "Word " + prose(1, 150, 4000)
    rows = [*EDGE, (7, "one", "fr"), (6, "one", "fr"), (6, "one", None), (8, "one", None), (None, "one", "fr"), (9, long, ""), (10, long, "de"),
            (9, long, ""), (11, "A # " * 60, "de"), (12, "x" * 300_000 + " $", "de"), (None, "only null ids", "xx"), (None, "only null ids", "xx")]
    labels = [(7, 1, 0), (7, 0, 1), (6, 1, None), (9, None, 1), (None, 1, 1), (10, 1, 0), (12, 0, 1), (12, 0, 1)]
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en") for r in rows]
    df = docs(spark, [(i, t, lang) for i, t, lang in full], clash=True)
    got = A.audit_filters(df, spark.createDataFrame(labels, LABELS))
    assert result(got) == brute(full, labels)
    assert got.count() == 600 * len({lang or "" for _, _, lang in full})


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert A.audit_filters(docs(spark, []), none).count() == 0
    one = result(A.audit_filters(docs(spark, [(1, None)]), none))
    assert one["en", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and one["en", "BACDE", 1] == (1, 0, 0, 0, 0, 0, 0)


@given(st.dictionaries(st.integers(0, 31), st.tuples(*[st.integers(0, 9)] * 3), max_size=32))
@settings(max_examples=150, deadline=None)
def test_walk_equals_direct_sums(cells):
    states = A.survivors(cells, 5)
    for subset in range(32):
        direct = tuple(sum(c[j] for m, c in cells.items() if not m & subset) for j in range(3))
        assert states[subset] == direct


@pytest.mark.parametrize("filters", ["", "A", "AB", "ABC"])
def test_other_numbers_of_filters(spark, filters):
    cells = {m: (m + 1, 0, 0) for m in range(1 << len(filters))}
    rows = list(A.audit_steps(cells, filters))
    orders = {"".join(o) for o in permutations(filters)} - {""}
    assert {r["filter_order"] for r in rows} == orders and len(rows) == len(orders) * len(filters)
    assert all(r["kept"] == 1 for r in rows if r["step"] == len(filters))  # only the cell that fails nothing is left
