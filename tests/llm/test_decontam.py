import random

import duckdb
import pytest

from strata.llm import decontam
from strata.llm.oracle import oracle_sql
from strata.llm.queries import op4_suffix_decontamination
from strata.session import ship_package
from tests.llm.helpers import docs, prose

SF = "/root/testdata/sf0.001"


def words(text):
    return [w.decode() for w in decontam.words(text or "")]


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), {}
        for item, body in items:
            b = words(body)
            if item is None or not b:
                continue
            k = min(13, len(b))
            for i in range(len(w) - k + 1):
                for j in range(len(b) - k + 1):
                    if w[i:i + k] == b[j:j + k]:
                        n = k
                        while i + n < len(w) and j + n < len(b) and w[i + n] == b[j + n]:
                            n += 1
                        hit |= set(range(i, i + k))
                        found[str(item)] = max(found.get(str(item), 0), n)
        out.append((doc_id, len(w), len(hit), tuple(sorted(found.items()))))
    return sorted(out, key=repr)


def bench(spark, items):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, hits string")


def result(found):
    return sorted(((r.row.doc_id, r.out.n_words, sum(h.end - h.start for h in r.out.hits),
                    tuple((m.item, m.words) for m in r.out.matches)) for r in found.collect()), key=repr)


def fixture():
    rnd = random.Random(7)
    items = [(i, prose(100 + i, rnd.choice([1, 3, 12, 13, 14, 30, 60]), 60)) for i in range(25)]
    items += [(3, items[4][1]), (None, "skip me"), (90, None), (91, "..."), (92, "AéB 12 x")]
    rows = [(i, prose(i, rnd.randrange(0, 120), 60)) for i in range(40)]
    for i in range(20):
        passage = words(rnd.choice(items[:25])[1])
        a = rnd.randrange(len(passage))
        rows.append((100 + i, prose(i, 15, 60) + " " + ", ".join(passage[a:]).upper() + "! " + prose(i + 9, 9, 60)))
    rows += [(1, None), (2, ""), (None, items[5][1]), (5, rows[5][1]), (300, "aéb 12 X"), (301, "É AÉB-12 x"), (302, items[6][1] * 300)]
    return rows, items


@pytest.mark.parametrize("block", [1 << 30, 400])
def test_equals_brute_force(spark, block):
    rows, items = fixture()
    found = decontam.find_contamination(docs(spark, rows, clash=True), bench(spark, items), block_bytes=block)
    assert result(found) == brute(rows, items)


def test_pairs_in_small_groups(spark, monkeypatch):
    rows, items = fixture()
    block = decontam.TestBlock([(str(i), decontam.words(t)) for i, t in items if i is not None and t and decontam.words(t)])
    want = decontam.search_shard([t or "" for _, t in rows], block)
    monkeypatch.setattr(decontam, "PAIRS", 5)
    assert decontam.search_shard([t or "" for _, t in rows], block) == want


def test_removal_and_empty_tables(spark):
    rows = [(1, prose(1, 40)), (2, prose(2, 40) + " " + prose(3, 40)), (3, None), (None, prose(3, 40)), (4, "")]
    df = docs(spark, rows, clash=True)
    out = decontam.remove_contaminated(df, bench(spark, [(1, prose(3, 40))]))
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3, 4]
    assert decontam.remove_contaminated(df, bench(spark, [])).count() == 5
    assert decontam.remove_contaminated(docs(spark, []), bench(spark, [(1, "a b")])).count() == 0


def test_share_of_hits(spark):
    one = prose(3, 13, 10_000)
    rows = [(1, one + " " + " ".join(f"z{i}" for i in range(247))), (2, one + " " + " ".join(f"z{i}" for i in range(248)))]
    got = {r.doc_id: r.contaminated for r in decontam.contamination_digest(
        decontam.find_contamination(docs(spark, rows), bench(spark, [(1, one)]))).collect()}
    assert got == {1: True, 2: False}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(oracle_sql()["op4_suffix_decontamination"])
    con.sql(oracle_sql()["op4_suffix_decontamination"]).create_view("o")
    cols = want.columns
    got = op4_suffix_decontamination(spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(want.fetchall())
