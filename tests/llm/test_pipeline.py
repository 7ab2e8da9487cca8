import duckdb
import pytest

import corpus_pipeline as P
from strata.llm import decontam, secrets
from strata.llm.common import read, stage
from strata.llm.jaccard import jaccard_components
from strata.llm.toxicity import score_documents, train
from tests.llm.helpers import EDGE, docs, prose
from tests.llm.test_jaccard import brute as components_of

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of every stage over the smallest tables."""
    out, df = {}, read(spark, SF, "documents")
    for name, step in P.STAGES:
        after = stage(step(spark, df, SF), f"t-{name}")
        out[name] = (df, after)
        df = after
    return out


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "jaccard_join", "decontamination", "secret_scan", "source_mixing"]


def test_columns_stay(steps):
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.columns == COLUMNS and after.schema.simpleString() == before.schema.simpleString()


def test_toxicity_rejects_what_it_scores(spark, steps):
    before, after = steps["toxicity"]
    scores = {r.row.doc_id: r.out.score for r in score_documents(before, train(before, read(spark, SF, "labels"))).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, s in scores.items() if s < 0.5}


def test_one_of_each_group_stays(steps):
    before, after = steps["jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {c for _, _, c in components_of(rows)}
    assert all(c == i for i, _, c in jaccard_components(after).collect())


def test_contaminated_go(spark, steps):
    before, after = steps["decontamination"]
    items = [(r.item_id, set()) for r in read(spark, SF, "benchmark").collect()]
    bench = {r.item_id: decontam.words(r.text) for r in read(spark, SF, "benchmark").collect()}
    windows = {tuple(w[i:i + min(13, len(w))]) for w in bench.values() for i in range(len(w) - min(13, len(w)) + 1)}
    keep = set()
    for r in before.collect():
        w, hit = decontam.words(r.text or ""), set()
        for i in range(len(w)):
            if tuple(w[i:i + 13]) in windows and len(w) - i >= 13:
                hit |= set(range(i, i + 13))
        if not hit or 20 * len(hit) < len(w):
            keep.add(r.doc_id)
    assert items and {r.doc_id for r in after.collect()} == keep


def test_secrets_are_gone(steps):
    before, after = ({r.doc_id: r for r in d.collect()} for d in steps["secret_scan"])
    assert before.keys() == after.keys()
    for i, r in before.items():
        want = secrets.redacted(r.text, secrets.find_secrets(r.text), "[{kind}]")
        assert after[i].text == want and after[i].n_chars == (len(want) if want != r.text else r.n_chars)
        assert not [s for s in secrets.find_secrets(after[i].text) if s[0] != "assign"]


def test_mix_takes_what_was_kept(steps):
    before, after = steps["source_mixing"]
    sizes = {r.doc_id: len((r.text or "").encode().split()) for r in before.collect()}
    assert {r.doc_id: r["size"] for r in after.collect()} == sizes


def test_run_equals_the_stages(spark, steps):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(P.run(spark, SF)) == key(steps["source_mixing"][1])


def test_edges_through_every_stage(spark):
    df = docs(spark, [*EDGE, (50, prose(1, 20_000)), (51, None, None, None), (52, "token = abcdefgh", None, None)], clash=True)
    for name, step in P.STAGES:
        after = step(spark, df, SF)
        empty = step(spark, docs(spark, []), SF)
        assert empty.count() == 0, name
        if name != "source_mixing":
            assert after.columns == df.columns, name
            df = stage(after, "t-edge")
    assert after.count() >= 6


def test_oracles_make_views(spark):
    from strata.llm.oracle import oracle_sql
    from strata.llm.queries import queries
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in oracle_sql().items():
        con.sql(sql).create_view(name)
        cols = con.table(name).columns
        got = queries()[name](spark, SF)
        assert sorted(got.columns) == sorted(cols)
        assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted(con.table(name).fetchall(), key=repr)
