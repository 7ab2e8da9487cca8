"""The driver contract: entry() runs; every query matches its DuckDB oracle (sf0.001)."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "event_type", "cnt", "total", "avg_value"]
    assert df.count() > 0


OWN = sorted(registry.queries())  # the llm queries have tests of their own


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, datetime) and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    duck.sql(E.oracle_sql()[name]).create_view(f"oracle_{name}")  # as the driver does
    res = duck.execute(f"SELECT * FROM oracle_{name}")
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _key(rows, cols) == _key(orows, ocols)
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_public_api():
    import strata
    for name in ("hop_metrics", "flatten_tree", "write_keys", "read_paged", "load_metrics", "rolling_metrics"):
        assert callable(getattr(strata, name))
