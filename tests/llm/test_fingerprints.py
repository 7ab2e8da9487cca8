import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import fingerprints as fp
from strata.session import ship_package
from tests.llm.helpers import docs, prose


def order(rows):
    """Distinct (id, text) in descending id order, nulls last."""
    return sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is None, -(x[0] or 0)))


def jaccard(a, b):
    x, y = (Counter(t.split() or [""]) for t in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def check(rows, out):
    seq = order(rows)
    by = {i: r for i, r in ((r.doc_id, r) for r in out)}
    errors = []
    for k, (i, t) in enumerate(seq):
        nxt, third = seq[(k + 1) % len(seq)][1], len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        r = by[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - jaccard(t, edited), r.near_next - jaccard(t, nxt)]
    return errors


@pytest.fixture(scope="module")
def ready(spark):
    ship_package(spark)
    return spark


def test_collision_rate_is_generalised_jaccard(ready):
    rnd = random.Random(3)
    rows = []
    for i in range(120):  # neighbours share a varying part, words repeat
        base = prose(i // 2, rnd.randrange(30, 120), 40)
        rows.append((i, base if i % 2 else base[:rnd.randrange(1, len(base))] + " " + prose(900 + i, rnd.randrange(1, 60), 40)))
    errors = check(rows, fp.fingerprint_documents(docs(ready, rows, clash=True)).collect())
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.5 / math.sqrt(fp.SAMPLES) + 0.01


def test_edges(ready):
    rows = [(7, "é" * 10 + " x"), (3, None), (9, ""), (4, " \n"), (None, "no id"), (1, "word " * 60_000), (2, "a b c"), (2, "a b c")]
    out = fp.fingerprint_documents(docs(ready, rows, clash=True)).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 8 * fp.SAMPLES for r in out)
    check(rows, out)
    prints = {r.doc_id: r.fingerprint for r in out}
    assert prints[3] == prints[9] == prints[4] and len({prints[i] for i in (7, 3, 1, 2)}) == 4
    twice = [tuple(r) for r in out if r.doc_id == 2]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_equal_texts_and_one_row(ready):
    rows = [(i, prose(1, 50)) for i in range(5)]
    out = fp.fingerprint_documents(docs(ready, rows)).collect()
    assert len({r.fingerprint for r in out}) == 1 and {r.near_next for r in out} == {1.0}
    one = fp.fingerprint_documents(docs(ready, [(1, "abcdef")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1.0
    assert fp.fingerprint_documents(docs(ready, [])).count() == 0


def test_no_python_in_the_plan(ready):
    df = fp.fingerprint_documents(docs(ready, [(1, "a b"), (2, "c d")]))
    text = df._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_samples_follow_the_definition(ready):
    """ln a as worked out in the plan is the one of the formulas, number by number."""
    df = ready.createDataFrame([(123456789, 0.0, math.log(3.0))], "word bigint, m double, e double").withColumn("first", F.lit(0))
    main, edited = fp.samples("word", "m", "e", F.col("first"), 4)
    hashes = [F.xxhash64(F.col("word"), F.col("first") + j) for j in range(4)]
    row = df.select(*main, *edited, *hashes, *[F.xxhash64(h) for h in hashes], *[F.xxhash64(F.xxhash64(h)) for h in hashes]).first()
    u = lambda h: h & 0xFFFFFFFFFFFFFFFF
    low, high = (lambda h: ((u(h) & 0xFFFFFFFF) + 0.5) / 2 ** 32), (lambda h: ((u(h) >> 32) + 0.5) / 2 ** 32)
    for j in range(4):
        one, two, three = row[8 + j], row[12 + j], row[16 + j]
        r, c, b = -math.log(low(one) * high(one)), -math.log(low(two) * high(two)), high(three)
        for got, weight in ((row[j], 1.0), (row[4 + j], 3.0)):
            t = math.floor(math.log(weight) / r + b)
            y = math.exp(r * (t - b))
            assert got == pytest.approx(math.log(c / (y * math.exp(r))), rel=1e-9)


def test_no_sample_is_below_its_bound(ready):
    df = ready.range(200_000).select(F.xxhash64("id").alias("word"), F.log(F.lit(1.0) + F.col("id") % 40).alias("s"))
    (a,), _ = fp.samples("word", "s", "s", F.lit(3), 1)
    low = F.log(fp.least_possible(F.xxhash64("word", F.lit(3)))) - F.col("s")
    assert df.select(a.alias("a"), low.alias("low")).where("a < low - 1e-7").isEmpty()


def test_terms_passed_over_change_nothing(ready, monkeypatch):
    """All terms or those that may win, and texts worked out again: the same fingerprints."""
    rows = [(i, prose(i // 2, 40 + 9 * i, 60)) for i in range(40)] + [(100, None), (101, "a"), (None, "b c"), (7, "other text, same id"), (3, prose(1, 49, 60))]
    texts = ready.createDataFrame([(i, i, r[1] or "", prose(500 + i, 30, 60)) for i, r in enumerate(rows)], "k bigint, h bigint, text string, edited string")
    every, some = (sorted(map(tuple, fp.signatures(texts, reach).collect())) for reach in (None, fp.REACH))
    assert every == some and all(len(r[3]) == len(r[4]) == fp.SAMPLES for r in every)
    few = [r for r in fp.signatures(texts, 4.0).collect() if r.sig]  # about a third of the texts
    assert 0 < len(few) < len(rows) and all(tuple(r)[:4] == every[r.k][:4] for r in few)
    wanted = sorted(map(str, fp.fingerprint_documents(docs(ready, rows)).collect()))
    for reach in (4.0, 0.01):
        monkeypatch.setattr(fp, "REACH", reach)
        assert sorted(map(str, fp.fingerprint_documents(docs(ready, rows)).collect())) == wanted
