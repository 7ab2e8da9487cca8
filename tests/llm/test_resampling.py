import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import resampling as R
from strata.llm.queries import op12_importance_resampling
from tests.llm.helpers import EDGE, docs, prose

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(t)
    return w, [zlib.crc32(g.encode()) % 10000 for g in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    scored = []
    for i, text in rows:
        w, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(w)])
    able = sorted((r for r in scored if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(able[:25 * len(able) // 100], 1):
        r[4] = rank
    return sorted(map(tuple, scored), key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in op12_importance_resampling(spark, SF).collect()), key=repr)
    assert got == brute(rows, target)


def test_edges_ties_and_repeats(spark):
    long = prose(2, 60_000, 9000)
    rows = [*EDGE, *[(i, prose(i, 30)) for i in range(20, 60)], (60, long), (61, "É" * 40 + " ß9 " * 30), (62, prose(20, 30)),
            (63, " ".join(["w1"] * 25)), (63, " ".join(["w1"] * 25)), (None, prose(3, 40))]
    target = [(1, "w1 w2 w3 W1"), (2, None), (3, "")]
    got = R.resample(docs(spark, rows, clash=True), docs(spark, target))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, [t for _, t in target])
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]


def test_empty_tables(spark):
    none = docs(spark, [])
    assert R.resample(none, docs(spark, [(1, "a b")])).count() == 0
    rows = [(i, prose(i, 25)) for i in range(8)]
    got = R.resample(docs(spark, rows), none).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, [])
    assert sorted(r.rank for r in got if r.rank) == [1, 2]


TEXT = st.text(alphabet=st.sampled_from(list("abAZ09 .\n\x00{é中A")), max_size=30)


@given(st.lists(TEXT, max_size=6), st.integers(1, 12))
@settings(max_examples=400, deadline=None)
def test_batches_and_passes_equal_single_texts(texts, limit):
    found, words = [Counter() for _ in texts], [0] * len(texts)
    for doc, bucket, n in R.batch_ngrams(texts, 10000, limit):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            found[d][b] += 1
        for d in doc[:n].tolist():
            words[d] += 1
    assert found == [Counter(features(t)[1]) for t in texts]
    assert words == [len(features(t)[0]) for t in texts]


@given(st.lists(st.tuples(st.binary(max_size=20), st.binary(min_size=1, max_size=70)), min_size=1, max_size=10))
@settings(max_examples=200, deadline=None)
def test_joined_crc(pairs):
    left, right = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    joined = R.joined_crc(left, right, np.array([len(p[1]) for p in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]
