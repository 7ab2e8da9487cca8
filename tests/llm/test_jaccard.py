import random

import numpy as np
import pytest

from strata.llm import jaccard as jac
from strata.llm.components import components
from strata.llm.count_tree import CountTree, needed
from strata.llm.shingles import FULL, GROUPS, K, group_counts, points, shingle_sets
from strata.session import ship_package
from tests.llm.helpers import EDGE, docs, prose


def word_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + K]) for i in range(len(w) - K + 1)) if len(w) >= K else frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    sets = [word_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids, default=None)))
    return sorted(out, key=repr)


def edited(text, changes, rnd):
    w = text.split()
    for _ in range(changes):
        w[rnd.randrange(len(w))] = f"e{rnd.randrange(10_000)}"
    return " ".join(w)


def fixture(seed=5, n=60, passage=True):
    """Unrelated texts, copies, chains of edits around the threshold, a passage most share."""
    rnd = random.Random(seed)
    shared = prose(999, 60)
    rows = []
    for g in range(n // 4):
        base = prose(g, rnd.randrange(8, 150), 3000) + (" " + shared if passage and g % 2 else "")
        text = base
        for _ in range(4):
            rows.append(text)
            text = rnd.choice([base, edited(text, rnd.choice([1, 1, 2, 3]), rnd), edited(base, 2, rnd), base.upper()])
    rnd.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.fixture(scope="module")
def ready(spark):
    ship_package(spark)
    return spark


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_all_pairs(ready):
    rows = fixture() + [*EDGE, (900, "a b c d"), (901, "A b\tC d"), (902, "a b c"), (903, prose(3, 8000)), (904, prose(3, 7990) + " tail" * 8)]
    base = prose(77, 50).split()  # a chain whose middle link has no id
    rows += [(910, " ".join(base)), (None, " ".join(base[2:])), (911, " ".join(base[5:]))]
    assert result(jac.jaccard_components(docs(ready, rows, clash=True))) == brute(rows)


def test_second_pass_alone_finds_everything(ready, monkeypatch):
    """Without the first pass, in blocks of 4 and trees from 3 rows on, nothing is lost."""
    monkeypatch.setattr(jac, "BLOCK", 4)
    monkeypatch.setattr(jac, "FEW", 2)
    first = jac.first_pairs
    monkeypatch.setattr(jac, "first_pairs", lambda nodes: first(nodes).where("false"))
    rows = fixture(8, 48)
    assert result(jac.jaccard_components(docs(ready, rows))) == brute(rows)


def test_tree_equals_scan():
    rnd = np.random.default_rng(1)
    vectors = rnd.poisson(rnd.integers(1, 12, 700)[:, None], (700, 64)).astype(np.int64)
    vectors[350:] = np.maximum(vectors[:350] + rnd.integers(-1, 2, (350, 64)) * (rnd.random((350, 64)) < 0.2), 0)
    sizes, labels = vectors.sum(1), rnd.integers(0, 200, 700)
    q, p = CountTree(vectors, sizes, labels).search(vectors, sizes, labels)
    bound = np.minimum(vectors[:, None], vectors[None]).sum(2)
    ok = (bound >= needed(sizes[:, None], sizes[None])) & (labels[:, None] != labels[None])
    ok &= (5 * sizes[:, None] >= 4 * sizes[None]) & (5 * sizes[None] >= 4 * sizes[:, None])
    assert set(zip(q.tolist(), p.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(ok)))) and len(q) > 300


def test_needed_is_the_threshold():
    for a in range(1, 60):
        for b in range(1, 60):
            least = next(i for i in range(200) if 100 * i >= 80 * (a + b - i))
            assert needed(np.array([a]), np.array([b]))[0] == least


def test_counts_bound_the_overlap():
    sets = shingle_sets([t for _, t in fixture(3, 24)])
    for a in sets:
        for b in sets:
            assert len(np.intersect1d(a, b)) <= np.minimum(*points([group_counts(a).tobytes(), group_counts(b).tobytes()])).sum()
    many = np.arange(GROUPS * FULL * 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert np.minimum(*points([group_counts(many).tobytes()] * 2)).sum() >= len(many)  # full counts bound nothing
    assert [len(s) for s in sets] == [len(word_set(t)) for _, t in fixture(3, 24)]


def test_components_of_chains_and_hubs(ready):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (9, 8), (8, 9)]
    rnd.shuffle(links)
    got = dict(components(ready.createDataFrame(links, "a bigint, b bigint")).collect())
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 500 for i in range(500, 540)) and got[9] == 8 and 7 not in got
    assert components(ready.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_keep_one_each(ready):
    text = prose(1, 50)
    rows = [(3, text), (2, text.upper()), (8, edited(text, 1, random.Random(1))), (4, prose(2, 50)), (5, None), (6, ""), (None, text), (7, "short")]
    df = docs(ready, rows, clash=True)
    kept = jac.keep_one_each(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 4, 5, 6, 7, None], key=repr)
    assert jac.keep_one_each(docs(ready, [])).count() == 0
    assert sorted(map(tuple, jac.jaccard_components(docs(ready, [(1, None), (2, " ")])).collect())) == [(1, 0, 1), (2, 0, 2)]


def all_links(rows):
    """{(place, place)} of linked rows, by comparing all pairs."""
    sets = [word_set(t) for _, t in rows]
    return {(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and sets[a] and sets[b]
            and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("nodes, shingles", [(2048, 2_000_000), (3, 2_000_000), (2048, 400)])
def test_every_link_is_counted(ready, monkeypatch, nodes, shingles):
    """A group of 30 near copies, whose first pass pairs few of them; also in small blocks."""
    monkeypatch.setattr(jac, "LINK_NODES", nodes)
    monkeypatch.setattr(jac, "LINK_SHINGLES", shingles)
    rnd, base = random.Random(4), prose(41, 120, 5000)
    texts = [edited(base, 1, rnd) for _ in range(30)] + [" ".join(base.split()[:k]) for k in (119, 112, 104, 97, 92, 88, 80)]
    rows = [*fixture(6, 24), *enumerate([*texts, texts[0], texts[0].upper(), texts[3]], 500), (1, None), (2, " "), (None, texts[5])]
    links = all_links(rows)
    df = docs(ready, rows, clash=True)
    want = sorted(((i, n, c) for i, n, c in brute(rows)), key=repr)
    got = jac.jaccard_result(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    out = got.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr) == want
    per = sorted(((rows[a][0], sum(x == a for x, _ in links)) for a in range(len(rows))), key=repr)
    assert sorted(((r.doc_id, r.n_links) for r in out), key=repr) == per

    sets = {frozenset((word_set(rows[a][1]), word_set(rows[b][1]))) for a, b in links}
    pairs = jac.jaccard_links(df).collect()
    assert len(pairs) == len({(r.a, r.b) for r in pairs}) == sum(len(s) == 2 for s in sets) and all(r.a < r.b for r in pairs)
    assert 2 * sum(r.copies_a * r.copies_b for r in pairs) == sum(word_set(rows[a][1]) != word_set(rows[b][1]) for a, b in links)
    text = dict(rows)
    assert all(frozenset((word_set(text[r.doc_a]), word_set(text[r.doc_b]))) in sets for r in pairs if None not in (r.doc_a, r.doc_b))


def test_sets_are_read_by_one_python_function(spark, monkeypatch):
    """Two in a row would keep two Python workers for every task of an executor."""
    ship_package(spark)
    plans, stage = [], jac.stage

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(jac, "stage", kept)
    texts = [(i, prose(i // 2, 60) + f" end{i}") for i in range(8)]
    out = jac.jaccard_components(docs(spark, texts)).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(i, i - i % 2) for i in range(8)]
    read = [plan for name, plan in plans if name == "jaccard-sets"]
    assert len(read) == 2 and all(plan.count("MapInArrow") == 1 for plan in read)
