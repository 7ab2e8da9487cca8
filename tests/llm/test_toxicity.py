import math
import random
import zlib

import numpy as np
import pytest

from strata.llm import toxicity as tox
from strata.session import ship_package
from tests.llm.helpers import EDGE, docs

BAD = ["idiot", "moron", "stupid", "worthless"]
GOOD = "the quick brown fox jumps over a lazy dog while reading books about tiny rivers and stone bridges in quiet towns".split()


def corpus(n, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(GOOD) for _ in range(rnd.randrange(20, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(BAD)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def label_table(spark, labels):
    ship_package(spark)
    return spark.createDataFrame([(*x, 0.5) for x in labels], "doc_id bigint, quality int, toxic int, score double")


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus(400)
    df = docs(spark, rows, clash=True)
    return df, label_table(spark, labels), tox.train(df, label_table(spark, labels)), labels


def test_held_out_accuracy(spark, trained):
    df, labels, _, truth = trained
    out = {r.doc_id: r for r in tox.toxicity_result(df, labels).collect()}
    toxic = {i: t for i, _, t in truth}
    assert len(out) == 400
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [i for i, r in out.items() if r.held_out]
    assert sum(out[i].predicted == toxic[i] for i in held) / len(held) > 0.97


@pytest.mark.parametrize("text, word", [
    ("you 1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"),
    ("stuuuuupiiid", "stupid"), ("w0rthl3ss", "worthless"), ("$tupid", "stupid"), ("m-o-r-o-n", "moron"), ("id!ot", "idiot")])
def test_restores(trained, text, word):
    scorer = trained[2]
    assert word in scorer.restorer.text(text).split()
    assert scorer.scores(["the quick fox " + text])[0] > scorer.scores(["the quick fox"])[0]


@pytest.mark.parametrize("text", ["on 5 May 2020", "version 2.0.1", "a b", "1234567", "x = y", "don't", "end. Next"])
def test_plain_text_gets_no_features(trained, text):
    assert tox.featured([text], trained[2].restorer, trained[2].place, {}) == [[]]


def test_viterbi_equals_exhaustive_search(trained):
    r = trained[2].restorer
    for token in ("1d10t", "st00p", "b00ks", "l44zy", "m0r*n", "d-0-g", "qquick"):
        from itertools import groupby, product
        best = -math.inf
        for path in product(*[r.readings(c, len(list(g))) for c, g in groupby(token)]):
            text, a, b, s = "".join(o for o, _ in path), 0, 0, -sum(c for _, c in path)
            for ch in text + " ":
                x = tox.SYMBOL.get(ch, 0)
                s += r.model[a][b][x]
                a, b = b, x
            best = max(best, s)
        got, a, b, s = r.decode(token), 0, 0, 0.0
        costs = []
        for path in product(*[r.readings(c, len(list(g))) for c, g in groupby(token)]):
            if "".join(o for o, _ in path) == got:
                costs.append(sum(c for _, c in path))
        for ch in got + " ":
            x = tox.SYMBOL.get(ch, 0)
            s += r.model[a][b][x]
            a, b = b, x
        assert abs(s - min(costs) - best) < 1e-6


def test_character_counts(spark):
    text = "ab c" * 10
    out = {r.gram: r.n for r in tox.char_counts(docs(spark, [(1, text), (2, None), (3, "")]), "text").collect()}
    symbols = [0, 0, *[tox.SYMBOL.get(c, 0) for c in text], 0]
    want = {}
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        g = (a * tox.N_SYMBOLS + b) * tox.N_SYMBOLS + c
        want[g] = want.get(g, 0) + 1
    assert {g: n for g, n in out.items() if g} == {g: n for g, n in want.items() if g}


def test_edges(spark, trained):
    _, labels, scorer, _ = trained
    rows = [*EDGE, (9, "fox " * 50_000 + "idiot moron"), (10, "\U0001F600 ñ 中文 " * 10)]
    df = docs(spark, rows, clash=True)
    out = tox.score_documents(df, scorer).collect()
    assert len(out) == len(rows) and all(0 <= r.out.score <= 1 for r in out)
    by = {r.row.doc_id: r.out.score for r in out}
    assert by[1] == by[2] == by[3] < 0.5 < by[9]
    kept = tox.remove_toxic(df, labels)
    assert kept.columns == df.columns
    assert tox.score_documents(docs(spark, []), scorer).count() == 0
    assert tox.toxicity_result(docs(spark, []), labels).count() == 0


def test_no_labels_is_the_prior(spark):
    df = docs(spark, [(1, "a fox"), (2, None)])
    none = label_table(spark, [])
    assert {r.predicted for r in tox.toxicity_result(df, none).collect()} <= {0, 1}
    only = label_table(spark, [(1, 1, None), (None, 1, 1), (2, 1, 0)])
    assert [r.score < 0.5 or r.score >= 0.5 for r in tox.toxicity_result(df, only).collect()] == [True, True]


def test_model_is_a_distribution(spark):
    m = np.exp(tox.char_model(docs(spark, [(1, "hello world")])).astype(float))
    assert np.allclose(m.sum(2), 1, atol=1e-4)


def test_long_disguises_are_decoded(trained):
    scorer = trained[2]
    spaced = " ".join("the quick brown fox said you are a stupid worthless moron and reads books about tiny rivers " * 4).replace("   ", " ")
    assert sum(c.isalpha() for c in spaced) > 200
    found = "".join(scorer.restorer.text(spaced).split())
    assert "stupid" in found and "moron" in found
    assert scorer.scores([spaced])[0] > scorer.scores(["the quick brown fox"])[0]
    for stretched in ("idi" + "o" * 50 + "t", "s" * 60 + "tupid"):
        assert scorer.restorer.text(stretched) in ("idiot", "stupid", "sstupid")
    joined = "the-quick-brown-fox_jumps/over.a-lazy-dog-you-1d10t-reading-books"
    assert "idiot" in scorer.restorer.text(joined).split()
    key = "".join(random.Random(3).choices("abcdefXYZ0189", k=5000))
    assert scorer.restorer.text(key) == key.lower()  # no language: left as it is


@pytest.mark.parametrize("text, word", [("дурааак", "дурак"), ("глуууупый", "глупый"), ("głupiii", "głupi"), ("żżżaba", "żaba"), ("βλάααακας", "βλάκας")])
def test_letters_without_a_symbol_stand_for_themselves(trained, text, word):
    got = trained[2].restorer.text(text)
    assert " " not in got and set(got) == set(word) and len(got) <= len(word) + 1
    assert all(c in got for c in word)


def test_toxic_words_of_a_small_language_are_learnt(spark):
    """Eight toxic texts of one language beside hundreds of another make a feature; copies of one text don't."""
    rows, labels = corpus(800, seed=5)
    rnd = random.Random(9)
    cyrillic = "быстрая лиса читает книги о тихих реках и старых мостах в спокойном городе".split()
    for i in range(60):
        w = [rnd.choice(cyrillic) for _ in range(rnd.randrange(20, 50))]
        if i % 4 == 0:
            w[rnd.randrange(len(w))] = "дурак"
        rows.append((10_000 + i, " ".join(w)))
        labels.append((10_000 + i, 1, int(i % 4 == 0)))
    copied = " ".join(rnd.choice(cyrillic) for _ in range(40)) + " однажды"
    for i in range(30):
        rows.append((20_000 + i, copied))
        labels.append((20_000 + i, 1, 1))
    scorer = tox.train(docs(spark, rows), label_table(spark, labels))
    assert "w:дурак" in scorer.place and "w:однажды" not in scorer.place
    assert scorer.scores(["быстрая лиса дурак"])[0] > scorer.scores(["быстрая лиса"])[0]
