import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import packing as K
from strata.llm.queries import PACKING_MODEL, op13_packing, tokenizer_path
from tests.llm.helpers import EDGE, docs, prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(PACKING_MODEL))


def want_ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def padding(n):
    return 0 if n & (n - 1) == 0 else 2048 - n


def check_pieces(rows, texts, library):
    """Every id of every row in one piece, sequences without gaps, no longer than 2048; the share of padding."""
    runs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        runs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(runs) == set(texts)
    for i, pieces in runs.items():
        ids = want_ids(library, texts[i])
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert sum(r.length for r in pieces) == len(ids) and all(r.doc_tokens == len(ids) and r.length > 0 for r in pieces)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    used = []
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        used.append(sum(r.length for r in pieces))
    assert max(used) <= 2048
    return sum(map(padding, used)) / sum(used)


def test_query_packs_every_id_once(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert check_pieces(op13_packing(spark, SF).collect(), texts, library) < 0.01


def test_edges(spark, library):
    long = prose(4, 120_000, 3000) + " END. " + "x" * 5000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "<|endoftext|> a<|startoftext|>b"), (6, "Σίσυφος ΣΑΣ İi ǅ é  x y \x1cz \x85q"),
            (7, long), (8, "ÇA Œuvre straße don't 'S we'LL 12.5 .,;!? ?!.\"")]
    df = docs(spark, rows, clash=True).repartition(3)
    out = K.pack_documents(df, tokenizer_path(PACKING_MODEL))
    check_pieces(out.collect(), dict(rows), library)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_null_and_repeated_ids_and_empty(spark):
    path = tokenizer_path(PACKING_MODEL)
    out = K.pack_documents(docs(spark, EDGE), path).collect()
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in out if r.start == 0)
    assert sum(r.start == 0 for r in out) == len(EDGE)
    assert K.pack_documents(docs(spark, []), path).count() == 0


def test_forgotten_parts_are_learnt_again(monkeypatch, library):
    enc = K.encoder(tokenizer_path(PACKING_MODEL))
    monkeypatch.setattr(K, "KEPT_PARTS", 5)
    for text in ("word " * 50 + "a" * 90 + " end. x", "é" * 200, " " * 100 + "q", "word, a b c d e f! q?"):
        assert K.document_ids(pa.array([text, "b", text]), enc)[2].tolist() == want_ids(library, text)


PIECES = st.sampled_from([*"abZ .,'!?<|>\n\t\x0b\x0c\r\x1c\x85\xa00é\u0301ßŒΣςİKh\u0331中 ", "<|endoftext|>", "'ll", "n't", "word"])


@given(st.lists(st.lists(PIECES, max_size=25).map("".join), max_size=4))
@settings(max_examples=500, deadline=None)
def test_ids_equal_the_library(texts):
    enc = K.encoder(tokenizer_path(PACKING_MODEL))
    assert [x.tolist() for x in K.document_ids(pa.array(texts, pa.string()), enc)] == [want_ids(enc.tokenizer, t) for t in texts]


def cost(lengths, pens, size):
    return sum(pens) + sum(K.PRICE + (0 if n & (n - 1) == 0 else size - n) for n in lengths)


@given(st.lists(st.tuples(st.integers(1, 8), st.integers(0, 30)), min_size=1, max_size=9))
@settings(max_examples=300, deadline=None)
def test_cuts_are_the_cheapest(steps):
    points = np.cumsum([0, *(s for s, _ in steps)])
    penalty = np.array([0, *(p for _, p in steps)])
    got = K.best_cuts(points, penalty, size=8)
    best = min(
        cost(np.diff(points[list(c)]), penalty[list(c)][1:], 8)
        for keep in product([0, 1], repeat=len(steps) - 1)
        for c in [[0, *(i + 1 for i, k in enumerate(keep) if k), len(steps)]]
        if np.diff(points[c]).max() <= 8)
    assert got[0] == 0 and got[-1] == len(steps) and np.diff(points[got]).max() <= 8
    assert cost(np.diff(points[got]), penalty[got][1:], 8) == best


def test_cuts_prefer_ends_of_documents_and_sentences():
    ends = np.zeros(10, bool)
    ends[9] = True
    body = np.full(1500, 5, np.uint32)
    sentence = body.copy()
    sentence[540] = 9
    pieces = list(K.pack_stream([body, sentence, body], ends))
    cuts = [(d, s) for d, s, *_ in pieces if s]
    assert (1, 541) in cuts or not cuts  # a sentence end, if a document is cut at all
    exact = list(K.pack_stream([np.full(2048, 5, np.uint32)] * 3, ends))
    assert [(d, s, n) for d, s, n, *_ in exact] == [(0, 0, 2048), (1, 0, 2048), (2, 0, 2048)]
