import base64
import json
import re
import time
import zlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import secrets
from strata.llm.queries import op5_secret_scan, op9_token_counts, tokenizer_path
from strata.llm.tokens import lengths, model, safe_parts, token_counts
from tests.llm.helpers import EDGE, docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


@given(st.text(alphabet=st.sampled_from(list("ab. \n\t▁é<s>0中\x00")), max_size=40))
@settings(max_examples=400, deadline=None)
def test_parts_add_up(text):
    m = model(tokenizer_path())
    assert sum(lengths(m, safe_parts(text))) == len(m.encode(text))


def test_query_equals_library(spark, sp):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_token_edges(spark, sp):
    long = "abc " * 40_000 + "x" * 5000
    out = token_counts(docs(spark, [*EDGE, (9, long)], clash=True), tokenizer_path()).collect()
    assert len(out) == len(EDGE) + 1
    by = {r.doc_id: r for r in out}
    assert by[1].n_tokens == by[2].n_tokens == 0 and by[1].n_bytes == 0
    assert by[9].n_tokens == len(sp.encode(long)) and by[9].over_limit
    assert token_counts(docs(spark, []), tokenizer_path()).count() == 0


# The contract's expressions, run over the whole text as they stand.
PLAIN = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def plain(text):
    return {(k, *m.span()) for k, (p, ok) in PLAIN.items() for m in re.finditer(p, text) if ok(m)}


PIECES = st.sampled_from(["password", "PASSWD", "Secret", "token", "api_key", "apiKey", "AKIA", "akia", "=", ":", " ", "\"", "'", "abc123", "ABCDEF0123456789ABCD",
                          "0123456789abcdef", "deadbeef", "DEAD", "g", "é", "ſecret", "İ", "\n", "==", "secretoken", "x"])


@given(st.lists(PIECES, max_size=14).map("".join))
@settings(max_examples=800, deadline=None)
def test_base_spans_equal_plain_expressions(text):
    assert {s for s in secrets.find_secrets(text) if s[0] in PLAIN} == plain(text)


def test_checksums():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    crc, tail = zlib.crc32(body.encode()), ""
    for _ in range(6):
        crc, d = divmod(crc, 62)
        tail = secrets.BASE62[d] + tail
    good, bad = f"ghp_{body}{tail}", f"ghp_{body}{'0' * 6 if tail != '0' * 6 else '1' * 6}"
    assert [s[0] for s in secrets.find_secrets(f"x {good} y")] == ["github"]
    assert secrets.find_secrets(f"x {bad} y") == []
    assert [s[0] for s in secrets.find_secrets("IBAN: GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert secrets.find_secrets("IBAN: GB83 WEST 1234 5698 7654 32.") == []
    assert [s[0] for s in secrets.find_secrets("card 4111 1111 1111 1111")] == ["card"]
    assert secrets.find_secrets("card 4111 1111 1111 1112") == []


def b64(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def plain_jwt(text):
    """The tokens as one expression and a whole parse of each header find them."""
    out, at = [], 0
    while (m := re.compile(r"eyJ([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*").search(text, at)) is not None:
        raw, at = "eyJ" + m[1], m.start() + 1
        try:
            head = json.loads(base64.urlsafe_b64decode(raw + "=" * (-len(raw) % 4)))
        except ValueError:
            continue
        if isinstance(head, dict) and "alg" in head:
            out.append(("jwt", *m.span()))
            at = m.end()
    return out


HEADERS = [b64('{"alg":"HS256","typ":"JWT"}'), b64('{"typ":"é","alg":"none"} '), b64('{"kid":"x"}'), b64('{"alg":1}{'), b64('{"a":{"alg":2}}'), b64('{"":"","alg":0}')]


@given(st.lists(st.sampled_from([*HEADERS, "eyJ", "ey", "J", ".", ".", "a", "-_", "abcd", " ", "x.y.z", "é"]), max_size=10).map("".join))
@settings(max_examples=1500, deadline=None)
def test_tokens_equal_the_plain_search(text):
    assert [s for s in secrets.find_secrets(text) if s[0] == "jwt"] == plain_jwt(text)


def test_hostile_runs_are_linear_and_harmless():
    began = time.perf_counter()
    nested = b64('{"a":' * 100_000)
    for text in ("eyJ" * 350_000, "eyJ" * 350_000 + ".a.b", nested + ".a.b", f"{HEADERS[0]}.{'eyJ' * 300_000}.z",
                 "iban" + " " * 300_000, "card" + " " * 300_000, "visa number" + " " * 300_000, "password" * 100_000, "token" + " " * 300_000):
        secrets.find_secrets(text)
    assert time.perf_counter() - began < 20
    assert secrets.find_secrets(f"x {nested}.a.b {HEADERS[0]}.p.s")[-1][0] == "jwt"


def test_scan_query(spark):
    import hashlib
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_secret_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sorted(plain(texts[r.doc_id]), key=lambda s: (s[1], secrets.KINDS.index(s[0])))
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in want) for k in ("assign", "access", "hex"))
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


def test_secret_edges_and_redaction(spark):
    rows = [*EDGE, (9, "é" * 100_000 + " token = abcdef123")]
    df = docs(spark, rows, clash=True)
    found = secrets.scan_secrets(df).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in found}[9] == [("assign", 100_001, 100_018)]
    clean = secrets.redact(df, length="n_chars")
    assert clean.columns == df.columns and clean.schema.simpleString() == df.schema.simpleString()
    by = {r.doc_id: r for r in clean.collect()}
    assert by[1].text is None and by[9].text.endswith(" [assign]") and by[9].n_chars == len(by[9].text) and by[4].text == "one"
    assert secrets.redact(docs(spark, [])).count() == 0
