"""Secret scan: Aho-Corasick prefilter, anchored expressions at the hits, checksums.

One automaton holds every keyword (assignment words, token prefixes, key headers) and
all four-digit hexadecimal strings; it passes over the lower-cased text once.  Only at
a hit is an anchored expression tried, left to right, skipping what an earlier match of
that kind has consumed, which gives the leftmost non-overlapping matches of the plain
expression without running it over the text.

Base kinds: ``assign``, ``access``, ``hex``.  Added kinds, kept only if an embedded
checksum or structure holds: ``github`` and ``npm`` (six base-62 digits of CRC-32),
``jwt`` (base64url JSON header naming an algorithm), ``iban`` (mod 97), ``card`` (Luhn,
after a card keyword).
"""

from __future__ import annotations

import base64
import json
import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import annotate

# Kinds in listing order; keywords, expressions and least lengths.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "iban", "card")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
KEYWORDS = {w: "assign" for w in ASSIGN_WORDS} | {
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "iban": "iban", "card": "card", "visa": "card", "mastercard": "card",
}
ANCHORED = {
    "assign": re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                         r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"[A-Za-z0-9_-]{4,}+"),
    "iban": re.compile(r"[Ii][Bb][Aa][Nn]\x20*+[:=]?\x20*+([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Z0-9])"),
    "card": re.compile(r"(?:[Cc][Aa][Rr][Dd]|[Vv][Ii][Ss][Aa])(?:\x20?(?:number|no\.?))?+\x20*+[:=#]?\x20*+([0-9](?:[\x20-]?[0-9]){12,18})(?![0-9])"),
}
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS = "spans array<struct<kind:string,start:int,end:int>>"


def crc62_ok(token: str) -> bool:
    """The last six digits are the CRC-32 of the others, in base 62."""
    body, tail, crc, digits = token[:-6], token[-6:], zlib.crc32(token[:-6].encode()), ""
    for _ in range(6):
        crc, d = divmod(crc, 62)
        digits = BASE62[d] + digits
    return bool(body) and digits == tail


class JwtRun:
    """A run of base64url characters of a text, in which several headers may begin.

    The run, what follows it, and its bytes at each of the four offsets are worked out once,
    however many places in it look like a header; a header is parsed from its own place,
    up to the first thing that is no JSON.  So a run is linear work, not square.
    """

    TAIL = re.compile(r"\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
    PARSER = json.JSONDecoder()

    def __init__(self, text: str, start: int, end: int):
        self.start, self.end = start, end
        tail = self.TAIL.match(text, end)
        self.tail_end = tail.end() if tail else None  # no header of this run can be a token without it
        self.run = text[start:end]
        self.bodies: dict[int, str] = {}

    def header(self, at: int) -> bool:
        """Whether the run's rest from ``at`` is a JSON object that names its algorithm."""
        whole, offset = divmod(at - self.start, 4)
        if offset not in self.bodies:
            rest = self.run[offset:]
            if len(rest) % 4 == 1:  # no base64 text has this length, from any place of this offset
                self.bodies[offset] = ""
            else:  # a byte a character: only the parsed header must be UTF-8
                self.bodies[offset] = base64.urlsafe_b64decode(rest + "=" * (-len(rest) % 4)).decode("latin-1").rstrip(" \t\n\r")
        body = self.bodies[offset]
        if not body.endswith("}"):
            return False
        try:
            head, stop = self.PARSER.raw_decode(body, 3 * whole)
            return stop == len(body) and isinstance(head, dict) and "alg" in head and bool(body[3 * whole:].encode("latin-1").decode())
        except (ValueError, RecursionError):  # no JSON, or nested beyond any header
            return False


def iban_ok(value: str) -> bool:
    s = value.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def luhn_ok(value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


CHECKS = {"github": crc62_ok, "npm": crc62_ok, "iban": iban_ok, "card": luhn_ok}

_automaton = None


def automaton():
    """The worker's automaton: (kind, keyword length) per keyword."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            a.add_word(word, (kind, len(word)))
        for n in range(16 ** 4):
            a.add_word(f"{n:04x}", ("hex", 4))
        a.make_automaton()
        _automaton = a
    return _automaton


def ascii_lower(text: str) -> str:
    """A-Z only, so every code point keeps its place."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    found: list[tuple[str, int, int]] = []
    consumed = dict.fromkeys(KINDS, 0)
    run: JwtRun | None = None
    for last, (kind, width) in automaton().iter(ascii_lower(text)):
        start = last - width + 1
        if start < consumed[kind]:
            continue
        if kind == "jwt":
            if not text.startswith("eyJ", start):
                continue
            if run is None or start >= run.end:
                m = ANCHORED[kind].match(text, start)
                run = JwtRun(text, start, m.end()) if m else None
            if run is None or run.tail_end is None:
                consumed[kind] = run.end if run else start + 1
            elif run.end - start > 3 and run.header(start):
                consumed[kind] = run.tail_end
                found.append((kind, start, run.tail_end))
            continue
        m = ANCHORED[kind].match(text, start)
        if m is None:
            continue
        if kind in CHECKS:
            if not CHECKS[kind](m[1]):
                continue
            span = m.span() if kind in ("github", "npm") else m.span(1)
            keep = True
        else:
            span = m.span()
            keep = (len(m[1]) >= LEAST_ASSIGN if kind == "assign"
                    else span[1] - span[0] >= (LEAST_ACCESS if kind == "access" else LEAST_HEX))
        consumed[kind] = m.end()
        if keep:
            found.append((kind, *span))
    order = {k: i for i, k in enumerate(KINDS)}
    found.sort(key=lambda s: (s[1], order[s[0]]))
    return found


def scan_secrets(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, spans array<struct<kind, start, end>> (code points, end exclusive).

    Null and empty texts have no spans; ids may be null or repeated (one result row per
    input row); an empty table gives no rows; other columns of ``df`` are not read.
    """

    def scan(texts: list[str]) -> dict[str, list]:
        return {"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in texts]}

    out = annotate(df, scan, SPANS, text, [id_col])
    return out.select(F.col("row")[id_col].alias("doc_id"), "out.spans")


def redact(df: DataFrame, text: str = "text", mark: str = "[{kind}]", length: str | None = None) -> DataFrame:
    """``df`` with every span of ``text`` replaced by ``mark``; overlapping spans are one.

    ``length`` names a column that is set to the code points of each text that changed.
    Rows, columns and their order stay; a null text stays null.
    """
    def clean(texts: list[str]) -> dict[str, list]:
        found = map(find_secrets, texts)
        return {"text": [redacted(t, spans, mark) if spans else None for t, spans in zip(texts, found, strict=True)]}

    out = annotate(df, clean, "text string", text, df.columns)
    changed = F.col("out.text")

    def column(c: str) -> Column:
        own = F.col("row").getField(c)
        if c == text:
            return F.coalesce(changed, own)
        if c == length:
            return F.when(changed.isNotNull(), F.length(changed).cast(df.schema[c].dataType)).otherwise(own)
        return own

    return out.select(*[column(c).alias(c) for c in df.columns])


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], mark.format(kind=kind)]
        at = max(at, end)
    return "".join(parts) + text[at:] if parts else text


def secret_digest(found: DataFrame) -> DataFrame:
    """The counts and digests of the query contract, from the operator's spans."""
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
