"""Token counts: Arrow batches in, lengths out (no token ids leave the encoder's batch).

A text is cut at safe boundaries: a single space between two characters that are
neither a space nor U+2581 (the model's own space mark).  No piece of the model holds
the mark behind another character, so no merge crosses such a space, and the cut-off
part gets the same mark as dummy prefix that the space would have given.  The parts of
a batch are encoded once per distinct part and the lengths added up per document; an
encoder call gets parts of about ``CALL_CHARS``, so calls cost alike whatever the
mixture of short and long texts.  A run without a safe boundary stays whole.
"""

from __future__ import annotations

import re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import annotate

#: Text bytes per batch, and characters per call of the encoder.
BATCH_BYTES = 4_000_000
CALL_CHARS = 256_000

MARK = "▁"
_CUT = re.compile(f"(?<=[^ {MARK}]) (?=[^ {MARK}])")

_models: dict[str, object] = {}


def model(path: str):
    """The sentencepiece model of this worker (loaded once per process)."""
    if path not in _models:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError(f"{path}: a piece holds the space mark behind another character; no cut is safe")
        _models[path] = sp
    return _models[path]


def safe_parts(text: str) -> list[str]:
    """``text`` cut at its safe boundaries; the parts' token counts add up to the text's."""
    if not text:
        return []
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return _CUT.split(text)
    return text.split(" ")


def lengths(sp, parts: list[str]) -> list[int]:
    """Token counts of ``parts``, encoded in calls of about ``CALL_CHARS``."""
    out, call, size = [], [], 0
    for p in parts:
        call.append(p)
        size += len(p)
        if size >= CALL_CHARS:
            out += map(len, sp.encode(call, num_threads=1))
            call, size = [], 0
    if call:
        out += map(len, sp.encode(call, num_threads=1))
    return out


def token_counts(df: DataFrame, model_path: str, text: str = "text", id_col: str = "doc_id",
                 limit: int = 4096) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens; ids may be null or repeated (one
    result row per input row); texts of any length are counted whole; an empty table
    gives no rows; other columns of ``df`` are not read.
    """

    def count(texts: list[str]) -> dict[str, list]:
        cut = [safe_parts(t) for t in texts]
        distinct = list(dict.fromkeys(p for parts in cut for p in parts))
        n = dict(zip(distinct, lengths(model(model_path), distinct), strict=True))
        return {"n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": [sum(map(n.__getitem__, parts)) for parts in cut]}

    out = annotate(df, count, "n_bytes bigint, n_tokens bigint", text, [id_col], limit=BATCH_BYTES)
    return out.select(F.col("row")[id_col].alias("doc_id"), "out.n_bytes", "out.n_tokens",
                      (F.col("out.n_tokens") > limit).alias("over_limit"))
