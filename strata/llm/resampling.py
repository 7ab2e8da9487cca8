"""Importance resampling towards a target distribution of hashed word n-grams.

A document's weight is the mean log ratio, over its words and word pairs, of the target's
and the corpus's share of the n-gram's bucket; a Gumbel draw from its id is added, and the
highest sums are drawn.

The n-grams of a batch of documents are found at once: their texts are joined with a
sentinel that no lower-cased text holds, one regex pass finds all words of the buffer,
``searchsorted`` on the documents' offsets tells whose each word is, pairs whose words are
of two documents are masked, and ``bincount`` sums up.  The CRC-32 of a pair follows from
those of its words (a CRC moves over following bytes as a linear map), so only words are
hashed.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ASCII_LOWER, annotate, record_batch, slices, stage

#: The contract's parameters (fixed values).
BUCKETS, MIN_WORDS, SHARE_PCT, SEED = 10_000, 20, 25, 7
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Lower-casing leaves no A-Z, so this byte is in no text; it is no word byte either.
SENTINEL = b"A"
_NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Text bytes per batch, and per regex pass inside a longer text.
BATCH_BYTES, PASS_BYTES = 4_000_000, 8_000_000

_POLY = 0xEDB88320
_moves: dict[int, list[np.ndarray]] = {}


def _mover(length: int) -> list[np.ndarray]:
    """Four 256-entry tables of the linear map that moves a CRC-32 over ``length`` bytes."""
    if length not in _moves:
        if length == 1:
            step = np.arange(256, dtype=np.uint32)
            for _ in range(8):
                step = np.where(step & 1, (step >> 1) ^ np.uint32(_POLY), step >> 1).astype(np.uint32)
            low = np.arange(256, dtype=np.uint32)
            _moves[1] = [step, low, low << np.uint32(8), low << np.uint32(16)]
        else:  # a map over a + b bytes is one map after the other
            a = 1 << ((length - 1).bit_length() - 1)
            first, then = _mover(a), _mover(length - a)
            _moves[length] = [_move(t, then) for t in first]
    return _moves[length]


def _move(crc: np.ndarray, t: list[np.ndarray]) -> np.ndarray:
    return t[0][crc & 255] ^ t[1][crc >> 8 & 255] ^ t[2][crc >> 16 & 255] ^ t[3][crc >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of left + right texts from their CRC-32s and the right texts' lengths in bytes."""
    out = np.empty(len(left), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            out[rows] = _move(left[rows], _mover(int(lengths[rows[0]]))) ^ right[rows]
    return out


def _passes(buffer: bytes, limit: int) -> Iterator[tuple[int, int]]:
    """``buffer`` in ranges of about ``limit`` bytes that end where no word goes on."""
    at = 0
    while at < len(buffer):
        end = min(at + limit, len(buffer))
        if end < len(buffer):
            stop = _NO_WORD.search(buffer, end)
            end = stop.start() if stop else len(buffer)
        yield at, end
        at = end


def batch_ngrams(texts: Sequence[str], n_buckets: int = BUCKETS, limit: int = PASS_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(document number, bucket, words) of all words and pairs of ``texts``, pass by pass.

    The first ``words`` entries of a pass are its words, the rest its pairs.  A pair over the end of
    a pass is found with the next one: the last word is carried over.
    """
    coded = [t.encode("utf-8", "surrogatepass").translate(ASCII_LOWER) for t in texts]
    ends = np.cumsum([len(c) + 1 for c in coded])
    buffer = SENTINEL.join(coded)
    del coded
    last: tuple | None = None
    for at, end in _passes(buffer, limit):
        found = [(m.start(), m[0]) for m in WORD.finditer(buffer, at, end)]
        if not found:
            continue
        starts = np.fromiter((s for s, _ in found), np.int64, len(found))
        crc = np.fromiter((zlib.crc32(w) for _, w in found), np.uint32, len(found))
        size = np.fromiter((len(w) for _, w in found), np.int64, len(found))
        del found
        doc = np.searchsorted(ends, starts, side="right")
        words, n = (doc, crc), len(doc)
        if last is not None:
            doc, crc, size = np.r_[last[0], doc], np.r_[last[1], crc].astype(np.uint32), np.r_[last[2], size]
        last = (doc[-1:], crc[-1:], size[-1:])
        same = np.flatnonzero(doc[:-1] == doc[1:])
        space = np.full(len(same), zlib.crc32(b" "), np.uint32)
        left = joined_crc(crc[same], space, np.ones(len(same), np.int64))
        pairs = joined_crc(left, crc[same + 1], size[same + 1])
        yield np.r_[words[0], doc[same]], np.r_[words[1], pairs].astype(np.int64) % n_buckets, n


def bucket_counts(df: DataFrame, n_buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """(bucket, n): n-grams of all texts per bucket, added up in each task before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                for _, bucket, _ in batch_ngrams(batch.column("text").to_pylist(), n_buckets):
                    total += np.bincount(bucket, minlength=n_buckets)
        held = np.flatnonzero(total)
        yield record_batch({"bucket": held, "n": total[held]}, pa.schema([("bucket", pa.int64()), ("n", pa.int64())]))

    texts = df.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def _array(counts: DataFrame, n_buckets: int) -> list[int]:
    out = [0] * n_buckets  # the driver holds n_buckets numbers, whatever the corpus
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: Sequence[int], target: Sequence[int]) -> list[int]:
    """floor(1000 ln of the ratio of the add-one shares of target and corpus) per bucket."""
    k = len(corpus)
    s_all, t_all = float(sum(corpus) + k), float(sum(target) + k)
    return [math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(corpus, target, strict=True)]


def gumbel(doc_id, seed: int = SEED) -> int:
    """The document's draw: floor(1000 x a Gumbel variate) from the hash of seed and id (a null id: empty)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def document_scores(docs: DataFrame, gains: Sequence[int], seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) per document."""
    table = np.asarray(gains, np.float64)

    def weigh(texts: list[str], ids: list) -> dict[str, list]:
        words, features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        for doc, bucket, n in batch_ngrams(texts, len(table)):
            words += np.bincount(doc[:n], minlength=len(texts))
            features += np.bincount(doc, minlength=len(texts))
            total += np.bincount(doc, table[bucket], minlength=len(texts)).astype(np.int64)  # whole numbers below 2 ** 53
        weight = np.where(features > 0, total // np.maximum(features, 1), 0).tolist()
        return {"n_words": words.tolist(), "n_features": features.tolist(), "weight": weight,
                "score": [w + gumbel(i, seed) for w, i in zip(weight, ids, strict=True)]}

    out = annotate(docs, weigh, "n_words bigint, n_features bigint, weight bigint, score bigint", inputs=[F.col("doc_id")], limit=BATCH_BYTES)
    return out.select("row.doc_id", "out.n_words", "out.n_features", "out.weight", "out.score")


def rank_draws(scores: DataFrame, share_pct: int = SHARE_PCT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scores`` with rank: 1, 2, 3... of the drawn documents by falling score, ties by id; else null.

    No task sorts all rows.  Rows are counted per score, which gives the lowest score that
    can be drawn and how many rows are above each score; rows are then ranked among those
    of their own score alone.  Scores are thousandths of logarithms, so there are at most
    some hundred thousand different ones whatever the corpus (their counts reach the
    driver), and a copied text gets another draw with every id, so it does not heap rows on a score.
    """
    spark = scores.sparkSession
    eligible = F.col("n_words") >= min_words
    held = sorted(((r[0], r[1]) for r in scores.where(eligible).groupBy("score").count().collect()), reverse=True)
    k = share_pct * sum(n for _, n in held) // 100
    above, tops = 0, []
    for score, n in held:
        if above >= k:
            break
        tops.append((score, above))
        above += n
    offsets = spark.createDataFrame(tops, "at bigint, above bigint")
    cut = tops[-1][0] if tops else None
    in_reach = eligible & (F.col("score") >= F.lit(cut).cast("bigint"))
    rank = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features"))
    drawn = scores.where(in_reach).join(offsets, F.col("score") == F.col("at")).withColumn("rank", rank)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank"))).drop("at", "above")
    rest = scores.where(~F.coalesce(in_reach, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, share_pct: int = SHARE_PCT, seed: int = SEED, n_buckets: int = BUCKETS) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (null: not drawn); n_words besides.

    Null and empty texts have no features, weight 0, and too few words to be drawn.  Every
    row counts, repeated ones too; ids may be null (after all numbers) or repeated; texts of any length are counted
    whole, in passes of bounded size; an empty table draws nothing, an empty target counts as uniform.
    Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    gains = bucket_gains(_array(bucket_counts(docs, n_buckets), n_buckets), _array(bucket_counts(target, n_buckets), n_buckets))
    scored = stage(document_scores(docs, gains, seed), "resample-scores")
    return rank_draws(scored, share_pct).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
