"""Toxicity of restored text: a noisy channel undone by Viterbi, then a linear model.

1. ``char_model``: trigram counts of letters over all documents, summed per task and then
   per trigram (at most ``N_SYMBOLS`` ** 3 rows), give a character language model.
2. ``Restorer`` decodes suspicious tokens (digits and signs between letters, letters
   repeated three times or more, single letters set apart): a lattice offers for each
   run of equal signs the letters it may stand for, once or twice, or nothing; Viterbi
   takes the path the channel and the language model like best.
3. ``fit`` selects word, prefix and letter-four-gram features that labelled toxic
   documents have more often than clean ones and weighs them by logistic regression on
   a bounded sample of labelled rows (``MAX_TOXIC``, ``MAX_CLEAN``).
4. ``score_documents`` scores every whole text.  A worker keeps the features of tokens
   it has met, so a token is decoded once and then looked up.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import annotate, record_batch, stage

# What a sign may stand for; signs that may stand for nothing; any letter.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c",
}
NOTHING = "._-~'`^#%&"
ANY_LETTER = "*?"
# Costs of the channel in nats.
COST_LEET, COST_DROP, COST_ANY, COST_REPEAT, COST_HALVED, COST_GAP = 1.0, 1.0, 3.0, 0.7, 2.5, 2.5

#: Letters of the language model: a-z and the lower-case letters of Latin-1; 0 is the word boundary.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SYMBOL = {c: i + 1 for i, c in enumerate(LETTERS)}
N_SYMBOLS = len(LETTERS) + 1
#: The most signs of a token that is decoded, a repeated sign being one: longer ones are first parted at
#: their signs, and parts that are longer still are keys and the like.
MAX_TOKEN = 40
#: Signs after which a long run's best reading so far is settled, and readings that go on from there at most.
PART, BEAM = 160, 16
#: Letters of the longest word that gives letter four-grams.
MAX_LETTERS = 10_000

#: Bound of the labelled sample the classifier is fitted on, and of its features.
MAX_TOXIC, MAX_CLEAN, MAX_FEATURES = 3000, 6000, 20_000
#: A feature counts if this many standard deviations more toxic documents have it than its
#: share of the clean ones lets expect, that many times as often, and if at least so many toxic texts
#: have it that are no near copies of one another, however many rows the sample has.
MIN_DEVIATIONS, MIN_RATIO, MIN_TEXTS = 4.0, 4.0, 6
RIDGE = 0.02
#: Tokens a task remembers, and their characters.
MEMORY, MEMORY_CHARS = 300_000, 4_000_000

_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_](?:[ ._-]| \. )){3,}[^\W_](?![^\W_])")
_REPEAT = re.compile(r"([^\W\d_])\1\1")
_SIGN_IN_WORD = re.compile(r"[^\W\d_][^\W\d_]*[0-9@$!|+(<€£¢*?._~'`^#%&-]+[^\W\d_]|^[0-9@$!|+(<€£¢*?]+[^\W\d_]{2}|[^\W\d_]{2}[0-9$@|+€]{1,2}$")
_WORD = re.compile(r"[^\W\d_]+")
_BETWEEN = re.compile(r"[-_/\\.,:;&=?#%~+|]+")
_EDGE = ".,;:\"'()[]{}<>%&#*|-_/\\"


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x10000, dtype=np.int64)
    for c, i in SYMBOL.items():
        table[ord(c)] = i
        if len(c.upper()) == 1 and ord(c.upper()) < 0x10000:
            table[ord(c.upper())] = i
    return table


def char_counts(df: DataFrame, text: str) -> DataFrame:
    """(gram, n): trigrams of symbols over all texts; a code above U+FFFF is a boundary."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _symbol_table(), np.zeros(N_SYMBOLS ** 3, dtype=np.int64)
        for batch in it:
            for t in batch.column(0).to_pylist():
                codes = np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                for at in range(0, len(codes), 1 << 20):  # the last two symbols of a part open the next
                    part = codes[max(0, at - 2):at + (1 << 20)]
                    s = table[np.where(part < 0x10000, part, 0)]
                    if at == 0:
                        s = np.concatenate(([0, 0], s))
                    if at + (1 << 20) >= len(codes):
                        s = np.append(s, 0)
                    gram = (s[:-2] * N_SYMBOLS + s[1:-1]) * N_SYMBOLS + s[2:]
                    total += np.bincount(gram, minlength=len(total))
        found = np.flatnonzero(total)
        yield record_batch({"gram": found, "n": total[found]}, pa.schema([("gram", pa.int64()), ("n", pa.int64())]))

    grams = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "gram bigint, n bigint")
    return grams.groupBy("gram").agg(F.sum("n").alias("n"))


def char_model(df: DataFrame, text: str = "text") -> np.ndarray:
    """log P(c | a, b) as an array [a, b, c]; at most N_SYMBOLS ** 3 counts are collected."""
    n = np.zeros(N_SYMBOLS ** 3)
    for gram, count in char_counts(df, text).collect():
        n[gram] = count
    n = n.reshape(N_SYMBOLS, N_SYMBOLS, N_SYMBOLS)
    one = n.sum((0, 1)) + 1.0
    one /= one.sum()
    two = n.sum(0)
    two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    three = (n + 5 * two) / (n.sum(2, keepdims=True) + 5)
    return np.log(three).astype(np.float32)


class Restorer:
    """Viterbi decoding of suspicious tokens under the character model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def readings(self, sign: str, run: int) -> list[tuple[str, float]]:
        """What ``run`` equal signs may stand for, with the channel's cost."""
        out: list[tuple[str, float]] = []
        if sign in SYMBOL or sign.isalpha():  # a letter the model has no symbol for stands for itself
            out.append((sign, 0.0 if run == 1 else COST_HALVED if run == 2 else COST_REPEAT))
            if run > 1:
                out.append((sign * 2, 0.0 if run == 2 else COST_REPEAT))
        for letter in STANDS_FOR.get(sign, ""):
            out.append((letter, COST_LEET + COST_HALVED * (run == 2)))
            out += [(letter * 2, COST_LEET)] * (run > 1)
        if sign in ANY_LETTER:
            out += [(c * 1, COST_ANY * run) for c in "aeioubcdfghklmnprstuwy"] if run == 1 else []
            out.append(("", COST_DROP))
        if sign in NOTHING or sign in "!|+(<":
            out.append(("", COST_DROP))
        return out or [(" ", COST_DROP)]

    def decode(self, token: str, gaps: bool = False) -> str:
        """The best reading of ``token``; ``gaps`` allows word boundaries anywhere.

        Tokens of any length: after every PART signs the best reading so far is settled, and
        the next part opens in the states it may have ended in."""
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        model = self.model
        settled: list[str] = []
        for at, (sign, same) in enumerate(groupby(token), 1):
            options = self.readings(sign, len(list(same)))
            if gaps:
                options = options + [(" " + o, c + COST_GAP) for o, c in options if o.strip()]
            nxt: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, so_far) in paths.items():
                for out, cost in options:
                    p, q, s = a, b, score - cost
                    for c in out:
                        r = SYMBOL.get(c, 0)
                        s += model[p][q][r]
                        p, q = q, r
                    if (p, q) not in nxt or s > nxt[p, q][0]:
                        nxt[p, q] = (s, so_far + out)
            paths = nxt
            if at > PART and len(paths) > BEAM:
                paths = dict(sorted(paths.items(), key=lambda p: -p[1][0])[:BEAM])
            if at % PART == 0:
                state, (_, text) = max(paths.items(), key=lambda p: p[1])
                settled.append(text)
                paths = {state: (0.0, "")}
        return "".join(settled) + max((s + model[a][b][0], text) for (a, b), (s, text) in paths.items())[1]

    def token(self, token: str) -> str:
        """A token as it is, and its restored reading if it looks disguised."""
        word = token.strip(_EDGE).lower()
        if word.isalpha() and not _REPEAT.search(word):
            return word
        if not _SIGN_IN_WORD.search(word):
            word = word.strip(_EDGE + "$!?@+€£¢")
        if len(word) < 3:
            return word
        if len(word) > MAX_TOKEN and sum(1 for _ in groupby(word)) > MAX_TOKEN:
            parts = [p for p in _BETWEEN.split(word) if p]
            return " ".join(map(self.token, parts)) if len(parts) > 1 else word
        letters = sum(c.isalpha() for c in word)
        if not (_REPEAT.search(word) or _SIGN_IN_WORD.search(word)) or 2 * letters < len(set(word)) or letters < 2:
            return word
        return self.decode(word)

    def text(self, text: str) -> str:
        """The whole text restored: spaced letters first, then token by token."""
        return " ".join(map(self.token, self.join_spaced(text).split()))

    def join_spaced(self, text: str) -> str:
        return _SPACED.sub(lambda m: self.spaced(m[0]), text)

    def spaced(self, run: str) -> str:
        letters = "".join(c for c in run.lower() if c.isalnum())
        if letters.isdigit():
            return run
        return self.decode(letters, gaps=True)


def features(word: str) -> Iterator[str]:
    """Features of one restored word: itself, its prefixes, its letter four-grams."""
    yield "w:" + word
    for n in (4, 5, 6):
        if len(word) > n:
            yield "p:" + word[:n]
    if 4 <= len(word) <= MAX_LETTERS:
        for i in range(len(word) - 3):
            yield word[i:i + 4]


def token_features(restorer: Restorer, token: str) -> set[str]:
    return {f for w in _WORD.findall(restorer.token(token)) for f in features(w)}


def doc_tokens(restorer: Restorer, text: str) -> set[str]:
    return set(restorer.join_spaced(text).split())


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text mod 5 is 0 (a null id counts as empty text: held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, text: str, id_col: str) -> DataFrame:
    """(doc_id, toxic, text) of a bounded sample of labelled rows outside the held-out fold.

    The rows with the smallest hash of their id, up to MAX_TOXIC and MAX_CLEAN; rows
    with null labels are none, an id labelled twice is toxic if either row says so.
    """
    known = (labels.select(F.col("doc_id").alias("label_id"), "toxic").dropna().where(~held_out(F.col("label_id")))
             .groupBy("label_id").agg(F.max("toxic").alias("toxic")))
    rank = F.xxhash64("label_id")
    chosen = (known.where("toxic = 1").orderBy(rank, "label_id").limit(MAX_TOXIC)
              .unionByName(known.where("toxic = 0").orderBy(rank, "label_id").limit(MAX_CLEAN)))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    # at most MAX_TOXIC + MAX_CLEAN short rows: small enough to broadcast at any size
    return stage(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "toxic", "text"), "toxic-train")


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One of each group of near copies among ``rows`` (of a bounded sample): rows whose least hash of
    three words in a row is the same, which near copies mostly share and other texts don't."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    least = F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 2, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 3))))
    return rows.withColumn("words", words).withColumn("least", least).dropDuplicates(["toxic", "least"]).drop("words", "least")


def fit(rows: DataFrame, restorer: Restorer) -> tuple[dict[str, int], np.ndarray, float]:
    """(feature -> place, weights, bias) of the logistic regression."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        cache: dict[str, set[str]] = {}
        for batch in it:
            for toxic, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own: set[str] = set()
                for token in doc_tokens(restorer, t or ""):
                    if token not in cache:
                        cache[token] = token_features(restorer, token)
                    own |= cache[token]
                seen[toxic == 1].update(own)
                if len(cache) > MEMORY // 10:
                    cache.clear()
        keys = list(seen[0].keys() | seen[1].keys())
        yield record_batch({"feature": keys, "clean": [seen[0][k] for k in keys], "toxic": [seen[1][k] for k in keys]},
                           pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))

    sizes = {bool(t): n for t, n in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    texts = stage(distinct_texts(rows), "toxic-texts")
    sizes = {bool(t): n for t, n in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    counted = (texts.select("toxic", "text").mapInArrow(count, "feature string, clean bigint, toxic bigint")
               .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    ratio = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    expected = (F.col("clean") + 0.5) / (n_clean + 1) * (n_toxic + 1)
    surprising = F.col("toxic") >= F.greatest(expected + MIN_DEVIATIONS * F.sqrt(expected + 1), F.lit(float(MIN_TEXTS)))
    chosen = (counted.where(surprising & (ratio >= MIN_RATIO))
              .orderBy((F.col("toxic") * F.log(ratio)).desc(), "feature").limit(MAX_FEATURES).collect())
    place = {r["feature"]: i for i, r in enumerate(chosen)}
    if not place or not n_toxic or not n_clean:
        return {}, np.zeros(0), prior

    picked = annotate(rows, lambda texts: {"f": featured(texts, restorer, place, {})}, "f array<int>", carry=["toxic"])
    data = picked.select("row.toxic", "out.f").collect()  # a bounded sample of short lists
    y = np.array([r[0] == 1 for r in data], dtype=float)
    n_toxic, n_clean = int(y.sum()), int(len(y) - y.sum())
    doc = np.repeat(np.arange(len(data)), [len(r[1]) for r in data])
    feat = np.array([i for r in data for i in r[1]], dtype=np.int64)
    w, bias = np.zeros(len(place)), prior
    scale = 1.0 / np.sqrt(np.bincount(feat, minlength=len(place)) + 1.0)
    for step in range(300):
        z = np.clip(bias + np.bincount(doc, weights=w[feat], minlength=len(y)), -30, 30)
        error = 1 / (1 + np.exp(-z)) - y
        error *= np.where(y == 1, 0.5 / n_toxic, 0.5 / n_clean) * len(y)  # both classes weigh the same
        grad = np.bincount(feat, weights=error[doc], minlength=len(place)) + RIDGE * w
        rate = 0.5 if step < 200 else 0.2
        w -= rate * scale * np.clip(grad * scale, -5, 5)
        bias -= rate * error.mean()
    return place, w, float(bias)


def featured(texts: list[str], restorer: Restorer, place: dict[str, int], cache: dict[str, tuple[int, ...]]) -> list[list[int]]:
    """The places of the selected features each text has; ``cache`` is the task's own and bounded."""
    out, chars = [], 0
    for t in texts:
        own: set[int] = set()
        for token in doc_tokens(restorer, t):
            got = cache.get(token)
            if got is None:
                got = cache[token] = tuple(place[f] for f in token_features(restorer, token) if f in place)
                chars += len(token)
            if got:
                own.update(got)
        if len(cache) > MEMORY or chars > MEMORY_CHARS:
            cache.clear()
            chars = 0
        out.append(sorted(own))
    return out


class Scorer:
    """The trained model as the workers use it."""

    def __init__(self, restorer: Restorer, place: dict[str, int], weights: np.ndarray, bias: float):
        self.restorer, self.place, self.weights, self.bias = restorer, place, weights, bias

    def scores(self, texts: list[str], cache: dict[str, tuple[int, ...]] | None = None) -> list[float]:
        cache = {} if cache is None else cache
        z = [self.bias + float(self.weights[f].sum()) for f in featured(texts, self.restorer, self.place, cache)]
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z]


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> Scorer:
    """Character model from all of ``docs``, classifier from the bounded labelled sample.

    Without toxic or without clean labelled rows the classifier is the prior alone.
    """
    restorer = Restorer(char_model(docs, text))
    return Scorer(restorer, *fit(training_rows(docs, labels, text, id_col), restorer))


def score_documents(docs: DataFrame, scorer: Scorer, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(row, out): ``row`` holds the ``carry`` columns, ``out.score`` is in 0 to 1.

    Null and empty texts get the score of a text without features; ids play no part;
    texts of any length are scored whole; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # at most MAX_FEATURES and N_SYMBOLS ** 3 numbers
    cache: dict[str, tuple[int, ...]] = {}  # each task gets an empty one and leaves nothing in its worker
    return annotate(docs, lambda texts: {"score": shared.value.scores(texts, cache)}, "score double", text, carry)


def toxicity_result(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = score_documents(docs, train(docs, labels))
    return out.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "out.score",
                      (F.col("out.score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows scored 0.5 or more; columns and their order stay."""
    out = score_documents(docs, train(docs, labels, text, id_col), text, tuple(docs.columns))
    return out.where("out.score < 0.5").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
