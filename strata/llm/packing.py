"""Order-preserving packing: whole token streams cut into windows by dynamic programming.

The documents of a partition, in their order, are one stream of token ids.  The stream is
cut into windows of at most ``size`` ids, and every window is one sequence.  Cuts may lie
at document ends (free), at sentence ends and, inside longer sentences, at a grid of tokens; the last two cost a
truncation penalty.  A window of ``n`` ids costs its padding, ``size - n``, or nothing
when ``n`` is a power of two (such sequences are not padded), plus a small fixed price,
so that windows are not split for nothing.

For cuts at positions ``P``, the cheapest cost to end a window at cut j is

    f[j] = pen[j] + price + min( min over i, P[j] - P[i] <= size, of f[i] + size - (P[j] - P[i]),
                                 min over i, P[j] - P[i] a power of two, of f[i] ).

The first minimum runs over ``f[i] + P[i]`` in a window that only moves forward: a monotone
queue gives it in constant time per cut.  The second has at most log2(size) + 1 places to look.

Streams are packed in blocks of about a million ids as they come, so memory holds a block or the
largest document, and no document is shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import record_batch, slices

#: The contract's sequence length and closing id (fixed values).
SIZE, CLOSING = 2048, 1
#: Truncation penalties and a window's price, in padding ids.
SENTENCE, INSIDE, PRICE = 4, 24, 8
#: Cuts inside a sentence, one every so many ids; ids of a block; text bytes tokenised at once.
GRID, BLOCK, BATCH_BYTES = 64, 1_000_000, 4_000_000
#: What a worker remembers at most: parts, and their characters.
KEPT_PARTS, KEPT_CHARS = 1_000_000, 32_000_000

_ENDS = re.compile(r"[.!?。！？]+[\"'”’)\]]*")
# A word that the splitter leaves whole and of which the normaliser changes the case alone, and a mark behind it.
_MARKS = list(".,;:!?")
_PLAIN = f"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿŒœ]+)(?P<mark>[{''.join(_MARKS)}]?)$"


class _Numbers(dict):
    """Numbers of texts in order of their first sight; ``new`` collects those not seen before."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        self[text] = n = len(self)
        self.new.append(text)
        return n

    def take(self) -> list[str]:
        new, self.new = self.new, []
        return new


class _Ids:
    """Runs of token ids by number."""

    def __init__(self):
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of ``which`` one behind the other, and their lengths."""
        first, n = self.ends[which], self.ends[which + 1] - self.ends[which]
        return self.flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n


class Encoder:
    """The token ids of whole texts, as the library gives them.

    The vocabulary's normaliser and splitter turn every blank into a split that no token
    crosses, and the special strings hold no blank, so the ids of a text are those of its
    parts between blanks.  Distinct parts are encoded once and remembered.  Most are a word
    of letters and at most one mark behind it, which the splitter parts; new words are encoded
    many at a time, as a text, and the ids that end a word tell them apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if any(re.search(r"\s", t.content) for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError(f"{path}: a special token holds a blank; no cut is safe")
        vocabulary = self.tokenizer.get_vocab()
        self.ends, self.word_ends = (np.zeros(max(vocabulary.values()) + 1, bool) for _ in range(2))
        for token, i in vocabulary.items():
            self.ends[i] = _ENDS.fullmatch(token.removesuffix("</w>")) is not None
            self.word_ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.parts, self.part_ids, self.words, self.word_ids, self.kept = _Numbers(), _Ids(), _Numbers(), _Ids(), 0
        for m in _MARKS:  # the first words
            self.words[m]
        self._learn_words()

    def _encoded(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self) -> None:
        new = self.words.take()
        if new:
            ids = np.concatenate(self._encoded([" ".join(new[i:i + 1000]) for i in range(0, len(new), 1000)]))
            self.word_ids.add(ids, np.diff(np.flatnonzero(self.word_ends[ids]), prepend=-1))

    def _learn_parts(self) -> None:
        if not self.parts.new:
            return
        new = pa.array(self.parts.take())
        self.kept += pc.sum(pc.utf8_length(new)).as_py()
        plain = pc.extract_regex(new, _PLAIN)
        hard = pc.is_null(plain)
        found = plain.filter(pc.invert(hard))
        word, mark = pc.utf8_lower(pc.struct_field(found, "word")).dictionary_encode(), pc.struct_field(found, "mark")
        number = np.fromiter(map(self.words.__getitem__, word.dictionary.to_pylist()), np.int64)
        self._learn_words()
        # Plain parts as two words each: the letters, and the mark (the first words are the marks) or none.
        letters = number[word.indices.to_numpy()]
        marks = pc.fill_null(pc.index_in(mark, pa.array(_MARKS)), -1).to_numpy()
        units = np.stack([letters, marks], axis=1)
        easy, n = self.word_ids.gather(units[units >= 0])
        per_unit = np.zeros(units.shape, np.int64)
        per_unit[units >= 0] = n
        other = self._encoded(new.filter(hard).to_pylist())
        is_hard = hard.to_numpy(zero_copy_only=False)
        lengths = np.zeros(len(new), np.int64)
        lengths[~is_hard] = per_unit.sum(axis=1)
        lengths[is_hard] = [len(x) for x in other]
        of_hard = np.repeat(is_hard, lengths)
        flat = np.empty(len(of_hard), np.uint32)
        flat[~of_hard] = easy
        flat[of_hard] = np.concatenate([np.zeros(0, np.uint32), *other])
        self.part_ids.add(flat, lengths)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids per text.  Texts are cut at ASCII blanks, and equal parts found, in Arrow; Python sees distinct parts only."""
        if len(self.parts) > KEPT_PARTS or self.kept > KEPT_CHARS:
            self.clear()
        cut = pc.ascii_split_whitespace(texts)
        parts = cut.flatten().dictionary_encode()
        known = pc.if_else(pc.string_is_ascii(parts.dictionary), pc.ascii_lower(parts.dictionary), parts.dictionary)
        number = np.fromiter(map(self.parts.__getitem__, known.to_pylist()), np.int64)
        self._learn_parts()
        ids, n = self.part_ids.gather(number[parts.indices.to_numpy()])
        stops = np.concatenate([[0], np.cumsum(n)])[np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64))]
        return np.split(ids, stops[:-1])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The tokenizer of this worker (loaded once per process)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def document_ids(texts: pa.Array, enc: Encoder, closing: int = CLOSING) -> list[np.ndarray]:
    """Ids of each text, closed with ``closing``."""
    if not len(texts):
        return []
    return [np.append(ids, np.uint32(closing)) for ids in enc.encode(texts)]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, size: int = SIZE,
               sentence: int = SENTENCE, inside: int = INSIDE, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the cuts a stream of ``ids`` allows; the first is 0, the last its end.

    Sentence ends are ids that ``ends`` marks.  Between cuts further apart than ``grid``
    ids, every ``grid``-th id is a cut inside the sentence, and within the last ``size``
    ids every one, so that a stream can always be closed with sequences of powers of two.
    """
    total = len(ids)
    level = np.zeros(total + 1, np.uint8)  # 1 inside a sentence, 2 its end, 3 a document's end
    level[1:] = 2 * ends[ids]
    level[doc_ends] = 3
    level[[0, total]] = 3
    natural = np.flatnonzero(level)
    gaps = np.diff(natural)
    steps = np.maximum((gaps - 1) // grid, 0)
    upto = np.cumsum(steps)
    nth = np.arange(int(steps.sum())) - np.repeat(upto - steps, steps) + 1
    level[np.repeat(natural[:-1], steps) + nth * grid] = 1
    level[max(total - size, 0):] = np.maximum(level[max(total - size, 0):], 1)
    points = np.flatnonzero(level)
    return points, np.array([0, inside, sentence, 0])[level[points]]


def best_cuts(points: np.ndarray, penalty: np.ndarray, size: int = SIZE, price: int = PRICE) -> list[int]:
    """Indices of the cheapest chain of cuts from the first point to the last (neither gap over ``size``)."""
    n = len(points)
    at = np.full(int(points[-1]) + 1, -1, np.int64)
    at[points] = np.arange(n)
    # Pairs of cuts a power of two apart, as lists per later cut.
    later, earlier = [], []
    for k in range(size.bit_length()):
        back = points - (1 << k)
        reach = np.flatnonzero(back >= 0)
        i = at[back[reach]]
        later.append(reach[i >= 0])
        earlier.append(i[i >= 0])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    first = np.searchsorted(later[order], np.arange(n + 1)).tolist()
    earlier = earlier[order].tolist()
    pos, pen = points.tolist(), penalty.tolist()
    f, came = [0] * n, [-1] * n
    queue: deque[int] = deque([0])  # f[i] + P[i] rises from left to right
    for j in range(1, n):
        p = pos[j]
        while pos[queue[0]] < p - size:
            queue.popleft()
        i = queue[0]
        best = f[i] + pos[i] + size - p
        for e in earlier[first[j]:first[j + 1]]:
            if f[e] <= best:
                best, i = f[e], e
        f[j], came[j] = best + pen[j] + price, i
        held = f[j] + p
        while queue and f[queue[-1]] + pos[queue[-1]] >= held:
            queue.pop()
        queue.append(j)
    path = [n - 1]
    while path[-1]:
        path.append(came[path[-1]])
    return path[::-1]


def pack_stream(docs: Sequence[np.ndarray], ends: np.ndarray, size: int = SIZE) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(document, start, length, crc32 of its ids, sequence, offset) of every piece of a block of documents."""
    ids = np.concatenate(docs)
    doc_ends = np.cumsum([len(d) for d in docs])
    points, penalty = cut_points(ids, doc_ends, ends, size)
    cuts = points[best_cuts(points, penalty, size)]
    edges = np.union1d(cuts, np.concatenate([[0], doc_ends]))
    begin, stop = edges[:-1], edges[1:]
    doc = np.searchsorted(doc_ends, begin, side="right")
    window = np.searchsorted(cuts, begin, side="right") - 1
    doc_start = np.concatenate([[0], doc_ends[:-1]])[doc]
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    for d, a, b, s, w, c in zip(doc.tolist(), begin.tolist(), stop.tolist(), doc_start.tolist(), window.tolist(), cuts[window].tolist(), strict=True):
        yield d, a - s, b - a, zlib.crc32(raw[4 * a:4 * b]), w, a - c


_PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack_documents(df: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", size: int = SIZE,
                   block: int = BLOCK, closing: int = CLOSING) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text and the closing id, so a null or empty text is one
    id; each id is in exactly one piece, and pieces follow the partition's order.  Ids of
    documents may be null or repeated (each row is packed); texts of any length are packed
    whole; an empty table gives no rows; other columns are not read.

    Partitions are packed on their own, so sequence ids (partition number and a counter)
    never clash, and a task that runs again gives whole sequences again.  ``size`` is a power of two.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        next_sequence = TaskContext.get().partitionId() << 40
        names: list = []
        held: list[np.ndarray] = []
        tokens = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence, names, held, tokens
            if held:
                d, start, length, crc, window, offset = map(np.array, zip(*pack_stream(held, enc.ends, size), strict=True))
                total = np.array([len(x) for x in held])
                yield record_batch({"doc_id": [names[i] for i in d.tolist()], "start": start, "length": length, "ids_crc32": crc,
                                    "doc_tokens": total[d], "sequence_id": window + next_sequence, "offset": offset}, _PIECES)
                next_sequence += int(window[-1]) + 1
            names, held, tokens = [], [], 0

        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                for name, ids in zip(batch.column("id").to_pylist(), document_ids(batch.column("text"), enc, closing), strict=True):
                    names.append(name)
                    held.append(ids)
                    tokens += len(ids)
                    if tokens >= block:
                        yield from close()
        yield from close()

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(pack, ", ".join(f"`{c.name}` bigint" for c in _PIECES))
