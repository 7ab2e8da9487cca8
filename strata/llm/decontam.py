"""Benchmark decontamination with suffix arrays of the training text.

Every Arrow batch of documents is a shard: its words become ids of the test vocabulary
(0: a word no item has), and its suffixes are sorted into a suffix array by their first
``WINDOW`` words.  Suffixes whose run of test words is shorter than the shortest window
are left out, as no window can begin there.  Test suffixes are sorted too; a merge of both
lists by first words leaves those that can occur in the shard at all.  Each of these is then
binary-searched in the shard's array, which gives all its locations at once; locations that
follow one another in document and item alike chain into the longest verbatim matches.

The test set reaches the executors in blocks of ``BLOCK_BYTES``, so neither a broadcast
nor the driver holds more than one block; documents pass each block in turn with their
hits so far, staged between blocks.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import annotate, stage

# Fixed by the contract: words of a window, and the contaminated share of the words (1 / SHARE).
WINDOW = 13
SHARE = 20

#: Bytes of test text in a block, and of training text in a shard.  A block takes some 40 times
#: its text on the driver while it is made, and 11 times in a broadcast (measured on 4.3 MB).
BLOCK_BYTES = 4_000_000
SHARD_BYTES = 4_000_000
#: (location, item) pairs chained at a time.
PAIRS = 2_000_000

#: ASCII letters lower-cased, digits and bytes of other code points kept, the rest spaces.
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

HITS = "hits array<struct<start:int,end:int>>, matches array<struct<item:string,start:int,words:int>>, n_words bigint"


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class TestBlock:
    """A block of items: vocabulary, distinct windows and where each occurs."""

    __test__ = False

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        self.vocab: dict[bytes, int] = {}
        flat = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for _, ws in items for w in ws], dtype=np.int32)
        self.row_name = np.array([place[name] for name, _ in items], dtype=np.int64)
        self.bits = max(1, len(self.vocab).bit_length())
        self.per_key = 63 // self.bits
        # every window of every item: where it begins in ``flat``, its item row and its offset there
        n = np.array([len(ws) for _, ws in items], dtype=np.int64)
        width = np.minimum(n, WINDOW)
        count = np.where(n > 0, n - width + 1, 0)
        row = np.repeat(np.arange(len(items)), count)
        offset = expand(np.zeros(len(items), dtype=np.int64), count)
        wide = width[row]
        ahead = np.arange(WINDOW)
        at = (np.cumsum(n) - n)[row] + offset
        words_ = np.where(ahead < wide[:, None], flat[np.minimum(at[:, None] + ahead, max(len(flat) - 1, 0))] if len(flat) else 0, 0)
        keys = self.pack(words_.astype(np.int64))
        # equal windows stand together, in the order of their words
        order = np.lexsort([wide, *keys[::-1]])
        keys, wide = [k[order] for k in keys], wide[order]
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (wide[1:] != wide[:-1]) | np.any([k[1:] != k[:-1] for k in keys], axis=0)
        heads = np.flatnonzero(fresh)
        self.occ_row, self.occ_offset = row[order], offset[order]
        self.occ_from = np.append(heads, len(order))
        self.keys, self.widths = [k[heads] for k in keys], wide[heads]
        self.least = int(self.widths.min()) if len(heads) else WINDOW

    def masks(self, some: np.ndarray) -> list[np.ndarray]:
        """The bits of the keys that count for the windows ``some``."""
        return self.pack(np.where(np.arange(WINDOW) < self.widths[some][:, None], (1 << self.bits) - 1, 0))

    def reachable(self, first: np.ndarray) -> np.ndarray:
        """The windows whose first words are among ``first``, a shard's sorted first keys: a merge of
        two sorted lists, so a shard pays for what it shares with the test set, not for the test set."""
        low, high = (np.searchsorted(self.keys[0], first, side=side) for side in ("left", "right"))
        full = expand(low, high - low)
        short = np.flatnonzero(self.widths < self.per_key)  # these end within their first key
        return np.union1d(full, short) if len(short) else full

    def pack(self, ids: np.ndarray) -> list[np.ndarray]:
        """Columns of word ids packed into 63-bit keys that compare like the words in turn."""
        out = []
        for at in range(0, WINDOW, self.per_key):
            key = np.zeros(len(ids), dtype=np.int64)
            for j in range(at, min(at + self.per_key, WINDOW)):
                key = (key << self.bits) | ids[:, j]
            out.append(key)
        return out


def suffix_array(ids: np.ndarray, block: TestBlock) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions that can begin a window, sorted by their first words, and their packed keys."""
    stops = np.flatnonzero(ids == 0)
    begins = np.flatnonzero(ids)
    run = stops[np.searchsorted(stops, begins)] - begins
    begins, run = begins[run >= block.least], run[run >= block.least]
    ahead = np.arange(WINDOW)
    prefix = np.where(ahead < run[:, None], ids[np.minimum(begins[:, None] + ahead, len(ids) - 1)], 0)
    keys = block.pack(prefix)
    order = np.lexsort(keys[::-1])
    return begins[order], [k[order] for k in keys]


def bounds(keys: list[np.ndarray], wanted: list[np.ndarray], masks: list[np.ndarray], upper: bool) -> np.ndarray:
    """Binary search of test suffixes, all at once: their first (or past-the-last) places."""
    low = np.zeros(len(wanted[0]), dtype=np.int64)
    high = np.full(len(low), len(keys[0]), dtype=np.int64)
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high) // 2, 0)
        before = np.zeros(len(mid), dtype=bool)
        same = np.ones(len(mid), dtype=bool)
        for key, want, mask in zip(keys, wanted, masks, strict=True):
            have = key[mid] & mask
            before |= same & (have < want)
            same &= have == want
        before |= same & upper
        low = np.where(open_ & before, mid + 1, low)
        high = np.where(open_ & ~before, mid, high)
    return low


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] values for each i, one after the other."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def locate(ids: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """(test window, position) of every occurrence in the shard, by position."""
    positions, keys = suffix_array(ids, block)
    none = np.zeros(0, dtype=np.int64)
    if not len(positions) or not len(block.widths):
        return none, none
    some = block.reachable(np.unique(keys[0]))
    if not len(some):
        return none, none
    wanted, masks = [k[some] for k in block.keys], block.masks(some)
    low, high = bounds(keys, wanted, masks, False), bounds(keys, wanted, masks, True)
    window = np.repeat(some, high - low)
    at = positions[expand(low, high - low)]
    order = np.argsort(at, kind="stable")
    return window[order], at[order]


def chains(window: np.ndarray, at: np.ndarray, doc: np.ndarray, block: TestBlock) -> Iterator[tuple[int, int, int, int]]:
    """(doc, item, start, words): the longest verbatim match of each item in each document.

    Hits are taken document by document in groups of about ``PAIRS`` (hit, item) pairs.
    """
    n = block.occ_from[window + 1] - block.occ_from[window]
    total = np.cumsum(n)
    begin = 0
    while begin < len(window):
        end = int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS, side="right"))
        end = max(end, begin + 1)
        end = int(np.searchsorted(doc, doc[end - 1], side="right"))  # whole documents
        part = slice(begin, end)
        occ = expand(block.occ_from[window[part]], n[part])
        pos, docs = np.repeat(at[part], n[part]), np.repeat(doc[part], n[part])
        row, width = block.occ_row[occ], np.repeat(block.widths[window[part]], n[part])
        diagonal = pos - block.occ_offset[occ]
        order = np.lexsort((pos, diagonal, row))
        pos, row, diagonal, docs, width = pos[order], row[order], diagonal[order], docs[order], width[order]
        fresh = np.ones(len(pos), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (diagonal[1:] != diagonal[:-1]) | (pos[1:] != pos[:-1] + 1) | (docs[1:] != docs[:-1])
        heads = np.flatnonzero(fresh)
        length = np.diff(np.append(heads, len(pos))) - 1 + width[heads]
        doc_h, item_h, pos_h = docs[heads], block.row_name[row[heads]], pos[heads]
        best = np.lexsort((pos_h, -length, item_h, doc_h))
        doc_h, item_h, pos_h, length = doc_h[best], item_h[best], pos_h[best], length[best]
        first = np.ones(len(doc_h), dtype=bool)
        first[1:] = (doc_h[1:] != doc_h[:-1]) | (item_h[1:] != item_h[:-1])
        yield from zip(doc_h[first].tolist(), item_h[first].tolist(), pos_h[first].tolist(), length[first].tolist(), strict=True)
        begin = end


def spans_of(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of intervals, as disjoint ones in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(start.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def search_shard(texts: list[str], block: TestBlock) -> tuple[list[list], list[list], list[int]]:
    """Per text: hit word intervals, longest match per item, and number of words."""
    known = block.vocab.get
    docs = [words(t) for t in texts]
    n_words = [len(d) for d in docs]
    starts = np.cumsum([0, *(n + 1 for n in n_words)])
    ids = np.zeros(int(starts[-1]) + 1, dtype=np.int64)
    for start, d in zip(starts.tolist(), docs):
        ids[start:start + len(d)] = np.fromiter(map(known, d, repeat(0)), np.int64, len(d))
    window, at = locate(ids, block)
    doc = np.searchsorted(starts, at, side="right") - 1
    hits: list[list] = [[] for _ in texts]
    matches: list[list] = [[] for _ in texts]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i in np.unique(doc).tolist():
        here = slice(int(cut[i]), int(cut[i + 1]))
        local = at[here] - starts[i]
        hits[i] = spans_of(local, local + block.widths[window[here]])
    for i, item, pos, n in chains(window, at, doc, block):
        matches[i].append((block.names[item], int(pos - starts[i]), int(n)))
    return hits, matches, n_words


def test_blocks(benchmark: DataFrame, text: str, item_id: str, limit: int) -> Iterator[TestBlock]:
    """The items in blocks of about ``limit`` bytes, one at a time on the driver."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string"), F.col(f"`{text}`").cast("string")).dropna()
    items, size, made = [], 0, False
    for name, body in rows.toLocalIterator():
        ws = words(body)
        if not ws:
            continue
        items.append((name, ws))
        size += len(body)
        if size >= limit:
            yield TestBlock(items)
            items, size, made = [], 0, True
    if items or not made:
        yield TestBlock(items)


test_blocks.__test__ = False


def merge(old: list | None, new: list[tuple], keys: tuple[str, ...]) -> list[tuple]:
    return [tuple(x[k] for k in keys) for x in old or []] + new


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
                       bench_text: str = "text", item_id: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, out): per document ``out`` holds

    * ``hits``: disjoint word intervals covered by a window of an item,
    * ``matches``: per item with a window in the document its longest verbatim match
      (item id as text, first word in the document, words), sorted by item id,
    * ``n_words``.

    ``row`` holds the ``carry`` columns, whatever their types and names.  Null and empty
    texts have no words; items with a null id or text, or without words, are no items;
    items that share an id count once; an empty table on either side is allowed.
    """
    spark = docs.sparkSession
    names = list(dict.fromkeys([*carry, text]))
    state = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    own = [f"c{names.index(c)}" for c in carry]
    hit_col = F.lit(None).cast("array<struct<start:int,end:int>>")
    match_col = F.lit(None).cast("array<struct<item:string,start:int,words:int>>")
    blocks = test_blocks(benchmark, bench_text, item_id, block_bytes)
    block = next(blocks)
    while True:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(block)  # bounded by block_bytes

        def search(texts, old_hits, old_matches, shared=shared):
            hits, matches, n_words = search_shard(texts, shared.value)
            out_hits, out_matches = [], []
            for h, m, oh, om in zip(hits, matches, old_hits, old_matches, strict=True):
                both = np.array(merge(oh, h, ("start", "end")), dtype=np.int64).reshape(-1, 2)
                out_hits.append([{"start": a, "end": b} for a, b in spans_of(both[:, 0], both[:, 1])])
                longest: dict[str, tuple] = {}
                for name, start, n in merge(om, m, ("item", "start", "words")):
                    if name not in longest or (n, -start) > (longest[name][2], -longest[name][1]):
                        longest[name] = (name, start, n)
                out_matches.append([{"item": a, "start": b, "words": c} for a, b, c in sorted(longest.values())])
            return {"hits": out_hits, "matches": out_matches, "n_words": n_words}

        keep = own if following is None else [f"c{i}" for i in range(len(names))]
        found = annotate(state, search, HITS, f"c{names.index(text)}", keep, [hit_col, match_col], limit=SHARD_BYTES)
        if following is None:
            row = F.struct(*[F.col("row").getField(f"c{names.index(c)}").alias(c) for c in carry])
            return found.select(row.alias("row"), "out")
        # a further block: documents go on with what they have
        found = stage(found, "decontam")
        state = found.select("row.*", F.col("out.hits").alias("h"), F.col("out.matches").alias("m"))
        hit_col, match_col = F.col("h"), F.col("m")
        block = following


def contamination_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query contract's columns, from the operator's hits and matches."""
    n_hit = F.aggregate("out.hits", F.lit(0).cast("long"), lambda n, h: n + (h["end"] - h["start"]))
    out = found.select(F.col("row")[id_col].alias("doc_id"), F.col("out.n_words"), n_hit.alias("n_hit"),
                       F.size("out.matches").cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort(F.transform("out.matches", lambda m: m["item"])), ","), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; columns and their order stay."""
    found = find_contamination(docs, benchmark, text, tuple(docs.columns))
    n_hit = F.aggregate("out.hits", F.lit(0).cast("long"), lambda n, h: n + (h["end"] - h["start"]))
    keep = found.where((n_hit == 0) | (SHARE * n_hit < F.col("out.n_words")))
    return keep.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
