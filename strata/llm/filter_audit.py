"""Filter interaction audit: what every filter of every ordering removes, without rerunning a filter.

Each document is looked at once and gets a mask of the filters it fails.  Documents
with the same part and mask are one *cell*, so a part is at most ``2 ** k`` cells
whatever its size.  A Gray-code walk then visits every subset of filters by toggling
one filter at a time: toggling moves the active-failure counter of each cell that fails
the filter, and a cell whose counter leaves or reaches zero leaves or joins the
survivors.  The survivors of the ``2 ** k`` subsets are stored; a step of an ordering is
the difference of two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import annotate, record_batch, stage

FILTERS = "ABCDE"
#: The contract's limits (fixed values).
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITAL_PCT = 100, 80, 10
_CAPITALS, _SIGNS = bytes(range(65, 91)), b"#$%&*|"
DUPLICATE = FILTERS.index("E")

#: Measures of a cell, in the order the walk keeps them.
MEASURES = ("n", "good", "toxic")
_ROWS = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                   *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])


def text_failures(text: str) -> int:
    """Bits of the filters A to D that ``text`` fails (bit i is ``FILTERS[i]``).

    ``bytes.split()`` splits at exactly the six blanks of the contract, and neither a
    capital A-Z nor one of the signs is a byte of another character's UTF-8 code.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    fails = (len(words) < MIN_WORDS,
             100 * len(set(words)) < MIN_DISTINCT_PCT * len(words),
             100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MAX_CAPITAL_PCT * len(text),
             len(raw.translate(None, _SIGNS)) < len(raw))
    return sum(f << i for i, f in enumerate(fails))


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per language and set of failed filters.

    A document is good (toxic) if any label row of its id says quality = 1 (toxic = 1);
    one without labels is neither.  Null texts are empty texts, and equal to them; a null
    language is the part ``""``.  A document fails E if its text is that of a row with a
    smaller id: repeated ids are not smaller, a null id is larger than every number.

    Texts are compared by SHA-256.  Only (id, language, bits, digest) leaves the task that
    read the text, so texts are never shuffled; the copies of a text are summed up per
    (language, bits, labels) with a map-side step before they meet for its smallest id, so
    a text that a third of all rows repeat is a handful of rows by then.
    """

    def look(texts: list[str]) -> dict[str, list]:
        return {"bits": [text_failures(t) for t in texts],
                "digest": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]}

    seen = annotate(docs, look, "bits int, digest binary", carry=["doc_id", "lang"])
    seen = stage(seen.select(F.col("row.doc_id").cast("bigint").alias("doc_id"),
                             F.coalesce(F.col("row.lang").cast("string"), F.lit("")).alias("part"),
                             "out.bits", "out.digest"), "filter-audit")
    told = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("label_id"))
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    named = seen.where(F.col("doc_id").isNotNull()).join(told, F.col("doc_id") == F.col("label_id"), "left")
    zero = F.lit(0)
    rows = named.select("doc_id", "part", "bits", "digest", F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic")) \
        .unionByName(seen.where(F.col("doc_id").isNull()).select("*", zero.alias("good"), zero.alias("toxic")))
    # Copies of a text per kind: how many, the smallest id among them and how many rows have it.
    # ``first`` is (id, how often) of the smallest id: summed per id, then the least one taken.
    per_id = rows.groupBy("digest", "part", "bits", "good", "toxic", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "times")))
    kinds = per_id.groupBy("digest", "part", "bits", "good", "toxic").agg(F.sum("times").alias("n"), least.alias("first"))
    texts = kinds.groupBy(F.col("digest").alias("of")).agg(F.min("first.doc_id").alias("least_id"))
    originals = F.when(F.col("least_id").isNull(), F.col("n")).when(F.col("first.doc_id") == F.col("least_id"), F.col("first.times")).otherwise(0)
    split = kinds.join(texts, F.col("digest") == F.col("of")).select(
        "part", "bits", "good", "toxic", originals.alias("originals"), (F.col("n") - originals).alias("copies"))
    sides = F.explode(F.array(F.struct(F.col("bits").alias("mask"), F.col("originals").alias("n")),
                              F.struct(F.col("bits").bitwiseOR(1 << DUPLICATE).alias("mask"), F.col("copies").alias("n"))))
    cells = split.select("part", "good", "toxic", sides.alias("c")).groupBy("part", F.col("c.mask").alias("mask"))
    return cells.agg(F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"),
                     F.sum(F.col("c.n") * F.col("toxic")).alias("toxic")).where("n > 0")


def survivors(cells: Mapping[int, Sequence[int]], k: int) -> list[tuple[int, ...]]:
    """Summed measures of the cells that fail no filter of each of the ``2 ** k`` subsets.

    Subsets are visited in Gray-code order: the i-th step toggles the filter of the lowest
    set bit of i, so neighbours differ by one filter and only its cells are touched.
    """
    width = len(MEASURES)
    running = [sum(c[j] for c in cells.values()) for j in range(width)]
    failing = [[m for m in cells if m >> f & 1] for f in range(k)]
    active = dict.fromkeys(cells, 0)
    states: list[tuple[int, ...]] = [()] * (1 << k)
    states[0] = tuple(running)
    subset = 0
    for i in range(1, 1 << k):
        f = (i & -i).bit_length() - 1
        subset ^= 1 << f
        joins = bool(subset >> f & 1)  # the filter joins the subset: its cells may die
        for m in failing[f]:
            active[m] += 1 if joins else -1
            if active[m] == (1 if joins else 0):
                for j in range(width):
                    running[j] += -cells[m][j] if joins else cells[m][j]
        states[subset] = tuple(running)
    return states


def audit_steps(cells: Mapping[int, Sequence[int]], filters: str = FILTERS) -> Iterator[dict]:
    """One row per ordering of ``filters`` and step, from the stored survivors."""
    k = len(filters)
    states = survivors(cells, k)
    total = [sum(c[0] for m, c in cells.items() if m >> f & 1) for f in range(k)]
    alone = [cells.get(1 << f, (0,))[0] for f in range(k)]
    steps, shapley = [], [0] * k
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            a, b = states[before], states[before | 1 << f]
            before |= 1 << f
            shapley[f] += a[0] - b[0]
            steps.append((order, step, f, a, b))
    for order, step, f, a, b in steps:
        yield {"filter_order": "".join(filters[x] for x in order), "step": step, "kept": b[0], "removed": a[0] - b[0],
               "redundant": total[f] - (a[0] - b[0]), "unique_fails": alone[f],
               "good_lost": a[1] - b[1], "toxic_lost": a[2] - b[2], "shapley": shapley[f]}


def audit_orders(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, ordering of ``filters`` (all k!) and step: what is kept, removed and lost.

    ``cells`` has part, mask (bit i: fails ``filters[i]``) and the measures n, good, toxic;
    repeated cells add up.  A part's cells meet in one row: at most ``2 ** k`` of them.  No
    cells, no rows.
    """
    lists = cells.groupBy("part", "mask").agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES]) \
        .groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                rows = list(audit_steps({c["mask"]: [c[m] for m in MEASURES] for c in found}, filters))
                yield record_batch({"part": [part] * len(rows), **{f.name: [r[f.name] for r in rows] for f in _ROWS if f.name != "part"}}, _ROWS)

    return lists.mapInArrow(walk, "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
                                  "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E over whole texts (see the two steps above)."""
    return audit_orders(failure_cells(docs, labels))
