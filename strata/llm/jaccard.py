"""N-gram Jaccard join: linked texts and their components, exact at 0.8 over word 5-grams.

Texts with equal shingle sets are one node.  A node is a point: its shingles per hash
group (``count_tree``), which bounds the overlap of any two nodes.

1. ``describe`` reads every text once: size, set id, count vector, min-hashes, and
   how often shingles occur (counts of hashed slots, added up over the tasks).
2. Near copies are joined cheaply first: sorted by their min-hashes, neighbours are paired
   and verified on the sets; true links give first components.  This finds no link that
   isn't one and may miss some.
3. Nothing is missed in the second pass.  Shingles are ordered from rare to frequent (by
   slot count, then hash); two linked nodes share one of their first n - ceil(0.8 n) + 1.
   These prefix shingles deal the nodes into shards; a shingle that only one component
   has needs no work.  In the others the R-tree of count vectors finds the pairs across
   components that sizes, counts and the shingle's place in their orders allow, skipping subtrees of the node's own component;
   the survivors are verified on the sets.
4. Links of both passes give the components.
5. All links lie inside a component.  The sets of its nodes are compared block by block, so
   each link is found once (``jaccard_links``), or only counted for its two nodes
   (``jaccard_result``): then nothing as large as the number of links leaves a task.

A shingle shared by more than ``BLOCK`` nodes is dealt into blocks, and every pair of
blocks is one shard.  Sets are only read for nodes that have a pair to verify: these are
marked in a bitmap of fixed size, so the texts are not shuffled for it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import record_batch, slices, stage
from strata.llm.components import components
from strata.llm.count_tree import CountTree, needed
from strata.llm.shingles import finish, group_counts, points, set_id, shingle_sets, signed

#: Text bytes shingled at a time; slots of the frequency table and slots per row of it.
BATCH_BYTES = 1_000_000
SLOTS, SLOTS_PER_ROW = 1 << 20, 1 << 14
#: Min-hashes and neighbours of the first pass; bits of a bitmap; nodes of a block; nodes below which a
#: shard is searched without a tree; keys gathered before they are sent on; keys of a part.
HASHES, NEIGHBOURS, BITS, BLOCK, FEW, GATHER, PART_KEYS = 8, 3, 1 << 27, 512, 24, 2_000_000, 500_000
#: Nodes and shingles of a component, or of a block of a larger one, that are compared in one piece;
#: ratio of the size classes: more than 1.25, so linked nodes are of the same or of adjacent classes.
LINK_NODES, LINK_SHINGLES, CLASS_RATIO = 2048, 2_000_000, 1.26

_SEEDS = finish(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

NO_ID = -1

DESCRIBED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("vector", pa.binary()),
                       ("hashes", pa.list_(pa.int64())), ("chunk", pa.int32()), ("counts", pa.binary())])
KEYS = pa.schema([("node", pa.int64()), ("keys", pa.list_(pa.int64()))])
SETS = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])


def bodies(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """doc_id, mark (the id, or NO_ID), text."""
    ids = F.col(f"`{id_col}`").cast("long")
    return docs.select(ids.alias("doc_id"), F.coalesce(ids, F.lit(NO_ID)).alias("mark"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def slot_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(SLOTS - 1)).astype(np.int64)


def describe(rows: DataFrame) -> DataFrame:
    """One row per text (n = 0: no words) and, with a ``chunk``, each task's slot counts."""

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.int32)
        for whole in it:
            for batch in slices(whole, "text", BATCH_BYTES):
                sets = shingle_sets(batch.column("text").to_pylist())
                for s in sets:
                    counts += np.bincount(slot_of(s), minlength=SLOTS).astype(np.int32) if len(s) > SLOTS // 8 else 0
                short = [slot_of(s) for s in sets if len(s) <= SLOTS // 8]
                if short:
                    counts += np.bincount(np.concatenate(short), minlength=SLOTS).astype(np.int32)
                none = [None] * len(sets)
                yield record_batch({
                    "doc_id": batch.column("doc_id").to_pylist(), "n": [len(s) for s in sets],
                    "node": [set_id(s) for s in sets], "vector": [group_counts(s).tobytes() for s in sets],
                    "hashes": [signed(np.array([(s * seed).min() for seed in _SEEDS])).tolist() if len(s) else [] for s in sets],
                    "chunk": none, "counts": none}, DESCRIBED)
        for chunk in range(SLOTS // SLOTS_PER_ROW):
            part = counts[chunk * SLOTS_PER_ROW:(chunk + 1) * SLOTS_PER_ROW]
            if part.any():
                yield record_batch({k: [None] for k in DESCRIBED.names[:5]} | {
                    "chunk": [chunk], "counts": [zlib.compress(part.tobytes(), 1)]}, DESCRIBED)

    return stage(rows.mapInArrow(look, "doc_id bigint, n bigint, node bigint, vector binary, hashes array<bigint>, "
                                       "chunk int, counts binary"), "jaccard-docs")


def frequency_levels(described: DataFrame) -> np.ndarray:
    """log2 of the count of every slot, one byte each: SLOTS bytes whatever the input."""
    schema = pa.schema([("chunk", pa.int32()), ("levels", pa.binary())])

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in it:
            for chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(packed), dtype=np.int32)
                total[chunk] = total[chunk] + part if chunk in total else part.astype(np.int64)
        for chunk, n in total.items():
            yield record_batch({"chunk": [chunk], "levels": [np.log2(np.maximum(n, 1)).astype(np.uint8).tobytes()]}, schema)

    levels = np.zeros(SLOTS, dtype=np.uint8)
    rows = (described.where(F.col("chunk").isNotNull()).select("chunk", "counts")
            .repartition(SLOTS // SLOTS_PER_ROW, "chunk").mapInArrow(add, "chunk int, levels binary"))
    for chunk, part in rows.collect():
        levels[chunk * SLOTS_PER_ROW:(chunk + 1) * SLOTS_PER_ROW] = np.frombuffer(part, dtype=np.uint8)
    return levels


def prefix_keys(rows: DataFrame, levels: np.ndarray) -> DataFrame:
    """(node, keys): the rarest n - ceil(0.8 n) + 1 shingles of every text with words, in order."""
    shared = rows.sparkSession.sparkContext.broadcast(levels)  # SLOTS bytes

    def pick(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for batch in slices(whole, "text", BATCH_BYTES):
                nodes, keys = [], []
                for s in shingle_sets(batch.column("text").to_pylist()):
                    if len(s):
                        rank = (shared.value[slot_of(s)].astype(np.uint64) << np.uint64(58)) | (s >> np.uint64(6))
                        n = len(s) - (4 * len(s) + 4) // 5 + 1
                        nodes.append(set_id(s))
                        first = np.argpartition(rank, n - 1)[:n]
                        keys.append(signed(s[first[np.argsort(rank[first])]]))
                lengths = np.cumsum([0, *map(len, keys)])
                flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists], schema=KEYS)

    return rows.mapInArrow(pick, "node bigint, keys array<bigint>")


def bitmap(values: DataFrame) -> bytes:
    """Bits value mod BITS of the column ``value``, compressed: at most about BITS / 8 bytes
    whatever the input."""
    bit = F.pmod(F.col("value"), F.lit(BITS))
    words = (values.select(bit.alias("bit")).groupBy(F.expr("cast(bit div 32 as int)").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits"))).toArrow()
    out = np.zeros(BITS // 32, dtype=np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return zlib.compress(out.tobytes(), 1)


def opened(bits: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(bits), dtype=np.uint32)


def hits(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    bit = value % BITS
    return ((bits[bit // 32] >> (bit % 32).astype(np.uint32)) & 1) == 1


def sets_of(rows: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (node), from one text of each.

    Texts are picked by the bitmap of their ids (some others pass too) and shingled by the
    same function: two in a row would keep two Python workers for every task.
    """
    ids = nodes.join(wanted, "node", "left_semi").select(F.col("mark").alias("value"))
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(ids))  # at most BITS / 8 bytes

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap_ = opened(shared.value)
        for whole in it:
            some = whole.filter(pa.array(hits(bitmap_, whole.column("mark").to_numpy())))
            for batch in slices(some, "text", BATCH_BYTES):
                sets = shingle_sets(batch.column("text").to_pylist())
                yield record_batch({"node": [set_id(s) for s in sets], "shingles": [s.tobytes() for s in sets]}, SETS)

    found = rows.select("mark", "text").mapInArrow(read, "node bigint, shingles binary")
    return stage(found.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "jaccard-sets")


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and counts per group allow a link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            m, n = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            v, w = (points(batch.column(c).to_pylist()) for c in ("v_a", "v_b"))
            keep = np.minimum(v, w).sum(1, dtype=np.int64) >= needed(m, n)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep))

    point = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("vector").alias(f"v_{x}"))
    near = pairs.join(point("a"), "a").join(point("b"), "b").where("5 * n_a >= 4 * n_b AND 5 * n_b >= 4 * n_a")
    return near.mapInArrow(check, "a bigint, b bigint")


def verify(pairs: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b): 100 * intersection >= 80 * union of their sets."""
    pairs = stage(bounded(pairs, nodes), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets_of(rows, nodes, wanted)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in it for part in slices(whole, "of_a", BATCH_BYTES)):
            a, b, of_a, of_b = (batch.column(c).to_pylist() for c in ("a", "b", "of_a", "of_b"))
            out_a, out_b = [], []
            for x, y, sx, sy in zip(a, b, of_a, of_b, strict=True):
                p, q = np.frombuffer(sx, dtype=np.uint64), np.frombuffer(sy, dtype=np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                if 100 * both >= 80 * (len(p) + len(q) - both):
                    out_a.append(x)
                    out_b.append(y)
            yield record_batch({"a": out_a, "b": out_b}, schema)

    return stage(pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a bigint, b bigint"), "jaccard-links")


def first_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): nodes next to one another when sorted by their min-hashes.

    For every min-hash the nodes are sorted by it, then by the following ones, so the most
    alike stand together; a node is paired with the next NEIGHBOURS that have the same one.
    The sort is by ranges of the whole tuple, so no group of copies is one task's, and a
    node has a bounded number of pairs.  Neighbours parted by a range border are missed
    here.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    turned = nodes.select("node", F.posexplode(F.array(*[
        F.struct(*[F.col("hashes")[(j + i) % HASHES].alias(f"h{i}") for i in range(3)]) for j in range(HASHES)])).alias("j", "h"))

    def pair(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in it:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            j, h, node = (table.column(c).to_numpy() for c in ("j", "h0", "node"))
            low, high = [node[:0]], [node[:0]]
            for d in range(1, NEIGHBOURS + 1):
                same = (j[d:] == j[:-d]) & (h[d:] == h[:-d])
                low.append(np.minimum(node[d:], node[:-d])[same])
                high.append(np.maximum(node[d:], node[:-d])[same])
            found = np.unique(np.stack([np.concatenate(low), np.concatenate(high)]), axis=1)
            yield record_batch({"a": found[0], "b": found[1]}, schema)
            rest = table.slice(max(0, table.num_rows - NEIGHBOURS)).to_batches()[0] if table.num_rows else None

    ordered = turned.select("j", "h.h0", "h.h1", "h.h2", "node")
    spread = ordered.repartitionByRange("j", "h0", "h1", "h2", "node").sortWithinPartitions("j", "h0", "h1", "h2", "node")
    return spread.mapInArrow(pair, "a bigint, b bigint").distinct()


def early(size: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the shard's key can be the first that a linked pair shares: no more may come
    before it on either side than the link can do without."""
    least = needed(size[i], size[j])
    return (place[i] <= size[i] - least) & (place[j] <= size[j] - least)


def search_shard(node: np.ndarray, size: np.ndarray, label: np.ndarray, vector: np.ndarray, place: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of one shard; ``side``: 0 and 1 of a pair of blocks, None within one."""
    left = np.arange(len(node)) if side is None else np.flatnonzero(side == 0)
    right = left if side is None else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return node[:0], node[:0]
    tree = CountTree(vector[right], size[right], label[right])
    q, p = tree.search(vector[left], size[left], label[left])
    keep = early(size, place, left[q], right[p])
    a, b = node[left[q[keep]]], node[right[p[keep]]]
    return np.minimum(a, b), np.maximum(a, b)


def search_small(group: np.ndarray, node: np.ndarray, size: np.ndarray, label: np.ndarray, vector: np.ndarray, place: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many shards of at most ``most`` rows, each a single leaf, all at once."""
    found = [(node[:0], node[:0])]
    for d in range(1, most):
        i = np.flatnonzero(group[d:] == group[:-d])
        if not len(i):
            break
        j = i + d
        keep = (label[i] != label[j]) & (5 * size[i] >= 4 * size[j]) & (5 * size[j] >= 4 * size[i]) & early(size, place, i, j)
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 10_000):
            x, y = i[at:at + 10_000], j[at:at + 10_000]
            ok = np.minimum(vector[x], vector[y]).sum(1, dtype=np.int64) >= needed(size[x], size[y])
            found.append((np.minimum(node[x[ok]], node[y[ok]]), np.maximum(node[x[ok]], node[y[ok]])))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def candidates(shards: DataFrame) -> DataFrame:
    """(a, b) from rows (key, i, j, side, node, place, n, label, vector), one shard per (key, i, j)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A pair that many shards of the task find leaves it once (in runs of about GATHER)."""
        held, some = np.zeros((2, 0), dtype=np.int64), 0
        fresh: list[np.ndarray] = []
        for found in searched(it):
            fresh.append(found)
            some += found.shape[1]
            if some < max(held.shape[1], GATHER // 8):
                continue  # sorted again only when it has doubled
            held, fresh, some = np.unique(np.concatenate((held, *fresh), axis=1), axis=1), [], 0
            if held.shape[1] >= GATHER // 2:
                yield record_batch({"a": held[0], "b": held[1]}, schema)
                held = held[:, :0]
        held = np.unique(np.concatenate((held, *fresh), axis=1), axis=1)
        yield record_batch({"a": held[0], "b": held[1]}, schema)

    def searched(it: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        rest = None
        for batch in it:
            table = pa.Table.from_batches([batch] if rest is None else [*rest, batch])
            key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
            if not len(key):
                continue
            last = int(np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1])).max(initial=-1)) + 1
            rest = table.slice(last).combine_chunks().to_batches()  # the last shard may go on
            if last:
                yield done(table.slice(0, last))
        if rest:
            yield done(pa.Table.from_batches(rest))

    def done(table: pa.Table) -> np.ndarray:
        key, i, j, node, size, label, place = (table.column(c).to_numpy() for c in ("key", "i", "j", "node", "n", "label", "place"))
        side = table.column("side").to_numpy()
        vector = points(table.column("vector").to_pylist())
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(key)))
        group = np.cumsum(fresh) - 1
        few = (sizes <= FEW) & (i[starts] == j[starts])
        small = few[group]
        found = [search_small(group[small], node[small], size[small], label[small], vector[small], place[small], FEW)]
        for g in np.flatnonzero(~few).tolist():
            part = slice(int(starts[g]), int(starts[g] + sizes[g]))
            own = None if i[starts[g]] == j[starts[g]] else side[part]
            found.append(search_shard(node[part], size[part], label[part], vector[part], place[part], own))
        pairs = np.unique(np.stack([np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])]), axis=1)
        return pairs[:, pairs[0] != pairs[1]]

    return shards.mapInArrow(search, "a bigint, b bigint").distinct()


def part_of(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, rest): a key is known by its part and 32 more bits; keys that agree in both
    are taken for one, which can only add candidates."""
    k = keys.view(np.uint64) >> np.uint64(16)
    return (k % np.uint64(parts)).astype(np.int64), ((k // np.uint64(parts)) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def contested_keys(keyed: DataFrame, parts: int) -> DataFrame:
    """(key) that nodes of two components have, as part + parts * rest.

    A task sends every (key, component) once, packed by part in nine bytes each (a
    component by 40 bits of its label); a part is sorted and scanned as one array of
    about PART_KEYS entries.  However many nodes a component has, it is one entry a task.
    """
    schema = pa.schema([("part", pa.int32()), ("rest", pa.binary()), ("label", pa.binary())])
    found = pa.schema([("key", pa.int64())])

    def pack(keys: list[np.ndarray], labels: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        part, rest = part_of(np.concatenate(keys), parts)
        label = (np.concatenate(labels).view(np.uint64) & np.uint64(0xFFFFFFFFFF)).astype(np.int64)
        order = np.lexsort((label, rest, part))
        part, rest, label = part[order], rest[order], label[order]
        new = np.ones(len(part), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (rest[1:] != rest[:-1]) | (label[1:] != label[:-1])
        part, rest, label = part[new], rest[new], label[new]
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        out: dict[str, list] = {"part": part[cut].tolist(), "rest": [], "label": []}
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(part)]):
            out["rest"].append(rest[a:b].astype(np.uint32).tobytes())
            out["label"].append(label[a:b].astype(np.uint32).tobytes() + (label[a:b] >> 32).astype(np.uint8).tobytes())
        yield record_batch(out, schema)

    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, labels, held = [], [], 0
        for batch in it:
            lists = batch.column("keys")
            flat = lists.flatten().to_numpy()
            keys.append(flat)
            labels.append(np.repeat(batch.column("label").to_numpy(), np.diff(lists.offsets.to_numpy())))
            held += len(flat)
            if held >= GATHER:
                yield from pack(keys, labels)
                keys, labels, held = [], [], 0
        if held:
            yield from pack(keys, labels)

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Part by part (rows come sorted by part): memory holds the entries of one."""
        at, rests, labels = -1, [], []
        for batch in it:
            for part, rest, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != at:
                    yield from look(at, rests, labels)
                    at, rests, labels = part, [], []
                n = len(rest) // 4
                rests.append(np.frombuffer(rest, dtype=np.uint32))
                labels.append(np.frombuffer(label[:4 * n], dtype=np.uint32).astype(np.int64)
                              | (np.frombuffer(label[4 * n:], dtype=np.uint8).astype(np.int64) << 32))
        yield from look(at, rests, labels)

    def look(part: int, rests: list[np.ndarray], labels: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if rests:
            rest, label = np.concatenate(rests).astype(np.int64), np.concatenate(labels)
            order = np.lexsort((label, rest))
            rest, label = rest[order], label[order]
            two = (rest[1:] == rest[:-1]) & (label[1:] != label[:-1])
            yield record_batch({"key": np.unique(rest[1:][two]) * parts + part}, found)

    packed = keyed.select("label", "keys").mapInArrow(send, "part int, rest binary, label binary")
    return stage(packed.repartition("part").sortWithinPartitions("part").mapInArrow(scan, "key bigint"), "jaccard-contested")


def postings_of(keyed: DataFrame, contested: DataFrame, parts: int) -> DataFrame:
    """(key, node, place in the node's order) of the contested keys; only keys that the bitmap
    marks leave the task."""
    shared = keyed.sparkSession.sparkContext.broadcast(bitmap(contested.select(F.col("key").alias("value"))))  # at most BITS / 8 bytes
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("place", pa.int64())])

    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap_ = opened(shared.value)
        for batch in it:
            lists = batch.column("keys")
            part, rest = part_of(lists.flatten().to_numpy(), parts)
            counts = np.diff(lists.offsets.to_numpy())
            node = np.repeat(batch.column("node").to_numpy(), counts)
            place = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
            key = rest * parts + part
            keep = hits(bitmap_, key)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, node, place)], schema=schema)

    some = keyed.select("node", "keys").mapInArrow(split, "key bigint, node bigint, place bigint").distinct()
    return stage(some.join(contested, "key", "left_semi"), "jaccard-postings")


def second_pairs(rows: DataFrame, described: DataFrame, labelled: DataFrame) -> DataFrame:
    """(a, b): every pair of different components that prefixes, sizes and counts allow."""
    keys = prefix_keys(rows, frequency_levels(described))
    keyed = stage(keys.join(labelled.select("node", "label"), "node"), "jaccard-keyed")
    total = keyed.agg(F.sum(F.size("keys"))).first()[0] or 0
    parts = max(16, total // PART_KEYS)
    postings = postings_of(keyed, contested_keys(keyed, parts), parts)
    hot = stage(postings.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK)
                .select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("more")), "jaccard-hot")
    full = postings.join(hot, "key", "left").withColumn("blocks", F.coalesce("more", F.lit(1))).join(labelled, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = full.withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    shards = other.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                          (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "place", "n", "label", "vector")
    return candidates(shards.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))


def link_shards(sets: DataFrame, linked: DataFrame) -> DataFrame:
    """(label, i, j, side, node, copies, shingles): every pair of nodes of a component whose sizes
    allow a link meets in one shard (label, i, j).

    A component of more than LINK_NODES nodes or LINK_SHINGLES shingles is dealt into size
    classes and these into blocks by hash; every pair of blocks of the same or of adjacent
    classes is a shard.  i and j are class * 2 ** 32 + block.
    """
    classed = linked.withColumn("c", F.floor(F.log(F.col("n")) / math.log(CLASS_RATIO)).cast("long"))
    blocks = F.ceil(F.greatest(F.col("m") / LINK_NODES, F.col("total") / LINK_SHINGLES))
    hot = stage(classed.groupBy("label", "c").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
                .groupBy("label").agg(F.sum("m").alias("m_all"), F.sum("total").alias("n_all"), F.collect_list(F.struct("c", blocks.alias("blocks"))).alias("classes"))
                .where((F.col("m_all") > LINK_NODES) | (F.col("n_all") > LINK_SHINGLES)).select("label", "classes"), "jaccard-hot-groups")
    own = F.expr("c * 4294967296 + pmod(xxhash64(node), element_at(filter(classes, x -> x.c = c), 1).blocks)")
    others = F.expr("flatten(transform(filter(classes, x -> abs(x.c - c) <= 1), "
                    "x -> transform(sequence(0L, x.blocks - 1), b -> x.c * 4294967296 + b)))")
    dealt = (classed.join(hot, "label", "left")
             .select("label", "node", "copies", F.coalesce(own, F.lit(0)).alias("own"), F.coalesce(others, F.array(F.lit(0).cast("long"))).alias("others")))
    other = sets.join(dealt, "node").select("*", F.explode("others").alias("other"))
    return other.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "copies", "shingles")


def links_among(sets: list[np.ndarray], split: int | None) -> Iterator[tuple[int, np.ndarray]]:
    """(x, ys): set x is linked with every set of ys, all after x (``split``: x before it, ys from it on)."""
    size = np.array([len(s) for s in sets])
    start = np.cumsum(size) - size
    number, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mine = np.zeros(len(number), dtype=bool)
    for x in range(len(sets) - 1 if split is None else split):
        first = x + 1 if split is None else split
        if first == len(sets):
            break
        own = flat[start[x]:start[x] + size[x]]
        mine[own] = True
        both = np.add.reduceat(mine[flat[start[first]:]], start[first:] - start[first], dtype=np.int64)
        mine[own] = False
        yield x, first + np.flatnonzero(100 * both >= 80 * (size[x] + size[first:] - both))


def search_links(shards: DataFrame, counts: bool) -> DataFrame:
    """(a, b) of every link of the shards, or with ``counts`` (node, n): links per node and
    shard, each weighing as many as the other node has copies."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64())] if counts else [("a", pa.int64()), ("b", pa.int64())])

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: tuple | None = None
        held: list[tuple] = []
        out: list[np.ndarray] = []
        for batch in it:
            for *key, side, node, copies, packed in zip(*(batch.column(c).to_pylist() for c in ("label", "i", "j", "side", "node", "copies", "shingles")), strict=True):
                if tuple(key) != shard:
                    out += look(shard, held)
                    shard, held = tuple(key), []
                    if sum(x.shape[1] for x in out) >= GATHER // 10:
                        yield joined(out)
                        out = []
                held.append((side, node, copies, packed))
        out += look(shard, held)
        yield joined(out)

    def joined(out: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate([np.zeros((2, 0), dtype=np.int64), *out], axis=1)
        return record_batch(dict(zip(schema.names, both)), schema)

    def look(shard: tuple | None, held: list[tuple]) -> list[np.ndarray]:
        if len(held) < 2:
            return []
        held.sort(key=lambda row: row[0])
        split = None if shard[1] == shard[2] else sum(row[0] == 0 for row in held)
        if split in (0, len(held)):
            return []
        node, copies = (np.array([row[k] for row in held], dtype=np.int64) for k in (1, 2))
        found = links_among([np.frombuffer(row[3], dtype=np.uint64) for row in held], split)
        if not counts:
            return [np.stack([np.minimum(node[x], node[ys]), np.maximum(node[x], node[ys])]) for x, ys in found if len(ys)]
        n = np.zeros(len(node), dtype=np.int64)
        for x, ys in found:
            n[x] += copies[ys].sum()
            n[ys] += copies[x]
        return [np.stack([node, n])[:, n > 0]]

    dealt = shards.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    return dealt.mapInArrow(search, ", ".join(f"{c} bigint" for c in schema.names))


def found_components(docs: DataFrame, text: str, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, described, nodes, linked): the texts, what ``describe`` says of them, the distinct
    sets, and (node, label) of the sets that are linked with another one."""
    rows = bodies(docs, text, id_col)
    described = describe(rows)
    texts = described.where(F.col("chunk").isNull() & (F.col("n") > 0))
    nodes = stage(texts.groupBy("node", "n", "hashes", "vector").agg(
        F.min("doc_id").alias("rep"), F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("mark"), F.count("*").alias("copies")), "jaccard-nodes")

    links = verify(first_pairs(nodes), rows, nodes)
    first = components(links).select("node", F.col("label").alias("found"))
    labelled = stage(nodes.join(first, "node", "left").select("node", "n", F.coalesce("found", "node").alias("label"), "vector"), "jaccard-labelled")
    more = verify(second_pairs(rows, described, labelled), rows, nodes)
    return rows, described, nodes, components(links.unionByName(more)).select("node", "label")


def named_documents(described: DataFrame, nodes: DataFrame, linked: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every text, and n_links if the links of the nodes
    (node, n) are ``counted``."""
    placed = nodes.join(linked, "node", "left").select("node", "rep", "copies", F.coalesce("label", "node").alias("label"))
    least = placed.groupBy(F.col("label").alias("of")).agg(F.min("rep").alias("component_id"))
    named = placed.join(least, F.col("label") == F.col("of")).select(F.col("node").alias("its_node"), "component_id", "copies")
    if counted is not None:
        per = counted.groupBy(F.col("node").alias("at")).agg(F.sum("n").alias("others"))
        named = named.join(per, F.col("its_node") == F.col("at"), "left").select(
            "its_node", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("its_links"))
    else:
        named = named.select("its_node", "component_id")
    named = stage(named, "jaccard-named")
    every = described.where(F.col("chunk").isNull())
    worded = F.col("n") > 0
    more = [] if counted is None else [F.coalesce("its_links", F.lit(0)).cast("long").alias("n_links")]
    return (every.join(named, worded & (F.col("node") == F.col("its_node")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(worded, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *more))


def shards_of(rows: DataFrame, nodes: DataFrame, linked: DataFrame) -> DataFrame:
    sets = sets_of(rows, nodes, linked.select("node"))
    return link_shards(sets, nodes.select("node", "n", "copies").join(linked, "node"))


def jaccard_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    component_id is the least doc_id among the rows reachable by links (sets of word
    5-grams with 100 * intersection >= 80 * union), the row itself included.  Rows
    without words, null texts included, are linked with nothing and keep their own id;
    fewer than five words are one shingle.  Null ids never name a component unless all
    its ids are null; repeated rows are linked like any equal texts; an empty table
    gives no rows; other columns are not read.
    """
    _, described, nodes, linked = found_components(docs, text, id_col)
    return named_documents(described, nodes, linked)


def jaccard_result(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``jaccard_components`` and n_links: with how many other rows a row is linked, rows of
    equal texts among them; 0 for a row without words."""
    rows, described, nodes, linked = found_components(docs, text, id_col)
    return named_documents(described, nodes, linked, search_links(shards_of(rows, nodes, linked), counts=True))


def jaccard_links(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """a, b, doc_a, doc_b, copies_a, copies_b: every link of two different sets, once.

    A set goes by its id (a < b), the least doc_id that has it (null if all are null) and
    the number of rows that have it: a link stands for copies_a * copies_b links of rows.
    """
    rows, _, nodes, linked = found_components(docs, text, id_col)
    pairs = search_links(shards_of(rows, nodes, linked), counts=False)
    end = lambda x: nodes.select(F.col("node").alias(x), F.col("rep").alias(f"doc_{x}"), F.col("copies").alias(f"copies_{x}"))
    return pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", "doc_a", "doc_b", "copies_a", "copies_b")


def keep_one_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: the one with the least id.

    Rows without words stay, and so do rows with a null id, which can't be told apart.
    Rows that share an id stay or go together (they stay if one of them should).  Only
    rows that the bitmap of removed ids marks are joined; the others pass untouched.
    """
    found = jaccard_components(docs, text, id_col).where(F.col("doc_id").isNotNull())
    gone = stage(found.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("kept"))
                 .where("kept = 0").select(F.col("doc_id").alias("gone")), "jaccard-gone")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(gone.select(F.col("gone").alias("value"))))  # at most BITS / 8 bytes
    ids = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("mark"))

    def flag(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap_ = opened(bits.value)
        for batch in it:
            hit = hits(bitmap_, batch.column("mark").to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(hit)], names=["row", "mark"])

    flagged = ids.mapInArrow(flag, ids.schema)
    checked = flagged.where("mark = 1").join(gone, F.col("row")[id_col].cast("long") == F.col("gone"), "left_anti")
    return flagged.where("mark = 0").unionByName(checked).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
