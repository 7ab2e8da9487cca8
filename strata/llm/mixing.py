"""Mixing sources to target weights: token blocks, multinomial draws, index permutations.

DataFrame functions only.

1. A source's documents, in the order of a hash of their ids, form one stream of words;
   ``layout`` gives every document its place in it.  The running sum takes two levels
   (buckets of a bounded number of documents, then sums of buckets), so a source of any
   size is spread over many tasks.
2. ``targets`` shares all words by weight under the cap: sources are numbered by a range sort, and
   the level at which the cap binds is closed in on by histograms of bounded size, so no
   task and not the driver holds all sources, of which there may be as many as hosts.
3. The stream is cut into blocks of ``BLOCK`` words; a source's target is so many block
   draws.  ``draws`` deals every draw to an output shard at random, which makes each
   source's counts over the shards multinomial given its total, and so the total exact.
4. A source's slots are numbered through the shards; ``slots`` maps slot number to block
   by a pseudorandom permutation of the block indexes, a Feistel network keyed by source and
   pass, so no block is used once more before all others of its source.
5. Slots join blocks by (source, index): ``mixture`` has a row per slot and piece of a document,
   from which the words each document gives are summed; ``mixed_blocks`` has the blocks' words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import stage

#: Words in a block, blocks in an output shard, rows in a bucket of the running sum, and rows of
#: a group of such sums.
BLOCK, SHARD_BLOCKS, BUCKET_ROWS, GROUP = 64, 16_384, 2_000, 10_000
#: Rounds of the Feistel network; how often an index outside the range may be sent on; bins of a histogram.
ROUNDS, WALK, BINS = 4, 64, 1024
#: No source is used more often than this.
CAP = 3
WEIGHTS = (1, 2, 3)

#: A document's words (fixed by the contract).
WORDS = r"[^\x20\x09-\x0D]+"
def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def sized(df: DataFrame, text: str, source: str, id_col: str, uid: str | None = None) -> DataFrame:
    """uid, key, doc_id, source, size: ``key`` orders rows by content, ``uid`` tells them apart (a column, or made here)."""
    columns = [F.col(f"`{c}`") for c in (id_col, text, source)]
    return df.select((F.monotonically_increasing_id() if uid is None else F.col(uid)).alias("uid"), F.xxhash64(*columns).alias("key"), columns[0].alias("doc_id"),
                     columns[2].cast("string").alias("source"), word_count(columns[1].cast("string")).alias("size"))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` + ``number``: 0, 1, 2... in ``order``, by a range sort and the sizes of its partitions."""
    sorted_ = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("mid", F.monotonically_increasing_id()), "mix-numbered")
    part = F.shiftright("mid", 33)
    sizes = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row per partition
    starts, at = [], 0
    for r in sizes:
        starts += [F.lit(r["part"]), F.lit(at)]
        at += r["n"]
    begin = F.element_at(F.create_map(*starts), part) if starts else F.lit(0)
    return sorted_.withColumn("number", (begin + F.col("mid").bitwiseAND((1 << 33) - 1)).cast("long")).drop("mid")


def cap_level(held: DataFrame) -> float | None:
    """The level L at which sum(min(room, L * weight)) over (weight, room) is the sum of ``size``; None if every room is used up.

    A source is capped if its room per weight is below L.  The sum rises with L, so its values at
    the ends of a histogram's BINS bins tell in which bin L lies; that bin is divided again
    until none of its sources is capped, and L follows from the sums of those before it.
    """
    held = held.where("room > 0").withColumn("ratio", F.col("room") / F.col("weight"))
    whole = held.agg(F.sum("size").alias("total"), F.sum("room").alias("room"), F.min("ratio").alias("low"), F.max("ratio").alias("high")).first()
    if whole["total"] is None or whole["room"] <= whole["total"]:
        return None
    low, high = whole["low"], whole["high"]  # sources below ``low`` are capped, those above ``high`` are not
    while True:
        between = (F.col("ratio") >= low) & (F.col("ratio") <= high)
        width = (high - low) / BINS
        bin_ = F.least(F.floor((F.col("ratio") - low) / F.lit(width)), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        place = F.when(between, bin_).when(F.col("ratio") < low, F.lit(-1)).otherwise(F.lit(BINS))
        bins = sorted(held.groupBy(place.alias("bin")).agg(F.sum("room").alias("room"), F.sum("weight").alias("weight"),
                                                           F.min("ratio").alias("low"), F.max("ratio").alias("high")).collect(), key=lambda r: r["bin"])
        room, weight = 0.0, sum(r["weight"] for r in bins)  # of the sources so far, of those still to come
        for r in bins:
            if r["bin"] >= 0 and room + r["room"] + r["high"] * (weight - r["weight"]) >= whole["total"]:  # L is at most this bin's end
                if r["low"] == r["high"] or room + r["low"] * weight >= whole["total"]:  # and none of it is capped
                    return (whole["total"] - room) / weight
                low, high = r["low"], r["high"]
                break
            room, weight = room + r["room"], weight - r["weight"]
        else:  # only by rounding: every cap binds
            return None


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, blocks, n_draws) per source from the column ``size``.

    Weights repeat over the sources by code point, null last.  Sources whose cap binds get
    it, the rest share by weight what is left.
    """
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    # one range sort: a null after every text
    ranked = numbered(one, F.col("source").isNull(), F.col("source")).withColumn("weight", F.get(weight, (F.col("number") % len(weights)).cast("int")))
    ranked = stage(ranked.select("source", "source_size", "weight", (cap * F.col("source_size")).cast("double").alias("room")), "mix-weights")
    level = cap_level(ranked.select("weight", "room", F.col("source_size").alias("size")))
    target = F.col("room") if level is None else F.least(F.lit(level) * F.col("weight"), F.col("room"))
    blocks = F.ceil(F.col("source_size") / BLOCK)
    return ranked.select("source", "source_size", target.alias("target"), blocks.alias("blocks")).withColumn(
        "n_draws", F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long"),
                                                            cap * F.col("blocks"))).otherwise(0))


def running_before(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """``df`` + ``out``: the sum of ``value`` over the rows of ``key`` with a smaller ``order`` (0, 1, 2...).

    Two levels: within groups of GROUP consecutive orders, then over the groups' sums, so a
    key with very many rows is no task's alone.
    """
    grouped = df.withColumn("_g", F.expr(f"{order} div {GROUP}"))
    sums = grouped.groupBy(F.col(key).alias("_k"), F.col("_g").alias("_h")).agg(F.sum(value).alias("_s"))
    over = Window.partitionBy("_k").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_k", "_h", F.coalesce(F.sum("_s").over(over), F.lit(0)).alias("_start"))
    within = Window.partitionBy(key, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = grouped.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (local.join(starts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_g") == F.col("_h")))
            .withColumn(out, F.col("_start") + F.col("_local")).drop("_g", "_k", "_h", "_start", "_local"))


def layout(sizes: DataFrame, n_rows: int) -> DataFrame:
    """``sizes`` + ``begin``: words of the source's stream before the document.

    Documents go by ``key``; its buckets hold about BUCKET_ROWS rows of all sources, so a
    window never sees more, whatever the source.  Rows alike in id, text and source have
    one key; their order among themselves makes no difference to the result.
    """
    n_buckets = max(1, -(-n_rows // BUCKET_ROWS))
    dealt = sizes.withColumn("bucket", F.pmod("key", F.lit(n_buckets)))
    per_bucket = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    starts = stage(running_before(per_bucket, "source", "bucket", "bucket_size", "start").select(
        F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "start"), "mix-buckets")
    within = Window.partitionBy("bucket", "source").orderBy("key", "uid").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = local.join(starts, (F.col("bucket") == F.col("b_bucket")) & F.col("source").eqNullSafe(F.col("b_source")))
    return joined.withColumn("begin", F.col("start") + F.col("local")).select(*sizes.columns, "begin")


def spread(per_source: DataFrame) -> tuple[int, int]:
    """(output shards, tasks): the few rows of a plan that explode into draws and slots are dealt over so
    many tasks by number, as Spark would put small rows together before they grow."""
    all_draws = per_source.agg(F.sum("n_draws")).first()[0] or 0
    n_shards = max(1, -(-all_draws // SHARD_BLOCKS))
    return n_shards, max(8, min(n_shards, 10_000))


def draws(per_source: DataFrame) -> DataFrame:
    """(source, shard, n): block draws of each source in each output shard.

    Every draw falls into one of the shards by a hash of (source, draw): multinomial
    counts that add up to the source's draws.  Draws are made in runs of at most 10,000
    rows per source row and counted in the same task.
    """
    n_shards, tasks = spread(per_source)
    shards = per_source.withColumn("shards", F.lit(n_shards))
    runs = (shards.where("n_draws > 0")
            .select("source", "blocks", "shards", "n_draws", F.explode(F.expr("sequence(0L, n_draws - 1, 10000L)")).alias("at"))
            .repartition(tasks, "source", "at"))
    single = runs.select("source", "blocks", "shards", F.explode(F.expr("sequence(at, least(at + 10000, n_draws) - 1)")).alias("draw"))
    shard = F.pmod(F.xxhash64(F.lit("shard"), F.coalesce("source", F.lit("\x00")), "draw"), F.col("shards"))
    return single.groupBy("source", "blocks", shard.alias("shard")).agg(F.count("*").alias("n"))


def network(x: Column, turn: Column, blocks: Column, source: Column) -> Column:
    """One pass of an index through the Feistel network: below a * b, just above ``blocks``."""
    a = F.ceil(F.sqrt(blocks.cast("double"))).cast("long")
    b = F.ceil(blocks / a).cast("long")
    left, right = F.floor(x / b).cast("long"), x % b
    for i in range(0, ROUNDS, 2):
        left = (left + F.pmod(F.xxhash64(F.lit(i), source, turn, right), a)) % a
        right = (right + F.pmod(F.xxhash64(F.lit(i + 1), source, turn, left), b)) % b
    return left * b + right


def walked(once: Column, turn: Column, blocks: Column, source: Column) -> Column:
    """The index below ``blocks`` to which ``once``, what ``network`` made of an index, leads.

    Only an index that came out at or above ``blocks`` walks on: Spark interprets the walk and
    makes objects at every step, which for every slot is more garbage than all else here.
    """
    end = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda x, _: F.when(x < blocks, x).otherwise(network(x, turn, blocks, source)))
    error = F.raise_error(F.lit("an index left the range too often")).cast("long")
    return F.when(once < blocks, once).otherwise(F.when(end < blocks, end).otherwise(error))


def permuted(index: Column, turn: Column, blocks: Column, source: Column) -> Column:
    """A pseudorandom permutation of 0 .. blocks - 1 for each source and turn.

    An index is a pair (left, right) below (a, b) with a * b just above ``blocks``; the rounds of
    a Feistel network add a keyed hash of one half to the other.  What comes out at or above
    ``blocks`` goes through again: these are fewer than a of a * b pairs, so no chain of
    them comes near WALK (and it would be an error, not a wrong index).
    """
    return walked(network(index, turn, blocks, source), turn, blocks, source)


def slots(per_source: DataFrame) -> DataFrame:
    """(source, shard, slot, turn, block): the mix, slot by slot, as block indexes."""
    placed = running_before(draws(per_source), "source", "shard", "n", "first")
    every = placed.repartition(spread(per_source)[1], "source", "shard").select("source", "blocks", "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot"))
    key = F.coalesce("source", F.lit("\x00"))
    # the network's result is a column of its own, as conditions would work it out at each use
    passed = every.select("source", "shard", "slot", "blocks", F.expr("slot div blocks").alias("turn"),
                          network(F.col("slot") % F.col("blocks"), F.expr("slot div blocks"), F.col("blocks"), key).alias("once"))
    return passed.select("source", "shard", "slot", "turn", walked(F.col("once"), F.col("turn"), F.col("blocks"), key).alias("block"))


def pieces(placed: DataFrame) -> DataFrame:
    """(uid, source, block, from, to): the part of each document that lies in each block."""
    cut = placed.where("size > 0").select("uid", "source", "begin", "size", F.explode(
        F.expr(f"sequence(begin div {BLOCK}, (begin + size - 1) div {BLOCK})")).alias("block"))
    return cut.select("uid", "source", "block", F.greatest("begin", F.col("block") * BLOCK).alias("from"),
                      F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * BLOCK).alias("to"))


def mixture(chosen: DataFrame, parts: DataFrame) -> DataFrame:
    """The mix itself: every slot with the document pieces of its block, joined by index."""
    block = parts.select(F.col("source").alias("p_source"), F.col("block").alias("p_block"), "uid", "from", "to")
    return chosen.join(block, (F.col("block") == F.col("p_block")) & F.col("source").eqNullSafe(F.col("p_source"))).drop("p_source", "p_block")


def mix(df: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source",
        uid: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, slots, pieces) of the mix of all of ``df``.

    * documents: uid, doc_id, source, size, source_size, target, taken per row of ``df``,
    * slots: source, shard, slot, turn, block,
    * pieces: uid, source, block, from, to (in words of the source's stream);
      ``mixture(slots, pieces)`` joins them.

    Null texts have no words; null sources are a source, last in order; null and repeated
    ids are fine, as rows have a number of their own; an empty table or texts without
    words leave nothing to mix; other columns are not read.  Everything drawn is a hash
    of contents, so reruns agree.
    """
    rows = stage(sized(df, text, source, id_col, uid), "mix-sizes")
    per_source = stage(targets(rows), "mix-targets")
    placed = stage(layout(rows, rows.count()), "mix-layout")
    chosen = stage(slots(per_source), "mix-slots")
    parts = pieces(placed)
    # what a document gives is what the joined mix holds of it, piece by piece
    taken = mixture(chosen, parts).groupBy(F.col("uid").alias("t_uid")).agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    per_row = per_source.select(F.col("source").alias("s_source"), "source_size", "target")
    documents = (rows.join(taken, F.col("uid") == F.col("t_uid"), "left")
                 .join(per_row, F.col("source").eqNullSafe(F.col("s_source")))
                 .select("uid", "doc_id", "source", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))
    return documents, chosen, parts


def mixed_blocks(df: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix as text: source, shard, slot, words (at most BLOCK, joined by a space), uids of the documents they come from.

    A document is cut into its blocks' pieces where it is read, and a piece goes to the
    slots that drew its block: texts cross the network piece by piece, never whole.
    A block's pieces meet in the order of the source's stream, at most BLOCK of them.
    """
    columns = [F.col(f"`{c}`") for c in (id_col, text, source)]
    texts = stage(df.select(F.monotonically_increasing_id().alias("uid"), columns[0].alias("doc_id"), columns[1].cast("string").alias("text"),
                            columns[2].alias("source")), "mix-texts")
    _, chosen, parts = mix(texts, uid="uid")
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), F.lit(0))
    bodies = texts.select("uid", words.alias("words"))
    begins = parts.groupBy("uid").agg(F.min("from").alias("begin"), F.collect_list(F.struct("source", "block", "from", "to")).alias("parts"))
    cut = bodies.join(begins, "uid").select("uid", "words", "begin", F.explode("parts").alias("p")).select(
        "uid", F.col("p.source").alias("source"), F.col("p.block").alias("block"), F.col("p.from").alias("from"), F.col("p.to").alias("to"),
        F.expr("array_join(slice(words, cast(p.from - begin + 1 as int), cast(p.to - p.from as int)), ' ')").alias("piece"))
    found = mixture(chosen, cut.select("uid", "source", "block", F.struct("from", "piece").alias("from"), "to"))
    return found.groupBy("source", "shard", "slot").agg(F.sort_array(F.collect_list(F.struct("from", "uid"))).alias("all")).select(
        "source", "shard", "slot", F.array_join(F.transform("all", lambda p: p["from"]["piece"]), " ").alias("words"),
        F.transform("all", lambda p: p["uid"]).alias("uids"))


def mix_result(df: DataFrame) -> DataFrame:
    """The query contract's columns."""
    return mix(df)[0].select("doc_id", "size", "source_size", "target", "taken")
