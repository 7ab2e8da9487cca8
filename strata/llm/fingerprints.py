"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

For sample ``d`` every term has three numbers drawn by hash: r and c from Gamma(2, 1) and
b from [0, 1).  A term of weight S gives t = floor(ln S / r + b) and
ln a = ln c - r (t - b + 1); the sample is the least a over the text's terms.  Two texts
have the same least a exactly if the same (term, t) won, which happens with the
probability of their generalised Jaccard similarity, the sum of the smaller over the sum
of the larger weights.  Terms are words, weights are counts.

A text crosses the network once, on its way to a key (id and text hash); words are
exploded, counted and reduced to samples in the same task, as their grouping begins with
that key.  Words of a text and of its edited form are counted together, so the hashes
and logarithms of a term serve both; the edited text's SHA-256 goes along as one more row.

Logarithms are most of the work, and most terms are far from winning.  With the uniform
numbers u1..u4 of a draw (r = -ln u1 u2, c = -ln u3 u4) no a is below u1 u2 / S times
4 (1 - x) / (1 + x), x = sqrt(u3 u4), as r (t - b + 1) <= ln S + r and -ln x >= 2 (1 - x) / (1 + x).
The least a of a text of weight W is above REACH / W once in exp(REACH) samples, so terms
whose bound is above (by more than rounding) are passed over; a text that has a sample
without a term below is worked out again with all of its terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import stage

#: Samples of a fingerprint; a text's least a is sought below this number divided by its weight.
SAMPLES, REACH = 64, 20.0
WORDS = r"[^\x20\x09-\x0D]+"
TWO32 = float(1 << 32)


def places(docs: DataFrame) -> DataFrame:
    """(no_id, k, h, copies, n_chars, rank, total): the distinct (id, text) pairs in descending id
    order, nulls last, by text hash within an id.

    A range sort deals the rows out; ranks are positions in their partition plus the
    partition's offset, which is a sum over as many rows as there are partitions.
    """
    distinct = docs.groupBy("no_id", "k", "h").agg(F.count("*").alias("copies"), F.max("n_chars").alias("n_chars"))
    dealt = distinct.repartitionByRange(F.col("no_id"), F.col("k").desc(), F.col("h"))
    numbered = stage(dealt.sortWithinPartitions("no_id", F.col("k").desc(), "h")
                     .withColumn("mid", F.monotonically_increasing_id()), "cws-order")
    part = F.shiftright("mid", 33)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = stage(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(total).alias("total")), "cws-offsets")
    return numbered.withColumn("part", part).join(offsets, "part").select(
        "no_id", "k", "h", "copies", "n_chars", (F.col("offset") + F.col("mid").bitwiseAND((1 << 33) - 1)).alias("rank"), "total")


def successions(ranked: DataFrame) -> DataFrame:
    """(no_id, k, h, copies, n_chars, next_k, next_h): every place and the one after it, the first
    after the last."""
    follow = ranked.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("rank").alias("next_rank"))
    return ranked.withColumn("next_rank", (F.col("rank") + 1) % F.col("total")).join(follow, "next_rank").drop("next_rank", "rank", "total")


def low(h: Column) -> Column:
    return (h.bitwiseAND((1 << 32) - 1) + F.lit(0.5)) / TWO32


def high(h: Column) -> Column:
    return (F.shiftrightunsigned(h, 32) + F.lit(0.5)) / TWO32


def samples(word: str, main: str, edited: str, first: Column, count: int) -> tuple[list[Column], list[Column]]:
    """ln a of samples first .. first + count - 1 for the two weights; null for weight 0."""
    hashed = [sample(F.xxhash64(F.col(word), first + j), main, edited) for j in range(count)]
    return [m for m, _ in hashed], [e for _, e in hashed]


def sample(one: Column, main: str, edited: str) -> tuple[Column, Column]:
    """ln a for the two weights, by the hash of term and sample."""
    two = F.xxhash64(one)
    r = -F.log(low(one) * high(one))
    ln_c = F.log(-F.log(low(two) * high(two)))
    b = high(F.xxhash64(two))
    t = [F.floor(F.col(weight) / r + b) for weight in (main, edited)]
    return ln_c - r * (t[0] - b + 1), ln_c - r * (t[1] - b + 1)


def least_possible(one: Column) -> Column:
    """No a of the sample is below this number divided by the weight."""
    two = F.xxhash64(one)
    root = F.sqrt(low(two) * high(two))
    return 4 * (1 - root) / (1 + root) * (low(one) * high(one))


def signatures(texts: DataFrame, reach: float | None = REACH) -> DataFrame:
    """(k, h, edited_sha256, sig, edited_sig): arrays of SAMPLES ints from columns k, h, text, edited.

    A text without words has the one term "".  ``texts`` should be partitioned by (k, h),
    and then nothing is shuffled here.  A sig is null if one of its samples has no a up to
    ``reach`` / W; without ``reach`` every term is worked out for every sample.
    """
    words = lambda c: F.regexp_extract_all(F.col(c), F.lit(WORDS), F.lit(0))
    some = lambda c: F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit("")))
    cut = (texts.select("k", "h", words("text").alias("m"), words("edited").alias("e"), F.sha2("edited", 256).alias("sha"))
           .select("k", "h", some("m").alias("m"), some("e").alias("e"), "sha")
           .select("k", "h", F.size("m").alias("n_m"), F.size("e").alias("n_e"), F.posexplode(F.concat(
               "m", "e", F.array(F.concat_ws(":", "sha", F.size("m"), F.size("e"))))).alias("at", "word")))  # after the words one row with what is told of the text
    main, tells = F.col("at") < F.col("n_m"), F.col("at") == F.col("n_m") + F.col("n_e")
    counts = cut.groupBy("k", "h", "n_m", "n_e", tells.alias("tells"), "word").agg(F.count_if(main).alias("m"), F.count_if(~main).alias("e"))
    near = lambda side: F.col(side) * F.lit((reach or 0.0) * (1 + 1e-5)) / F.col(f"n_{side}")
    logs = counts.select("k", "h", F.when(F.col("tells"), F.col("word")).alias("told"), F.xxhash64("word").alias("word"),
                         F.log(F.col("m")).alias("m"), F.log(F.col("e")).alias("e"), F.greatest(near("m"), near("e")).alias("near"))
    hashes = F.array(*[F.xxhash64("word", F.lit(j)) for j in range(SAMPLES)])
    rows = logs.select("*", F.posexplode(F.when(F.col("told").isNull(), hashes).otherwise(F.array(F.lit(0).cast("long")))).alias("j", "one"))
    if reach is not None:
        rows = rows.where(F.col("told").isNotNull() | (least_possible(F.col("one")) <= F.col("near")))
    m, e = sample(F.col("one"), "m", "e")
    least = rows.select("k", "h", "told", "j", m.alias("m"), e.alias("e")).groupBy("k", "h", "told", "j").agg(F.min("m").alias("m"), F.min("e").alias("e"))
    merged = least.select("k", "h", "told", F.when(F.col("told").isNull(), F.struct("j", "m", "e")).alias("part")).groupBy("k", "h").agg(
        F.split(F.max("told"), ":").alias("told"), F.array_sort(F.collect_list("part")).alias("parts"))

    def sig(name: str, n: int) -> Column:
        most = F.log(F.lit(reach) / F.element_at("told", n).cast("double")) if reach is not None else F.lit(float("inf"))
        found = (F.size("parts") == SAMPLES) & F.forall("parts", lambda p: F.coalesce(p[name] <= most, F.lit(False)))
        return F.when(found, F.transform("parts", lambda p: F.xxhash64(p[name]).bitwiseAND(0x7FFFFFFF).cast("int")))

    return merged.select("k", "h", F.element_at("told", 1).alias("edited_sha256"), sig("m", 2).alias("sig"), sig("e", 3).alias("edited_sig"))


def likeness(a: str, b: str) -> Column:
    """Share of equal samples."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(SAMPLES))


def text_of(sig: str) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def edited(texts: DataFrame, goes_to: DataFrame) -> DataFrame:
    """(k, h, text, edited) of the places (k, h) of which ``goes_to`` has the place before and the next one.

    Each text meets the key of the place before it, to which its beginning goes; copies meet
    it once.  Every use of the texts takes the same three columns, so they are shuffled once.
    """
    main = texts.join(goes_to, ["k", "h"]).dropDuplicates(["k", "h"])
    begins = main.select("to_k", "to_h", F.expr("substring(text, 1, part)").alias("begin")).withColumnsRenamed({"to_k": "k", "to_h": "h"})
    return main.select("k", "h", "text").join(begins, ["k", "h"]).select(
        "k", "h", "text", F.concat(F.expr("substring(text, 1, length(text) - length(text) div 3)"), "begin").alias("edited"))


def fingerprint_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A document's edited text has its last third (rounded down, code points) replaced by
    as much of the beginning of the next document, in descending id order, the first
    following the last.  Null texts are empty; texts without words are like each other
    and unlike any other; rows alike in id and text stand at one place of the order and
    get equal results; rows alike in id alone go by a hash of their text, null ids come
    last; one row follows itself; an empty table gives no rows; other columns are not read.
    """
    ids, body = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    key = F.xxhash64(ids.isNull(), body)
    after = stage(successions(places(df.select(ids.isNull().alias("no_id"), F.coalesce(ids, F.lit(0)).alias("k"), key.alias("h"),
                                               F.length(body).alias("n_chars")))), "cws-next")

    texts = df.select(F.coalesce(ids, F.lit(0)).alias("k"), key.alias("h"), body.alias("text"))
    goes_to = after.select(F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.expr("n_chars div 3").cast("int").alias("part"),
                           F.col("next_k").alias("k"), F.col("next_h").alias("h"))
    prints = stage(signatures(edited(texts, goes_to), REACH), "cws-prints")
    short = "sig IS NULL OR edited_sig IS NULL"
    again = stage(prints.where(short).select("k", "h"), "cws-again")
    if not again.isEmpty():  # a few texts in a thousand million, and their places are measured by then
        to = again.select(F.col("k").alias("to_k"), F.col("h").alias("to_h"))
        places_ = goes_to.join(again, ["k", "h"], "left_semi").unionByName(goes_to.join(to, ["to_k", "to_h"], "left_semi").select(goes_to.columns)).distinct()
        wanted = edited(texts, stage(places_, "cws-places")).join(again, ["k", "h"], "left_semi")
        prints = prints.where(f"NOT ({short})").unionByName(stage(signatures(wanted, None), "cws-whole"))

    next_sig = prints.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("sig").alias("next_sig"))
    out = (prints.join(after.select("k", "h", "no_id", "copies", F.col("n_chars").cast("long").alias("n_chars"), "next_k", "next_h"), ["k", "h"]).join(next_sig, ["next_k", "next_h"])
           .select(F.when(~F.col("no_id"), F.col("k")).alias("doc_id"), "n_chars", "edited_sha256",
                   text_of("sig").alias("fingerprint"), text_of("edited_sig").alias("edited_fingerprint"),
                   likeness("sig", "edited_sig").alias("near_edited"), likeness("sig", "next_sig").alias("near_next"), "copies"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy")
