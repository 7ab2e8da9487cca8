"""Exactly-once streaming into keyed parquet: a ledger of batches.

Structured Streaming promises ``foreachBatch`` that a batch id stands for the same input
every time, and may run a batch again after a failure.  Here each batch writes a folder
of its own, ``<base>/batch=<id>/k=v/...``, replaced as a whole by a replay, and then one
row in the ledger, ``<base>/_ledger/batch=<id>``.  Readers see the batches of the ledger:

* a batch that stopped between write and ledger is invisible, and replaced when it runs again;
* a batch that stopped between ledger and the stream's checkpoint replaces itself by the same rows;
* batches of another checkpoint (a stream started anew) are refused instead of mixed in:
  the ledger holds the stream's id.

``fold_batches`` merges old batches into one, so that readers do not list a folder per trigger for ever.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.sinks.writers import delete_paths, path_exists

LEDGER_SCHEMA = "stream string, batch bigint, folds array<bigint>, n_rows bigint, written_at timestamp"


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """One row per entry: (stream, batch, folds: the batches this one stands for, n_rows, written_at)."""
    path = f"{base.rstrip('/')}/_ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def live_batches(spark: SparkSession, base: str) -> DataFrame:
    """Numbers of the batches whose folders hold the rows now (``batch``): entered and not folded."""
    entries = ledger(spark, base)
    folded = entries.select(F.explode("folds").alias("folded"))
    return entries.select("batch").distinct().join(folded, F.col("batch") == F.col("folded"), "left_anti")


def _enter(rows: DataFrame, base: str, batch_id: int, stream: str, folds: list[int] | None = None) -> None:
    """Write the ledger's row of a batch: one small file, which appears as a whole or not at all."""
    row = rows.agg(F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch"),
                   F.lit(folds).cast("array<bigint>").alias("folds"), F.count(F.lit(1)).alias("n_rows"),
                   F.current_timestamp().alias("written_at"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{base}/_ledger/entry={batch_id}")


def commit_batch(batch: DataFrame, batch_id: int, base: str, keys: Sequence[str], stream: str = "stream",
                 before_ledger: Callable[[int], None] | None = None) -> None:
    """Write one micro-batch and enter it in the ledger; running it again replaces it.

    Rows are rebalanced on ``keys``: few files per key, and a hot key is split over tasks.
    ``before_ledger`` is called between the two steps (tests let it fail).
    """
    spark, base = batch.sparkSession, base.rstrip("/")
    others = ledger(spark, base).where(F.col("stream") != stream).limit(1).collect()
    if others:
        raise ValueError(f"{base} holds batches of the stream {others[0]['stream']!r}; {stream!r} needs a folder of its own")
    if ledger(spark, base).where(F.array_contains("folds", F.lit(batch_id).cast("bigint"))).limit(1).collect():
        return  # merged into another folder since: its rows are there
    out = f"{base}/batch={batch_id}"
    batch.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "static") \
         .partitionBy(*keys).parquet(out)
    if before_ledger is not None:
        before_ledger(batch_id)
    _enter(spark.read.schema(batch.schema).parquet(out), base, batch_id, stream)


def start_keyed_stream(rows: DataFrame, base: str, keys: Sequence[str], checkpoint: str, stream: str = "stream",
                       trigger: str | None = None, available_now: bool = False,
                       before_ledger: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start ``rows`` (a stream) into parquet under ``base``, partitioned by ``keys``, each row once."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: commit_batch(batch, batch_id, base, keys, stream, before_ledger))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger is not None:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_committed(spark: SparkSession, base: str, schema: StructType, partitions: dict[str, str]) -> DataFrame:
    """The rows of the ledger's batches, the key columns typed by ``partitions``; without batches, none.

    The ledger meets the folders by a semi join on ``batch``, a partition column: Spark prunes the
    folders of batches that are not committed (or were folded) before it opens a file.
    """
    base = base.rstrip("/")
    full = StructType([f for f in schema.fields if f.name not in partitions])
    for name, type_ in partitions.items():
        full = full.add(name, type_)
    if not path_exists(spark, f"{base}/_ledger"):
        return spark.createDataFrame([], full)
    done = live_batches(spark, base).select(F.col("batch").alias("_done"))
    found = spark.read.schema(StructType(list(full.fields)).add("batch", "long")).parquet(base)
    return found.join(done, F.col("batch") == F.col("_done"), "left_semi").select(*[f"`{f.name}`" for f in full.fields])


def fold_batches(spark: SparkSession, base: str, keys: Sequence[str], schema: StructType, partitions: dict[str, str],
                 upto: int) -> int:
    """Merge the live batches up to ``upto`` into one folder; the number of merged batches.

    The merged folder takes a negative number, which no stream uses.  Its single ledger row
    both enters it and says which batches it stands for, so readers see either the old
    folders or the new one.  The old folders stay for readers that began before; see
    :func:`drop_folded`.  A replay of a folded batch is recognised and does nothing.
    """
    base = base.rstrip("/")
    old = sorted(r[0] for r in live_batches(spark, base).where(F.col("batch") <= upto).collect())  # one number per trigger since the last fold
    if len(old) < 2:
        return 0
    number = -old[-1] - 1  # rises in size with the newest batch, so no two folds share it
    full = StructType([f for f in schema.fields if f.name not in partitions])
    for name, type_ in partitions.items():
        full = full.add(name, type_)
    rows = spark.read.schema(full.add("batch", "long")).parquet(base).where(F.col("batch").isin(old)).drop("batch")
    out = f"{base}/batch={number}"
    rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(out)
    stream = ledger(spark, base).select("stream").first()[0]
    _enter(spark.read.schema(schema).parquet(out), base, number, stream, old)
    return len(old)


def drop_folded(spark: SparkSession, base: str) -> int:
    """Remove the folders and ledger rows of folded batches (when no reader uses them any more)."""
    base = base.rstrip("/")
    live = {r[0] for r in live_batches(spark, base).collect()}
    folded = [r[0] for r in ledger(spark, base).select(F.explode("folds")).distinct().collect() if r[0] not in live]
    paths = [p for b in folded for p in (f"{base}/batch={b}", f"{base}/_ledger/entry={b}") if path_exists(spark, p)]
    delete_paths(spark, paths)
    return len(paths)
