"""Resumable loads: a table of what has been loaded, and runs that do only what is left.

A *cell* is one (day, key) partition of a dataset.  A run first takes a fingerprint of
every cell of its source (one aggregate), compares it with the progress table and is
left with the cells that are new, changed or gone.  It writes them in steps of a few
days; a step's cells are recorded after their files are in place.  So

* a run that stops half way is resumed by the same call: recorded steps are skipped;
* a step that stopped between its write and its record is done again, which replaces
  the same partitions by the same rows;
* an unchanged cell is neither read in full nor written again, and a changed one
  replaces itself alone;
* a cell whose rows are gone is cleared, and recorded as empty.

The fingerprint is taken before the rows are read for the write.  If the source changes in
between, the recorded fingerprint is of the older state, so the next run loads the cell
again.  One run at a time may load a dataset.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.incremental import day_slice, work_grid
from strata.session import new_scratch
from strata.sinks.writers import path_exists, write_keys

#: Fingerprint of a cell without rows.
EMPTY = "0"
PROGRESS_SCHEMA = "dataset string, dt date, cell string, fingerprint string, n_rows bigint, run int, step int, loaded_at timestamp"


def _cell_text(keys: Sequence[str]) -> Column:
    """The key values of a cell as one comparable text (null and empty text differ)."""
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)])) if keys else F.lit("{}")


def _foldered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Empty text keys as null: Spark files both under one folder, so they are one cell."""
    types = dict(df.dtypes)
    return df.withColumns({k: F.nullif(F.col(f"`{k}`"), F.lit("")) for k in keys if types[k] == "string"})


def cell_fingerprints(df: DataFrame, cells: Sequence[str], version: str = "") -> DataFrame:
    """(cells..., n_rows, fingerprint) per cell: a digest of its rows in any order.

    Per cell the row count, the sum and the exclusive or of two 64-bit row hashes, so it
    is one aggregate with a map-side step whatever the skew.  Null flags are hashed beside
    the values, since Spark's hash passes over nulls.  ``version`` (say, of the transform)
    is part of the fingerprint: another version reloads every cell.  Columns of map or variant type
    can't be hashed; cast them to text first.
    """
    values = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in values]
    one, two = F.xxhash64(*values, *nulls), F.xxhash64(F.lit("2"), *nulls, *values)
    parts = (F.count(F.lit(1)).cast("string"), F.sum(one.cast("decimal(20,0)")).cast("string"),
             F.bit_xor(two).cast("string"), F.lit(version))
    return df.groupBy(*cells).agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat_ws(":", *parts), 256).alias("fingerprint"))


class Progress:
    """The progress table of a lake: parquet files at ``path``, appended to, newest row wins."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """Every record ever made (empty before the first)."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS_SCHEMA)
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)

    def latest(self, dataset: str) -> DataFrame:
        """(dt, cell, fingerprint, n_rows, run) as last recorded for ``dataset``."""
        best = F.max(F.struct("run", "step", "fingerprint", "n_rows")).alias("best")
        return (self.rows().where(F.col("dataset") == dataset).groupBy("dt", "cell").agg(best)
                    .select("dt", "cell", "best.fingerprint", "best.n_rows", "best.run"))

    def next_run(self, dataset: str) -> int:
        return (self.rows().where(F.col("dataset") == dataset).agg(F.max("run")).first()[0] or 0) + 1

    def record(self, dataset: str, cells: DataFrame, run: int, step: int) -> None:
        """Append (dt, cell, fingerprint, n_rows) rows; call it after their files are in place."""
        (cells.select(F.lit(dataset).alias("dataset"), "dt", "cell", "fingerprint", "n_rows", F.lit(run).alias("run"),
                      F.lit(step).alias("step"), F.current_timestamp().alias("loaded_at"))
              .coalesce(1).write.mode("append").parquet(self.path))  # a step's few cells: one file, one rename

    def fold(self) -> None:
        """Rewrite the table with the newest row of each cell only (between runs)."""
        best = F.max(F.struct("run", "step", "fingerprint", "n_rows", "loaded_at")).alias("best")
        staged = new_scratch(self.spark, "progress-fold")
        folded = self.rows().groupBy("dataset", "dt", "cell").agg(best).select("dataset", "dt", "cell", "best.*")
        folded.select(*[c.split()[0] for c in PROGRESS_SCHEMA.split(", ")]).write.parquet(staged)
        self.spark.read.schema(PROGRESS_SCHEMA).parquet(staged).coalesce(1).write.mode("overwrite").parquet(self.path)


def due_cells(source: DataFrame, days: Sequence[date], keys: Sequence[str], known: DataFrame,
              requested_keys: DataFrame | None = None, version: str = "") -> DataFrame:
    """(dt, keys..., cell, fingerprint, n_rows) of the cells of ``days`` that differ from ``known``.

    ``known`` is :meth:`Progress.latest`.  Cells without rows are due where they are
    recorded with rows, or asked for (``requested_keys`` x days) and never recorded.
    """
    cells = ["dt", *keys]
    found = cell_fingerprints(source, cells, version).withColumn("cell", _cell_text(keys))
    if requested_keys is not None:
        asked = work_grid(requested_keys.select(*keys).distinct(), days) if keys else requested_keys
        empty = asked.select(*cells, F.lit(0).cast("bigint").alias("n_rows"), F.lit(EMPTY).alias("fingerprint"), _cell_text(keys).alias("cell"))
        have = found.select(F.col("dt").alias("d"), F.col("cell").alias("c"))
        found = found.unionByName(empty.join(have, (F.col("dt") == F.col("d")) & (F.col("cell") == F.col("c")), "left_anti"))
    known = known.where(F.col("dt").isin(list(days))).select(
        F.col("dt").alias("known_dt"), F.col("cell").alias("known_cell"), F.col("fingerprint").alias("known_print"))
    both = found.join(known, (F.col("dt") == F.col("known_dt")) & (F.col("cell") == F.col("known_cell")), "full_outer")
    types = dict(source.select(*cells).dtypes)
    gone = F.col("cell").isNull()
    restored = [F.when(gone, F.get_json_object("known_cell", f"$.k{i}").cast(types[k])).otherwise(F.col(f"`{k}`")).alias(k)
                for i, k in enumerate(keys)]
    return both.select(
        F.coalesce("dt", "known_dt").alias("dt"), *restored, F.coalesce("cell", "known_cell").alias("cell"),
        F.coalesce("fingerprint", F.lit(EMPTY)).alias("fingerprint"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "known_print").where(~F.col("fingerprint").eqNullSafe(F.col("known_print"))).drop("known_print")


def load_days(df: DataFrame, base: str, time_col: str, days: Sequence[date], dataset: str, progress: Progress,
              keys: Sequence[str] = (), requested_keys: DataFrame | None = None,
              transform: Callable[[DataFrame], DataFrame] | None = None, version: str = "", step_days: int = 1,
              fmt: str = "parquet", after_step: Callable[[int], None] | None = None) -> dict[str, int]:
    """Load what is due of ``days`` into ``base``, partitioned by ``dt`` and ``keys``; resume by calling again.

    ``step_days`` days that have something due make a step: one write and one record.  Wider
    steps cost fewer jobs, narrower ones lose less when a run stops.  ``transform`` gets the step's
    rows with ``dt`` and must keep ``dt`` and ``keys``; give its ``version`` when it changes.
    ``after_step`` is called with each recorded step's number; what it raises ends the run.

    The driver holds the days of the range, never cells.  Returns the numbers of the run,
    its steps and the cells it loaded.
    """
    run = progress.next_run(dataset)
    if not days:
        return {"run": run, "steps": 0, "cells": 0}
    spark, cells = df.sparkSession, ["dt", *keys]
    staged = new_scratch(spark, "due")
    if requested_keys is not None:
        requested_keys = _foldered(requested_keys, keys)
    source = _foldered(day_slice(df, time_col, days), keys)
    due_cells(source, days, keys, progress.latest(dataset), requested_keys, version).write.parquet(staged)
    due = spark.read.parquet(staged)
    todo = [r[0] for r in due.select("dt").distinct().orderBy("dt").collect()]
    for step, at in enumerate(range(0, len(todo), step_days), 1):
        some = todo[at:at + step_days]
        mine = due.where(F.col("dt").isin(some))
        asked = mine.select(*[F.col(f"`{c}`").alias(f"due_{i}") for i, c in enumerate(cells)])
        same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"due_{i}")) for i, c in enumerate(cells)])
        rows = _foldered(day_slice(df, time_col, some), keys).join(asked, same, "left_semi")  # unchanged cells of these days stay out
        write_keys(transform(rows) if transform else rows, base, cells, requested=mine, fmt=fmt)
        progress.record(dataset, mine, run, step)
        if after_step is not None:
            after_step(step)
    return {"run": run, "steps": -(-len(todo) // step_days), "cells": due.count()}
