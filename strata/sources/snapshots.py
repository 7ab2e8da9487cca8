"""Incremental listing: a stored snapshot of a folder's files, and what differs from it.

A snapshot is a table of (path, length, modified) under ``<path>/v=<n>``, finished when
Spark's ``_SUCCESS`` mark is there.  A listing is compared with the newest snapshot by a
join, so neither is held by the driver, and only files that are new or changed are read.

The order of a run: list (:func:`changes`), process what was added, then
:meth:`Snapshots.commit` that same listing.  A run that stops before the commit sees the
same files as added again; one file is never skipped.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import new_scratch
from strata.sinks.writers import delete_paths
from strata.sources.files import list_files

FILES_SCHEMA = "path string, length bigint, modified timestamp"


class Snapshots:
    """The snapshots of one folder's files, kept at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        return sorted(int(re.search(r"/v=(\d+)/", s.getPath().toString())[1]) for s in found)

    def latest(self) -> DataFrame:
        """The files of the newest snapshot (none before the first)."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], FILES_SCHEMA)
        return self.spark.read.schema(FILES_SCHEMA).parquet(f"{self.path}/v={known[-1]}")

    def commit(self, files: DataFrame, keep: int = 2) -> int:
        """Store ``files`` as the newest snapshot (keeping ``keep``); its number."""
        known = self.versions()
        number = (known[-1] if known else 0) + 1
        # A folder without its mark is a commit that stopped: it may be written over.
        files.select("path", "length", "modified").write.mode("overwrite").parquet(f"{self.path}/v={number}")
        delete_paths(self.spark, [f"{self.path}/v={v}" for v in [*known, number][:-keep]])
        return number


def changes(listing: DataFrame, before: DataFrame) -> DataFrame:
    """(path, length, modified, change) of files that are ``added``, ``changed`` or ``removed`` since ``before``."""
    old = before.select(F.col("path").alias("old_path"), F.col("length").alias("old_length"), F.col("modified").alias("old_modified"))
    both = listing.join(old, F.col("path") == F.col("old_path"), "full_outer")
    same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("modified").eqNullSafe(F.col("old_modified"))
    change = F.when(F.col("old_path").isNull(), "added").when(F.col("path").isNull(), "removed").when(~same, "changed")
    return both.select(F.coalesce("path", "old_path").alias("path"), F.coalesce("length", "old_length").alias("length"),
                       F.coalesce("modified", "old_modified").alias("modified"), change.alias("change")).where("change is not null")


def process_new(spark: SparkSession, prefix: str, snapshots: Snapshots, process: Callable[[list[str]], None],
                glob: str | None = None) -> dict[str, int]:
    """Call ``process`` with the paths of files under ``prefix`` that are new or changed, then store the listing.

    ``process`` is not called when there are none.  The new files' names reach the driver, as
    any read of them needs; the full listing doesn't.  Returns how many files were
    added, changed and removed.  Removed files are only counted: what was read from them stays.
    """
    staged = new_scratch(spark, "listing")
    list_files(spark, prefix, glob).select("path", "length", "modified").write.parquet(staged)
    listing = spark.read.schema(FILES_SCHEMA).parquet(staged)  # one listing, both for the difference and the snapshot
    diff = changes(listing, snapshots.latest())
    counts = {r["change"]: r["count"] for r in diff.groupBy("change").count().collect()}
    paths = [r[0] for r in diff.where(F.col("change").isin("added", "changed")).select("path").orderBy("path").toLocalIterator()]
    if paths:
        process(paths)
    if counts:
        snapshots.commit(listing)
    return {c: counts.get(c, 0) for c in ("added", "changed", "removed")}
