"""Daily incremental loads: half-open day slices, work grids, one job per range of days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sinks.writers import write_keys


def day_range(first: date, last: date) -> list[date]:
    """Every calendar day from ``first`` to ``last`` inclusive."""
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def days_of(df: DataFrame, time_col: str) -> list[date]:
    """The days spanned by ``time_col`` (one small aggregate; two scalars reach the driver)."""
    lo, hi = df.agg(F.min(F.to_date(time_col)), F.max(F.to_date(time_col))).first()
    return [] if lo is None else day_range(lo, hi)


def day_slice(df: DataFrame, time_col: str, days: Sequence[date]) -> DataFrame:
    """Rows whose day is one of ``days`` — each day the half-open ``[d, d + 1)``, so no
    row lands in two runs — with that day as ``dt``.  The outer bounds are literals,
    so a parquet scan pushes them down; days between them that were not asked for
    are filtered out, so a run never touches them."""
    lo, hi = min(days), max(days) + timedelta(days=1)
    t = F.col(time_col)
    sliced = (df.where((t >= F.lit(lo).cast(df.schema[time_col].dataType))
                       & (t < F.lit(hi).cast(df.schema[time_col].dataType)))
                .withColumn("dt", F.to_date(t)))
    if len(set(days)) < (hi - lo).days:  # gaps in the requested days
        sliced = sliced.where(F.col("dt").isin(sorted(set(days))))
    return sliced


def work_grid(keys: DataFrame, days: Sequence[date], exclude: DataFrame | None = None) -> DataFrame:
    """Keys × days as a DataFrame (each key row exploded over the day list).

    ``exclude`` lists keys to leave out (e.g. deprecated roles); it is an anti join
    on the key columns, so the grid never needs to reach the driver for it.
    """
    if exclude is not None:
        keys = keys.join(exclude, list(exclude.columns), "left_anti")
    return keys.select("*", F.explode(F.array(*[F.lit(d) for d in days])).alias("dt"))


def run_days(df: DataFrame, base: str, time_col: str, days: Sequence[date],
             keys: Sequence[str] = (), requested_keys: DataFrame | None = None,
             transform=None, fmt: str = "parquet", stage: str | None = None) -> None:
    """Load a range of days in one job, partitioned by ``dt`` and ``keys``.

    Idempotent per (day, key): rerunning a range replaces exactly those partitions.
    The work grid is ``requested_keys`` × days (default: the keys found in the
    source over the range); grid cells without rows are cleared.

    The slice is read more than once (keys, then the write).  ``stage`` (a folder in
    the shared scratch area) writes it once as parquet first, so a costly or
    non-deterministic ``transform`` runs once and every step sees the same rows.
    """
    if not days:
        return
    sliced = day_slice(df, time_col, days)
    if transform is not None:
        sliced = transform(sliced)
    if stage is not None:
        sliced.write.mode("overwrite").parquet(stage)
        sliced = df.sparkSession.read.parquet(stage)
    key_rows = requested_keys if requested_keys is not None else sliced.select(*keys).distinct()
    grid = work_grid(key_rows, days) if keys else None
    if grid is None:
        grid = df.sparkSession.createDataFrame([(d,) for d in days], "dt date")
    write_keys(sliced, base, ["dt", *keys], requested=grid, fmt=fmt)


def read_keyed(spark: SparkSession, base: str, schema: StructType,
               partitions: Mapping[str, str], fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Read a keyed dataset with the partition columns typed explicitly.

    Declaring them stops inference from turning ``role_id=01`` into the integer 1.
    """
    full = StructType([f for f in schema.fields if f.name not in partitions])
    for name, type_ in partitions.items():
        full = full.add(name, type_)
    return spark.read.schema(full).format(fmt).options(**(options or {})).load(base)
