"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.session import new_scratch, ship_package

#: Lower-casing of A-Z only, as a byte table (fixed by the contracts).
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Bytes of an Arrow batch between Spark and Python where the session has Spark's default: rows
#: are whole texts here, and 10,000 of them fill a task's memory twice over.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; also makes the package importable on executors and bounds
    the batches they exchange with Python, unless the session has set its own bound."""
    ship_package(spark)
    key, size = BATCH
    if spark.conf.get(key).rstrip("b") == str(64 << 20):
        spark.conf.set(key, str(size))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of a row group of a staged table: a task's writer holds one in memory.
ROW_GROUP = 32 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with files every executor can reach (a lost executor costs a
    re-read, not a recomputation), fixes the values of non-deterministic columns and
    gives later joins true sizes, so that Spark broadcasts only what it has measured.
    """
    spark = df.sparkSession
    path = new_scratch(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` text bytes (a longer text stands alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = base = 0
    while at < batch.num_rows:
        stop = max(int(np.searchsorted(ends, base + limit, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at, base = stop, int(ends[stop - 1])


def annotate(df: DataFrame, fn: Callable[..., dict[str, list]], out: str, text: str = "text",
             carry: Sequence[str] = ("doc_id",), inputs: Sequence[Column] = (), limit: int = 4_000_000) -> DataFrame:
    """(row, out) per row of ``df``: ``row`` holds the ``carry`` columns, ``out`` what ``fn`` returns.

    ``fn`` gets the texts (null as empty) of about ``limit`` bytes and the values of
    ``inputs``, and returns one list per field of the DDL ``out``.  ``row`` passes through
    Python untouched, so any types, names and nulls survive, and clash with nothing.
    """
    quoted = lambda c: F.col(f"`{c}`")
    # A text that ``row`` holds anyway is taken from there: it crosses to Python once.
    own = list(carry).index(text) if text in carry and isinstance(df.schema[text].dataType, T.StringType) else None
    beside = [] if own is not None else [F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text")]
    rows = df.select(F.struct(*map(quoted, carry)).alias("row"), *beside, *[c.alias(f"in{i}") for i, c in enumerate(inputs)])
    out_type = T.StructType.fromDDL(out)
    out_arrow, n_inputs = to_arrow_type(out_type), len(inputs)
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("out", out_type)])

    def apply(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            if own is not None:
                whole = whole.append_column("text", pc.fill_null(whole.column("row").field(own), ""))
            for batch in slices(whole, "text", limit):
                got = fn(batch.column("text").to_pylist(), *[batch.column(f"in{i}").to_pylist() for i in range(n_inputs)])
                arrays = [pa.array(got[f.name], type=f.type) for f in out_arrow]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.StructArray.from_arrays(arrays, fields=list(out_arrow))], ["row", "out"])

    return rows.mapInArrow(apply, schema)


def record_batch(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
