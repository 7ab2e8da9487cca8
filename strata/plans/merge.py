"""Incremental merge by id: one row per id over all loads, the latest version's fields, role sets united.

A load brings versions of ids (the same posting under several roles, changed and
re-published postings).  The table is partitioned by a column of the row itself, say the
day of publication, so a new version may move its id to another partition.  A merge
therefore

1. reduces the load to one row per id (an aggregate with a map-side step);
2. looks up in which partitions of the table these ids are now: only the id and the
   partition column are read, and the load's ids meet them by a join;
3. rewrites exactly the partitions that lose or gain a row.  All others are not read in
   full and not written.

The merged partitions are staged before the table is touched.  A merge that stops while it writes
leaves its stage's path in ``<base>/_merge``; :func:`finish_merge` (which every merge calls first)
writes that stage again, which is the same result, before anything else happens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import new_scratch
from strata.sinks.writers import delete_paths, path_exists, write_keys


def latest_by_id(rows: DataFrame, id_col: str, newest: Sequence[str], unite: Sequence[str] = ()) -> DataFrame:
    """One row per ``id_col``: the row with the largest ``newest`` columns, and the union of the ``unite`` arrays.

    Ties are broken by the other columns, so the survivor doesn't depend on the order of
    rows.  Arrays are united by exploding them: the aggregate's buffer holds distinct members,
    however often an id comes.  The united arrays are sorted; without members they
    are empty, and null if all were null.  Columns in ``unite`` have comparable members.  Null ids are one id.
    """
    body = [c for c in rows.columns if c != id_col and c not in unite and c not in newest]
    order = F.max(F.struct(*[F.col(f"`{c}`") for c in [*newest, *body]])).alias("_best")
    fields = [F.col(f"_best.`{c}`").alias(c) for c in [*newest, *body]]
    if not unite:
        return rows.groupBy(id_col).agg(order).select(id_col, *fields).select(*rows.columns)
    # One member a row: (which array, member); a row without members keeps one row, to be counted and ranked.
    types = [rows.schema[c].dataType.elementType for c in unite]

    def tag(i: int):  # member of the i-th array -> struct with that member in its i-th field
        return lambda m: F.struct(*[(m if j == i else F.lit(None)).cast(t).alias(f"m{j}") for j, t in enumerate(types)])

    tagged = [F.transform(F.col(f"`{c}`"), tag(i)) for i, c in enumerate(unite)]
    member = "struct<" + ", ".join(f"m{j}: {t.simpleString()}" for j, t in enumerate(types)) + ">"
    members = F.flatten(F.array(*[F.coalesce(t, F.array().cast(f"array<{member}>")) for t in tagged]))
    spread = rows.select("*", F.explode_outer(members).alias("_m"))
    sets = [F.sort_array(F.collect_set(F.col(f"_m.m{j}"))).alias(f"_s{j}") for j in range(len(unite))]
    known = [F.max(F.col(f"`{c}`").isNotNull()).alias(f"_k{j}") for j, c in enumerate(unite)]
    best = spread.groupBy(id_col).agg(order, *sets, *known)
    united = [F.when(F.col(f"_k{j}"), F.col(f"_s{j}")).alias(c) for j, c in enumerate(unite)]
    return best.select(id_col, *fields, *united).select(*rows.columns)


def read_merged(spark: SparkSession, base: str, schema: StructType, part_col: str) -> DataFrame:
    """The merged table (empty before the first merge), ``part_col`` typed as ``schema`` says."""
    if not path_exists(spark, base):
        return spark.createDataFrame([], schema)
    fields = [f for f in schema.fields if f.name != part_col]
    return spark.read.schema(StructType([*fields, schema[part_col]])).parquet(base).select(*schema.names)


def _apply(spark: SparkSession, stage: str, base: str, schema: StructType, part_col: str) -> None:
    rows = spark.read.schema(schema).parquet(f"{stage}/rows")
    touched = spark.read.schema(StructType([schema[part_col]])).parquet(f"{stage}/touched")
    write_keys(rows, base, [part_col], requested=touched)


def finish_merge(spark: SparkSession, base: str, schema: StructType, part_col: str) -> bool:
    """Write the stage of a merge that stopped while it wrote; whether there was one."""
    note = f"{base.rstrip('/')}/_merge"
    if not path_exists(spark, f"{note}/_SUCCESS"):
        return False
    _apply(spark, spark.read.text(note).first()[0], base, schema, part_col)
    delete_paths(spark, [note])
    return True


def merge_latest(load: DataFrame, base: str, id_col: str, newest: Sequence[str], part_col: str,
                 unite: Sequence[str] = (), stage_root: str | None = None) -> dict[str, int]:
    """Merge ``load`` into the table at ``base``; the numbers of merged ids and rewritten partitions.

    Running the same load again changes nothing.  ``stage_root`` is a folder that outlives this
    process (default: the shared scratch folder), where a stopped merge finds its stage.
    The driver holds the touched partitions' values, one per day of the load or of a moved id.
    """
    spark, schema, base = load.sparkSession, load.schema, base.rstrip("/")
    finish_merge(spark, base, schema, part_col)
    stage = new_scratch(spark, "merge") if stage_root is None else f"{stage_root.rstrip('/')}/merge"
    latest_by_id(load, id_col, newest, unite).write.mode("overwrite").parquet(f"{stage}/load")
    fresh = spark.read.schema(schema).parquet(f"{stage}/load")
    table = read_merged(spark, base, schema, part_col)
    ids = fresh.select(F.col(id_col).alias("_id"))
    where = table.select(id_col, part_col).join(ids, F.col(id_col).eqNullSafe(F.col("_id")), "left_semi").select(part_col)
    where.unionByName(fresh.select(part_col)).distinct().write.mode("overwrite").parquet(f"{stage}/touched")
    touched = [r[0] for r in spark.read.schema(StructType([schema[part_col]])).parquet(f"{stage}/touched").collect()]
    affected = table.where(_among(F.col(part_col), touched))  # literals on the partition column: only these folders are listed
    latest_by_id(affected.unionByName(fresh), id_col, newest, unite).write.mode("overwrite").parquet(f"{stage}/rows")
    spark.createDataFrame([(stage,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/_merge")
    _apply(spark, stage, base, schema, part_col)
    delete_paths(spark, [f"{base}/_merge"])
    return {"ids": fresh.count(), "partitions": len(touched)}


def _among(col: Column, values: list) -> Column:
    some = col.isin([v for v in values if v is not None])
    return some | col.isNull() if None in values else some
