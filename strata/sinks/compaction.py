"""Merging the small files of a sink into large ones, beside a running stream.

Committed files are never touched.  A compaction packs the small ones of each partition
folder into bins of about ``target`` bytes, writes every bin as one file under
``<sink>/_compacted/v=<n>/``, and then publishes a manifest, ``<sink>/_manifest/v=<n>``:
the files that are replaced and the compacted files that stand for them.  Readers take the
newest finished manifest first and then the committed files it does not replace, so

* a reader sees every row exactly once, before, while and after a manifest appears;
* files the stream commits meanwhile are in no manifest and are read as they are;
* a compaction that stops half way has published nothing; the next one takes another number.

Committed files are those of a stream sink's log (``_spark_metadata``, as Spark reads it), or all
finished files of a folder without one.  ``_`` folders are hidden from plain readers,
who keep seeing the original files.  One compaction at a time may run on a sink.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import new_scratch
from strata.sinks.writers import delete_paths, path_exists
from strata.sources.files import UNFINISHED, path_value

MANIFEST_SCHEMA = "path string, folder string, length bigint, live boolean, replaced_in int"
FILES_SCHEMA = "path string, folder string, length bigint, modified timestamp"
#: Files ranked by one task when bins are filled; a folder of more is dealt into lanes.
LANE_FILES = 100_000


def committed_files(spark: SparkSession, sink: str) -> DataFrame:
    """(path, folder, length, modified) of the sink's committed files; ``folder`` is relative (``event_type=x``)."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sink)
    except AnalysisException as exc:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER" not in str(exc):
            raise
        return spark.createDataFrame([], FILES_SCHEMA)
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    folder = F.regexp_replace(F.col("path"), r"/[^/]*$", "")
    top = sink.rstrip("/").rsplit("/", 1)[-1]
    inside = F.regexp_extract(folder, f"/{re.escape(top)}/((?:[^/=]+=[^/]*/?)+)$", 1)
    return files.where(~name.contains(UNFINISHED)).select(
        "path", inside.alias("folder"), "length", F.col("modificationTime").alias("modified"))


def versions(spark: SparkSession, sink: str, finished: bool = True) -> list[int]:
    """Numbers of the sink's manifests, rising; with ``finished=False`` also of those that never came to an end."""
    found: set[int] = set()
    for folder, mark in (("_manifest", "/_SUCCESS"), *([] if finished else [("_manifest", ""), ("_compacted", "")])):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.rstrip('/')}/{folder}/v=*{mark}")
        for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
            found.add(int(re.search(r"/v=(\d+)", status.getPath().toString())[1]))
    return sorted(found)


def manifest(spark: SparkSession, sink: str, version: int | None = None) -> DataFrame:
    """The newest finished manifest (or a numbered one): replaced files, and compacted files with ``live``."""
    known = versions(spark, sink)
    if not known:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{sink.rstrip('/')}/_manifest/v={known[-1] if version is None else version}")


def live_files(spark: SparkSession, sink: str) -> DataFrame:
    """(path, folder, length, compacted) of the files that hold the sink's rows now, each row in one of them."""
    known = manifest(spark, sink)  # first the manifest, then the listing: what comes between is in the listing alone
    done = known.where(~F.col("live")).select(F.col("path").alias("done"))
    plain = committed_files(spark, sink).join(done, F.col("path") == F.col("done"), "left_anti")
    return plain.select("path", "folder", "length", F.lit(False).alias("compacted")).unionByName(
        known.where("live").select("path", "folder", "length", F.lit(True).alias("compacted")))


def plan_bins(files: DataFrame, target: int) -> DataFrame:
    """``files`` below half of ``target`` with a ``bin`` (text): files of a folder whose sizes sum up to about ``target``.

    Files are taken in the order of their names and a bin ends where the running size
    passes a multiple of ``target``.  A folder of very many files is first dealt into lanes,
    so that no task ranks more than about ``LANE_FILES``.  Bins of one file are left out: nothing to merge.
    """
    small = files.where(F.col("length") * 2 < target)
    sizes = small.groupBy(F.col("folder").alias("of")).agg(F.ceil(F.count(F.lit(1)) / LANE_FILES).alias("lanes"))
    dealt = small.join(sizes, F.col("folder") == F.col("of")).withColumn("lane", F.pmod(F.xxhash64("path"), F.col("lanes")))
    before = F.sum("length").over(Window.partitionBy("folder", "lane").orderBy("path")) - F.col("length")
    binned = dealt.withColumn("number", F.floor(before / target))
    several = F.count(F.lit(1)).over(Window.partitionBy("folder", "lane", "number")) > 1
    return binned.withColumn("several", several).where("several").select(
        *files.columns, F.concat_ws("-", "lane", "number").alias("bin"))


def _rows_of(spark: SparkSession, files: DataFrame, sink: str, fmt: str, schema: StructType | None) -> DataFrame | None:
    """The rows of ``files`` with the path of each (``_path``); text formats as lines."""
    paths = [r[0] for r in files.select("path").toLocalIterator()]  # as a file index, the driver holds the names
    if not paths:
        return None
    reader = spark.read.schema(schema) if fmt == "parquet" else spark.read.schema("value string")
    return reader.format("parquet" if fmt == "parquet" else "text").load(paths).withColumn("_path", F.col("_metadata.file_path"))


def compact(spark: SparkSession, sink: str, target: int = 128 * 1024 * 1024, fmt: str = "json",
            schema: StructType | None = None) -> dict[str, int]:
    """Merge the sink's small files; the numbers of replaced and new files and the manifest's version.

    ``fmt`` is "json" (any format of lines) or "parquet", which needs ``schema``, the
    files' own columns.  Rows are shuffled by bin, so a task holds a few bins of about ``target``
    bytes however a folder has grown.  Compacted files that are still small are packed again later.
    With nothing to merge, nothing is written (version 0).
    """
    sink = sink.rstrip("/")
    staged = new_scratch(spark, "bins")
    plan_bins(live_files(spark, sink), target).write.parquet(staged)
    bins = spark.read.parquet(staged)
    n_bins = bins.select("folder", "bin").distinct().count()
    if not n_bins:
        return {"version": 0, "replaced": 0, "written": 0}
    version = max(versions(spark, sink, finished=False), default=0) + 1
    out = f"{sink}/_compacted/v={version}"
    read, kept = Observation(), Observation()
    rows = _rows_of(spark, bins, sink, fmt, schema).observe(read, F.count(F.lit(1)).alias("n"))
    where = bins.select(F.col("path").alias("of"), F.col("folder").alias("_folder"), F.col("bin").alias("_bin"))
    placed = rows.join(where, _decoded(F.col("_path")) == F.col("of")).drop("_path", "of").observe(kept, F.count(F.lit(1)).alias("n"))
    (placed.repartition(min(n_bins, 10_000), "_folder", "_bin").write.partitionBy("_folder", "_bin")
           .format("parquet" if fmt == "parquet" else "text").save(out))
    if read.get["n"] != kept.get["n"]:  # nothing is published
        raise RuntimeError(f"{out}: {kept.get['n']} of {read.get['n']} rows were placed")
    number = re.escape(f"v={version}")
    new = committed_files(spark, out).select("path", _decoded(F.regexp_extract("path", rf"/{number}/_folder=([^/]*)/", 1)).alias("folder"), "length")
    old = manifest(spark, sink)
    replaced = bins.select("path", "folder", "length").withColumns({"live": F.lit(False), "replaced_in": F.lit(version)})
    again = bins.where("compacted").select(F.col("path").alias("again"))
    kept = old.join(again, F.col("path") == F.col("again"), "left_anti")
    published = kept.unionByName(replaced).unionByName(
        new.withColumns({"live": F.lit(True), "replaced_in": F.lit(None).cast("int")}))
    published.write.mode("errorifexists").parquet(f"{sink}/_manifest/v={version}")  # its _SUCCESS file is the commit
    return {"version": version, "replaced": bins.count(), "written": new.count()}


def vacuum(spark: SparkSession, sink: str, older_than: timedelta, now: datetime | None = None) -> int:
    """Delete compacted files that were replaced by manifests older than ``older_than`` and folders of
    compactions that never published; the number of paths removed.

    Original files stay: the stream's log names them, and plain readers need them.  Choose
    ``older_than`` longer than any reader runs.
    """
    sink, known = sink.rstrip("/"), versions(spark, sink)
    if not known:
        return 0
    limit = (now or datetime.now()) - older_than
    conf = spark._jsc.hadoopConfiguration()

    def finished_at(v: int) -> datetime:
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/_manifest/v={v}/_SUCCESS")
        return datetime.fromtimestamp(mark.getFileSystem(conf).getFileStatus(mark).getModificationTime() / 1000)

    old = [v for v in known if finished_at(v) <= limit]
    gone = manifest(spark, sink).where(~F.col("live") & F.col("path").contains("/_compacted/") & F.col("replaced_in").isin(old))
    paths = [r[0] for r in gone.select("path").toLocalIterator()]
    unpublished = [v for v in versions(spark, sink, finished=False) if v < known[-1] and v not in known]
    paths += [p for v in unpublished for p in (f"{sink}/_compacted/v={v}", f"{sink}/_manifest/v={v}") if path_exists(spark, p)]
    paths += [f"{sink}/_manifest/v={v}" for v in old if v != known[-1]]
    delete_paths(spark, paths)
    return len(paths)


def read_live(spark: SparkSession, sink: str, schema: StructType | str, partitions: StructType | str = "",
              fmt: str = "json", options: dict[str, str] | None = None) -> DataFrame:
    """The sink's rows through its manifest: compacted files, and committed files that none stands for.

    ``schema`` are the files' columns, ``partitions`` those of the folders (typed, so that
    ``01`` may stay text).  Without a manifest this is every committed file.
    """
    sink = sink.rstrip("/")
    own, keys = (StructType.fromDDL(s) if isinstance(s, str) else s for s in (schema, partitions))
    plain, packed = [], []
    for r in live_files(spark, sink).select("path", "compacted").toLocalIterator():  # names only, as in a file index
        (packed if r["compacted"] else plain).append(r["path"])
    reader = lambda s, base: spark.read.format(fmt).schema(s).options(**(options or {})).option("basePath", base)
    columns = [F.col(f"`{f.name}`") for f in [*own.fields, *keys.fields]]
    parts = []
    if plain:
        parts.append(reader(StructType([*own.fields, *keys.fields]), sink).load(plain).select(*columns, F.col("_metadata.file_path").alias("_file")))
    if packed:
        folders = StructType.fromDDL("v int, _folder string, _bin string")
        rows = reader(StructType([*own.fields, *folders.fields]), f"{sink}/_compacted").load(packed)
        rows = rows.select(*columns[:len(own.fields)], *[_folder_value(f.name).cast(f.dataType).alias(f.name) for f in keys.fields],
                           F.col("_metadata.file_path").alias("_file"))
        parts.append(rows)
    if not parts:
        return spark.createDataFrame([], StructType([*own.fields, *keys.fields]).add("_file", "string"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _folder_value(key: str) -> Column:
    """The value of ``key`` in ``_folder`` (``k=v/k=v``), Spark's escapes undone."""
    return _decoded(path_value("_folder", key))


def _decoded(text: Column) -> Column:
    """%XX escapes undone: Spark gives a row's file as a URI, listings give its plain name (a plus sign is itself)."""
    return F.url_decode(F.regexp_replace(text, r"\+", "%2B"))
