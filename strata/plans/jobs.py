"""Job entry points: one function per lake job, raw layer → processed layer.

Each job is read → transform → write, with the day (or range of days) as an
argument, so reruns and backfills are the same call.  The transforms are the pure
functions of :mod:`strata.plans.rates`, :mod:`strata.plans.catalog` and
:mod:`strata.plans.postings`, testable on a fixture without storage.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators import metrics as M
from strata.plans import catalog, incremental, merge, postings, progress, rates
from strata.session import scratch_root
from strata.sinks import compaction
from strata.sinks.layout import processed_dir, processed_root
from strata.sinks.writers import write_keys, write_partition
from strata.sources.documents import json_docs, whole_text
from strata.sources.file_stats import recent_metrics
from strata.sources.metric_files import load_metrics
from strata.streaming import events as S

# Catalogue datasets: how each raw document is read and flattened.
_CATALOGUES = {
    "professional_roles": lambda spark, path: catalog.professional_roles(
        json_docs(spark, path, catalog.ROLES_SCHEMA), order=False),
    "industries": lambda spark, path: catalog.industries(json_docs(spark, path, catalog.INDUSTRIES_SCHEMA)),
    "languages": lambda spark, path: catalog.languages(json_docs(spark, path, catalog.LANGUAGES_SCHEMA)),
    "areas": lambda spark, path: catalog.areas(whole_text(spark, path)),
    "dictionaries": lambda spark, path: catalog.dictionaries(whole_text(spark, path)),
}


def build_rates(spark: SparkSession, raw_path: str, root: str, dt: date | str) -> str:
    """Rates document(s) of a day → processed/rates/dt=D (replacing a previous run)."""
    out = processed_dir(root, "rates", dt)
    write_partition(rates.rates(json_docs(spark, raw_path, rates.SCHEMA), order=False)
                    .sortWithinPartitions("currency"), out)
    return out


def build_catalogue(spark: SparkSession, name: str, raw_path: str, root: str, dt: date | str) -> str:
    """One reference catalogue (full refresh for the day) → processed/<name>/dt=D."""
    out = processed_dir(root, name, dt)
    write_partition(_CATALOGUES[name](spark, raw_path), out)
    return out


def build_postings(spark: SparkSession, raw_base: str, root: str, days: Sequence[date],
                   keys: DataFrame, multi_line: bool = True) -> str:
    """Raw posting pages landed under ``raw_base/dt=D/role_id=R`` for a range of days
    → processed/postings partitioned by (dt, role_id), in one job.

    ``multi_line=True`` (default) reads one JSON array per file, as the remote API
    returns a page set; use ``multi_line=False`` for files of one posting per line.

    ``keys`` (column ``role_id``) × ``days`` is the work grid: every cell of it is
    replaced, and cells without postings are cleared.
    """
    schema = f"{postings.SCHEMA}, dt date, role_id string"
    raw = (json_docs(spark, raw_base, schema, multi_line=multi_line)  # a malformed document stops the job
                .where(F.col("dt").isin(list(days))))  # partition pruning on dt
    flat = postings.vacancies(raw, keep=("dt", "role_id"))
    base = processed_root(root, "postings")
    write_keys(flat, base, ["dt", "role_id"], requested=incremental.work_grid(keys, days))
    return base


def load_postings(spark: SparkSession, raw_base: str, root: str, days: Sequence[date], keys: DataFrame,
                  multi_line: bool = True, step_days: int = 1) -> dict[str, int]:
    """:func:`build_postings` for long ranges: only cells whose raw rows are new or changed are
    written, step by step, and a run that stops is resumed by the same call (see
    :mod:`strata.plans.progress`; the progress table is ``<root>/progress``)."""
    raw = json_docs(spark, raw_base, f"{postings.SCHEMA}, dt date, role_id string", multi_line=multi_line)
    return progress.load_days(raw.withColumn("day", F.col("dt")), processed_root(root, "postings"), "day", days, "postings",
                              progress.Progress(spark, f"{root.rstrip('/')}/progress"), keys=["role_id"], requested_keys=keys,
                              transform=lambda rows: postings.vacancies(rows, keep=("dt", "role_id")), version="1", step_days=step_days)


def merge_postings(spark: SparkSession, root: str, days: Sequence[date]) -> dict[str, int]:
    """The postings of ``days`` (as loaded per role) merged into processed/postings_distinct: one row
    per id, the latest publication's fields, the roles of all its listings united; partitioned by ``dt``,
    the day of the publication that won."""
    schema = postings.vacancies(spark.createDataFrame([], postings.SCHEMA)).schema
    listed = incremental.read_keyed(spark, processed_root(root, "postings"), schema, {"dt": "date", "role_id": "string"})
    pairs = F.transform(F.arrays_zip("professional_role_ids", "professional_role_names"),
                        lambda p: F.struct(p["professional_role_ids"].alias("id"), p["professional_role_names"].alias("name")))
    load = (listed.where(F.col("dt").isin(list(days))).withColumns({"listed_roles": F.array("role_id"), "professional_roles": pairs})
                  .drop("role_id", "professional_role_ids", "professional_role_names"))
    return merge.merge_latest(load, processed_root(root, "postings_distinct"), "id", ["published_at", "dt"], "dt",
                              unite=["listed_roles", "professional_roles"], stage_root=f"{root.rstrip('/')}/merges")


def run_metrics_stream(spark: SparkSession, source: DataFrame, root: str, available_now: bool = False,
                       method: str = "sliced"):
    """Start the rolling-metrics stream: text stream → metrics → ``<root>/streaming/rolling_metrics``."""
    sink = f"{root.rstrip('/')}/streaming/rolling_metrics"
    return S.start_metrics_stream(source, sink, f"{root.rstrip('/')}/checkpoints/rolling_metrics",
                                  available_now=available_now, method=method)


def keep_compact(query: StreamingQuery, spark: SparkSession, sink: str, every_seconds: float, target: int = 128 * 1024 * 1024,
                 keep: timedelta = timedelta(hours=6)) -> int:
    """While ``query`` runs, merge its sink's small files every so often; the number of compactions.

    Replaced compacted files go after ``keep``, which is longer than any reader runs.  Returns
    when the query has ended (its error is the query's own to raise); a compaction that fails
    raises here and leaves query, sink and readers as they were.
    """
    done = 0
    while True:
        ended = query.awaitTermination(every_seconds) if query.isActive else True
        done += compaction.compact(spark, sink, target)["version"] > 0
        compaction.vacuum(spark, sink, keep)
        if ended:
            return done


def dashboard_frames(spark: SparkSession, sink: str, hours: int = 4, rows: int = 100,
                     event_types: Sequence[str] | None = None, sink_log: bool = True,
                     by_day: bool = False, since: date | None = None, compacted: bool = False) -> dict[str, DataFrame]:
    """The read side: load the metric files, keep the last ``hours``, and derive the
    KPI row, both pivots, the totals and the latest windows (all DataFrames).

    ``sink_log`` reads through the stream sink's commit log (only committed files);
    set it to False for folders written by other writers.  ``compacted`` reads through the
    sink's compaction manifest, the log included.  A ``by_day`` sink is read from the
    newest day folders that hold the last ``hours`` (or from ``since`` on, if given)."""
    # The recent slice is materialised once (a reliable checkpoint): the five frames
    # then read it instead of re-listing, re-parsing and re-deduplicating the sink.
    scratch_root(spark)
    if by_day and since is None:
        df = recent_metrics(spark, sink, hours, sink_log=sink_log, compacted=compacted)
    else:
        df = M.recent(load_metrics(spark, sink, sink_log=sink_log, by_day=by_day, since=since, compacted=compacted), hours)
    df = df.checkpoint(eager=True)
    return {
        "kpis": M.kpis(df),
        "counts": M.pivot_metric(df, "cnt", "sum", event_types),
        "averages": M.pivot_metric(df, "avg_value", "mean", event_types),
        "totals": M.totals(df),
        "latest": M.latest(df, rows),
    }
