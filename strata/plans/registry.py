"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Every query reads whole tables (or data Spark derives from them); nothing is
sampled or capped except where the cap is the feature (``latest`` keeps 100 rows).
The matching DuckDB SQL for the correctness gate is in :mod:`strata.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import metrics as M
from strata.operators.flatten import explode_entries
from strata.operators.windows import hop_metrics, interval_micros, recent_hop_metrics
from strata.plans import catalog, documents, incremental, postings, progress, rates
from strata.plans.merge import merge_latest, read_merged
from strata.session import new_scratch, pin_utc
from strata.sinks import compaction
from strata.sinks.layout import processed_dir, processed_root, raw_dir
from strata.sinks.writers import delete_paths, land_documents, land_raw, write_keys, write_partition
from strata.sources.documents import JSON_TIME_OPTIONS, json_docs, parse_docs, whole_text
from strata.sources import paged
from strata.sources.file_stats import recent_metrics, recent_rows
from strata.sources.files import list_files, path_value
from strata.sources.metric_files import load_metrics
from strata.sources.snapshots import Snapshots, process_new
from strata.sources.tables import read_table
from strata.streaming import events as S
from strata.streaming import keyed

Query = Callable[[SparkSession, str], DataFrame]

# Event-stream parameters of the metrics job (fixed values).
WINDOW_SIZE = "1 minute"
WINDOW_SLIDE = "10 seconds"
LOOKBACK_HOURS = 4
PAGE_SIZE = 100
# Files of a micro-batch (fixed value): a batch's size doesn't grow with what has piled up.
FILES_PER_TRIGGER = 64
# Columns of the dashboard's pivots (fixed values).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])


def _metrics(spark: SparkSession, sf_dir: str, method: str = "sliced") -> DataFrame:
    pin_utc(spark)
    return _rounded(_events(spark, sf_dir), method)


def _rounded(events: DataFrame, method: str = "sliced") -> DataFrame:
    raw = hop_metrics(events, "ts", "event_type", "value",
                      WINDOW_SIZE, WINDOW_SLIDE, method=method)
    return M.round_metrics(raw)


# Day of the full-refresh runs (fixed value; a job's day is always an argument).
RUN_DAY = "2024-02-01"


# ── q01–q06: flatten nested documents ───────────────────────────────────────

def q01_entries_explode(spark, sf_dir):
    """Object with data-dependent keys → (key, value) rows: ``events.props``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "props"])
    parsed = ev.select("event_id", F.from_json("props", "map<string,string>", {"mode": "FAILFAST"}).alias("props"))
    return explode_entries(parsed, "props", "prop_key", "prop_value", keep=["event_id"])


def q01_rates(spark, sf_dir):
    """Rate documents (date with offset, keyed entries, strict casts) → rows."""
    pin_utc(spark)
    docs = parse_docs(documents.rate_docs(spark, sf_dir), "doc", rates.SCHEMA)
    return rates.rates(docs)


def q02_nested_lists(spark, sf_dir):
    """Two chained unnests, categories → roles, ordered by ids as integers."""
    docs = parse_docs(documents.role_pages(spark, sf_dir), "doc", catalog.ROLES_SCHEMA)
    return catalog.professional_roles(docs)


def q02_industries(spark, sf_dir):
    """Groups → industries: one unnest that keeps the group's columns."""
    return catalog.industries(parse_docs(documents.industry_groups(spark, sf_dir), "doc", catalog.INDUSTRIES_SCHEMA))


def q03_project(spark, sf_dir):
    """Land a flat dictionary in the raw layer as JSON lines, read it back, project."""
    root = new_scratch(spark, "q03")
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])
    items = cust.select(F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("uid"), F.col("c_nationkey").alias("nation"))).alias("value"))
    path = raw_dir(root, "tables", "customer", RUN_DAY)
    land_raw(items, path)
    return catalog.languages(json_docs(spark, path, catalog.LANGUAGES_SCHEMA, multi_line=False))


def q04_posting_fields(spark, sf_dir):
    """Postings: nested struct fields renamed, role lists plucked (joined as text here)."""
    pin_utc(spark)
    items = parse_docs(documents.posting_pages(spark, sf_dir), "doc", postings.SCHEMA, array=True)
    flat = postings.vacancies(items)
    return (flat.withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))
                .withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
                .withColumn("professional_role_ids", F.array_join("professional_role_ids", ","))
                .withColumn("professional_role_names", F.array_join("professional_role_names", ",")))


def q05_tree(spark, sf_dir):
    """Forests of unknown depth → one row per node (level loop, no depth cap)."""
    return catalog.areas(documents.area_trees(spark, sf_dir), "doc")


def q06_bundle(spark, sf_dir):
    """Bundles of mixed kinds → (dict_name, id, name) for array-valued entries only."""
    return catalog.dictionaries(documents.bundles(spark, sf_dir), "doc")


# Documents of a file of q05_tree_files, and bytes (gzip) above which a file's nodes are dealt over all tasks before
# they are walked; smaller files are walked where they are read, so no shuffle carries them (fixed values).
FOREST = 200
LARGE_FILE = 256 << 10


def q02_document_files(spark, sf_dir):
    """Catalogue pages as files of one indented document each, read as such (a document spans lines)."""
    root = new_scratch(spark, "q02-files")
    parsed = parse_docs(documents.role_pages(spark, sf_dir), "doc", catalog.ROLES_SCHEMA)
    folders = land_documents(parsed.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")), root)
    return catalog.professional_roles(json_docs(spark, folders, catalog.ROLES_SCHEMA))


def q05_tree_files(spark, sf_dir):
    """Forests as files of one document over many lines each, read as whole texts and walked."""
    root = new_scratch(spark, "q05-files")
    roots = F.regexp_replace("doc", r"^\[|\]$", "")
    trees = documents.area_trees(spark, sf_dir).select(roots.alias("value")).where("value <> ''")
    texts = whole_text(spark, land_documents(trees, root, together=FOREST, compress=True))
    large = F.col("_metadata.file_size") > LARGE_FILE
    small = texts.where(~large).coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return catalog.areas(small, rebalance=False).unionAll(catalog.areas(texts.where(large)))


def q04_merged_postings(spark, sf_dir):
    """One posting per order over three loads: its latest version, the roles of all versions united.

    A load holds a posting once per line of the order (each line names a role).  The second
    load re-publishes orders a month later, the third repeats the first, which changes nothing.
    """
    pin_utc(spark)
    base = new_scratch(spark, "q04-merged")
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"])
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    role = F.concat_ws("-", "l_returnflag", "l_linestatus")

    def version(number, wanted):
        day = F.trunc(F.add_months(F.to_date("o_orderdate"), number - 1), "month")
        return rows.where(wanted).select(
            F.col("o_orderkey").alias("id"), F.lit(number).alias("version"), F.col("o_orderpriority").alias("name"),
            (F.col("o_totalprice") + number).alias("salary"), F.array(role).alias("roles"), day.alias("dt"))

    first = version(1, (F.col("l_linenumber") % 2 == 1) | (F.col("o_orderkey") % 3 == 0))
    second = version(2, (F.col("l_linenumber") % 2 == 0) & (F.col("o_orderkey") % 5 < 2))
    for load in (first, second, first):
        merge_latest(load, base, "id", ["version"], "dt", unite=["roles"])
    out = read_merged(spark, base, first.schema, "dt")
    return out.withColumn("roles", F.array_join("roles", ","))


# ── q07 / q08: layout, writers, incremental runs ────────────────────────────

def q07_day_write(spark, sf_dir):
    """Full refresh of a dictionary into processed/<ds>/dt=D, run twice, read back."""
    root = new_scratch(spark, "q07")
    cust = read_table(spark, sf_dir, "customer")
    for _ in range(2):  # a rerun replaces the day, it does not append
        write_partition(cust, processed_dir(root, "customer", RUN_DAY))
    schema = StructType(list(cust.schema.fields)).add("dt", "date")  # a copy: .schema is cached
    return spark.read.schema(schema).parquet(processed_root(root, "customer"))


def q08_day_range(spark, sf_dir):
    """Every day of ``events`` as [day, day+1) slices by (dt, event_type), one job, twice."""
    pin_utc(spark)
    root = new_scratch(spark, "q08")
    events = read_table(spark, sf_dir, "events")
    days = incremental.days_of(events, "ts")
    base = processed_root(root, "events")
    for _ in range(2):  # rerun of the same range is idempotent
        incremental.run_days(events, base, "ts", days, keys=["event_type"])
    return incremental.read_keyed(spark, base, events.schema, {"dt": "date", "event_type": "string"})


# Days of a step of the resumable load, and after how many steps its first run stops (fixed values).
STEP_DAYS, STOPPED_AFTER = 5, 2


class Stopped(RuntimeError):
    """A load that ends half way (raised on purpose by q08_resumed_load)."""


def q08_resumed_load(spark, sf_dir):
    """q08 as a resumable load; ``loaded_run`` tells which run wrote a row's cell.

    Run 1 stops after two steps, run 2 does what is left, a further run finds nothing to do and
    leaves no record, and run 3 gets a source in which one day's views have another value: it writes
    that cell alone.
    """
    pin_utc(spark)
    root = new_scratch(spark, "q08-resumed")
    events = read_table(spark, sf_dir, "events")
    days = incremental.days_of(events, "ts")
    base, done = processed_root(root, "events"), progress.Progress(spark, f"{root}/progress")

    def stop(step: int) -> None:
        if step == STOPPED_AFTER:
            raise Stopped(f"step {step}")

    def load(rows, after_step=None):
        return progress.load_days(rows, base, "ts", days, "events", done, keys=["event_type"], step_days=STEP_DAYS, after_step=after_step)

    try:
        load(events, stop)
    except Stopped:
        pass
    load(events)
    load(events)
    if days:
        hit = (F.to_date("ts") == F.lit(days[-1])) & (F.col("event_type") == "view")
        load(events.withColumn("value", F.when(hit, F.col("value") + 1).otherwise(F.col("value"))))
    rows = incremental.read_keyed(spark, base, events.schema, {"dt": "date", "event_type": "string"})
    runs = done.latest("events").select(F.col("dt").alias("day"), F.get_json_object("cell", "$.k0").alias("type"), F.col("run").alias("loaded_run"))
    same = (F.col("dt") == F.col("day")) & F.col("event_type").eqNullSafe(F.col("type"))
    return rows.join(runs, same, "left").drop("day", "type")


def q08_stream_keyed(spark, sf_dir):
    """events → files → stream → keyed parquet with a ledger: a batch that fails before its ledger row,
    a batch whose commit the checkpoint lost (it is replayed), and a fold of the first batches."""
    pin_utc(spark)
    root = new_scratch(spark, "q08-stream")
    events = read_table(spark, sf_dir, "events").withColumn("dt", F.to_date("ts"))
    inbox, base, checkpoint = f"{root}/inbox", f"{root}/events", f"{root}/checkpoint"
    keys = {"dt": "date", "event_type": "string"}
    events.repartition(6).write.parquet(inbox)

    def run(before_ledger=None):
        rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
        query = keyed.start_keyed_stream(rows, base, list(keys), checkpoint, available_now=True, before_ledger=before_ledger)
        try:
            query.awaitTermination()
        finally:
            if query.isActive:
                query.stop()

    def fail(batch_id: int) -> None:
        if batch_id == 1:
            raise Stopped(f"batch {batch_id}")

    try:
        run(fail)  # batch 1 has written its folder and not its ledger row
    except StreamingQueryException:
        pass
    run()
    last = keyed.ledger(spark, base).agg(F.max("batch")).first()[0]
    delete_paths(spark, [f"{checkpoint}/commits/{last}", f"{checkpoint}/commits/.{last}.crc"])  # stopped before the commit
    run()
    keyed.fold_batches(spark, base, list(keys), events.schema, keys, upto=last - 1)
    return keyed.read_committed(spark, base, events.schema, keys).where(F.col("dt").isNotNull())


# ── q09 / q10: hopping-window metrics ───────────────────────────────────────

def q09_hop_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, "direct")


def q10_hop_sliced(spark, sf_dir):
    return _metrics(spark, sf_dir, "sliced")


def q10_panes(spark, sf_dir):
    """Windows of 50 s every 20 s: panes of their common divisor, 10 s, serve both."""
    pin_utc(spark)
    return M.round_metrics(hop_metrics(_events(spark, sf_dir), "ts", "event_type", "value", "50 seconds", "20 seconds", method="sliced"))


# ── q11: the streaming job end to end ───────────────────────────────────────

def q11_hop_stream(spark, sf_dir, method: str = "direct"):
    """events → JSON lines files → stream (watermark 5 s, hop 60 s / 10 s) → JSON sink
    partitioned by event type → read back through the sink's commit log."""
    pin_utc(spark)
    root = new_scratch(spark, f"q11-{method}")
    events = read_table(spark, sf_dir, "events", ["ts", "event_type", "user_id", "value"])
    land_raw(S.event_lines(events), f"{root}/inbox")
    query = S.start_metrics_stream(S.text_stream(spark, f"{root}/inbox", FILES_PER_TRIGGER), f"{root}/sink",
                                   f"{root}/checkpoint", available_now=True, method=method)
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    return load_metrics(spark, f"{root}/sink", sink_log=True)


def q11_hop_stream_dirty(spark, sf_dir):
    """q11 in four runs of one checkpoint: three landings in time order, then one of late
    copies, broken lines and events without a time, none of which may change a window."""
    return load_metrics(spark, f"{_dirty_stream(spark, sf_dir, 'q11-dirty')}/sink", sink_log=True)


def q11_losses(spark, sf_dir):
    """What the dirty stream lost, by window: the late copies that landed for windows already closed."""
    root = _dirty_stream(spark, sf_dir, "q11-losses")
    landed = S.parse_events(spark.read.schema("value string").text(f"{root}/inbox"))
    return S.window_losses(landed, load_metrics(spark, f"{root}/sink", sink_log=True))


def _dirty_stream(spark, sf_dir, name):
    """The folder of the dirty stream's inbox, checkpoint and sink after its four runs."""
    pin_utc(spark)
    root = new_scratch(spark, name)
    events = read_table(spark, sf_dir, "events", ["ts", "event_type", "user_id", "value"])
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    span = (last - first) / 3 if last else timedelta(0)
    cuts = [first + span, first + 2 * span] if last else [datetime(2000, 1, 1)] * 2
    low, high = (F.lit(c).cast("timestamp_ntz") for c in cuts)
    early = events.where(F.col("ts") < low)
    broken = early.select(F.explode(F.array(F.lit("{\"event_type\": "), F.lit("not json"), F.lit(""))).alias("value"))
    landings = [S.event_lines(early), S.event_lines(events.where((F.col("ts") >= low) & (F.col("ts") < high))),
                S.event_lines(events.where(F.col("ts") >= high)),
                S.event_lines(early.withColumn("value", F.col("value") + 1))
                .unionByName(S.event_lines(early.withColumn("ts", F.lit(None).cast("timestamp_ntz")))).unionByName(broken)]
    for lines in landings:
        lines.write.mode("append").text(f"{root}/inbox")
        query = S.start_metrics_stream(S.text_stream(spark, f"{root}/inbox"), f"{root}/sink", f"{root}/checkpoint", available_now=True)
        try:
            query.awaitTermination()
        finally:
            if query.isActive:
                query.stop()
    return root


def q11_compacted(spark, sf_dir):
    """q11 in two runs of several triggers, the sink compacted after each: the rows come
    from few large files, and from those the stream has committed since."""
    pin_utc(spark)
    root = new_scratch(spark, "q11-compacted")
    events = read_table(spark, sf_dir, "events", ["ts", "event_type", "user_id", "value"])
    last = events.agg(F.max("ts")).first()[0] or datetime(2000, 1, 1)
    half = F.col("ts") < F.lit(last - timedelta(days=10)).cast("timestamp_ntz")
    for landing in (events.where(half), events.where(~half)):
        ordered = S.event_lines(landing.repartitionByRange(3, "ts").sortWithinPartitions("ts"))
        ordered.write.mode("append").text(f"{root}/inbox")
        query = S.start_metrics_stream(S.text_stream(spark, f"{root}/inbox"), f"{root}/sink", f"{root}/checkpoint", available_now=True)
        try:
            query.awaitTermination()
        finally:
            if query.isActive:
                query.stop()
        compaction.compact(spark, f"{root}/sink")
    return load_metrics(spark, f"{root}/sink", compacted=True)


def q11_hop_stream_sliced(spark, sf_dir):
    """q11 with the sliced plan: two chained stateful aggregations under one watermark."""
    return q11_hop_stream(spark, sf_dir, method="sliced")


# ── q12–q18: read side over the metric table ───────────────────────────

def q12_metrics_dedupe(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    # Every window arrives three times: as computed, replayed with a smaller cnt, and
    # replayed with the same cnt but a smaller total; the original must survive.
    # The replays are generated from one computation (no recomputed union branches).
    replay = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("_replay")
    rows = m.select("*", replay)
    rows = (rows.withColumn("cnt", F.when(F.col("_replay") == 1, F.col("cnt") - 1).otherwise(F.col("cnt")))
                .withColumn("total", F.when(F.col("_replay") == 2, F.col("total") - 1.0)
                                      .otherwise(F.col("total")))
                .drop("_replay"))
    return M.dedupe_windows(rows)


def q13_metrics_load(spark, sf_dir):
    """Metrics written in the sink layout (JSON by event_type) and loaded back."""
    pin_utc(spark)
    root = new_scratch(spark, "q13")
    raw = hop_metrics(_events(spark, sf_dir), "ts", "event_type", "value", WINDOW_SIZE, WINDOW_SLIDE, method="sliced")
    S.write_metric_files(raw, root)
    return load_metrics(spark, root)


def q13_metrics_dirty(spark, sf_dir):
    """The same files with, for every metric row, a blank line, a cut-off line and a line
    whose count is no number beside it: the clean rows and nothing else come back."""
    pin_utc(spark)
    root = new_scratch(spark, "q13-dirty")
    raw = hop_metrics(_events(spark, sf_dir), "ts", "event_type", "value", WINDOW_SIZE, WINDOW_SLIDE, method="sliced")
    line = F.to_json(F.struct("window_start", "window_end", "cnt", "total", "avg_value"),
                     {"timestampNTZFormat": S.SINK_TIME_FORMAT, "ignoreNullFields": "false"})
    dirty = raw.select("event_type", F.explode(F.array(
        line, F.lit(""), F.expr("'  '"), F.substring(line, 1, 40), F.regexp_replace(line, '"cnt":', '"cnt":"x"+'))).alias("value"))
    dirty.write.mode("overwrite").partitionBy("event_type").text(root)
    return load_metrics(spark, root)


def q13_listed_types(spark, sf_dir):
    """Event types as the names of the metric files' folders tell them (no file is opened)."""
    pin_utc(spark)
    root = new_scratch(spark, "q13-listed")
    S.write_metric_files(hop_metrics(_events(spark, sf_dir), "ts", "event_type", "value", WINDOW_SIZE, WINDOW_SLIDE,
                                     method="sliced"), root)
    files = list_files(spark, root)
    return files.select(path_value("path", "event_type").alias("event_type")).distinct()


def _recent(spark, path):
    """The last hours' windows of the events under ``path``; only files whose statistics reach them are opened."""
    rows, latest = recent_rows(spark, path, "ts", LOOKBACK_HOURS, before=timedelta(microseconds=interval_micros(WINDOW_SLIDE)))
    if latest is None:
        return _rounded(rows)
    return M.round_metrics(recent_hop_metrics(rows, latest, "ts", "event_type", "value", LOOKBACK_HOURS, WINDOW_SIZE, WINDOW_SLIDE))


def q13_new_files(spark, sf_dir):
    """Events landed in three drops and processed after each: ``run`` tells which run read a row, so a file
    read twice, or missed, shows.  A fourth run finds nothing new."""
    pin_utc(spark)
    root = new_scratch(spark, "q13-new")
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    seen = Snapshots(spark, f"{root}/snapshots")
    for run in range(4):
        if run < 3:
            events.where(F.col("event_id") % 3 == run).write.mode("append").parquet(f"{root}/inbox")
        process_new(spark, f"{root}/inbox", seen, lambda paths, run=run: spark.read.schema(events.schema).parquet(*paths)
                    .withColumn("run", F.lit(run)).write.mode("append").parquet(f"{root}/table"))
    return spark.read.schema(events.withColumn("run", F.lit(0)).schema).parquet(f"{root}/table")


def q14_recent(spark, sf_dir):
    """The look-back is known from the latest event alone, so only its events are read."""
    pin_utc(spark)
    return _recent(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def q14_recent_files(spark, sf_dir):
    """q14 over events landed by day: of all day files, those that reach the look-back are opened."""
    pin_utc(spark)
    root = new_scratch(spark, "q14-files")
    events = _events(spark, sf_dir)
    incremental.run_days(events, root, "ts", incremental.days_of(events, "ts"))
    return _recent(spark, root)


def q14_recent_metrics(spark, sf_dir):
    """q14 over metric files by day: the day folders tell which files are opened."""
    pin_utc(spark)
    root = new_scratch(spark, "q14-metrics")
    raw = hop_metrics(_events(spark, sf_dir), "ts", "event_type", "value", WINDOW_SIZE, WINDOW_SLIDE, method="sliced")
    S.write_metric_files(raw, root, by_day=True)
    return recent_metrics(spark, root, LOOKBACK_HOURS, timedelta(microseconds=interval_micros(WINDOW_SIZE)))


def q15_pivot_cnt(spark, sf_dir):
    return M.pivot_metric(_metrics(spark, sf_dir), "cnt", "sum", EVENT_TYPES)


def q15_pivot_avg(spark, sf_dir):
    return M.pivot_metric(_metrics(spark, sf_dir), "avg_value", "mean", EVENT_TYPES)


def q16_totals(spark, sf_dir):
    return M.totals(_metrics(spark, sf_dir))


def q17_kpis(spark, sf_dir):
    return M.kpis(_metrics(spark, sf_dir))


def q18_latest(spark, sf_dir):
    return M.latest(_metrics(spark, sf_dir), PAGE_SIZE)


# ── q19: paged REST source, fanned out over keys × days ─────────────────────

# Items per page of the paged API (fixed value, the remote default).
PER_PAGE = 100
# Rows of a bucket in which events are ranked to number their pages.
BUCKET_ROWS = 10_000
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _landed_pages(spark, sf_dir, root):
    """Serve ``events`` as a paged API: per (event_type, day) pages of PER_PAGE items,
    each page body ``{"items": [...], "pages": N, "page": n}``, landed by Spark."""
    ev = read_table(spark, sf_dir, "events", EVENT_COLUMNS).withColumn("dt", F.to_date("ts"))
    # Pages are numbered in two levels, so no task ranks a whole (type, day): rows are
    # ranked in buckets of so many ids, and a bucket's first page follows from page counts.
    unit, cell = ["event_type", "dt"], ["event_type", "dt", "bucket"]
    dealt = ev.withColumn("bucket", F.floor(F.col("event_id") / BUCKET_ROWS))
    ranked = dealt.withColumn("local", F.floor((F.row_number().over(Window.partitionBy(*cell).orderBy("event_id")) - 1) / PER_PAGE))
    counts = dealt.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / PER_PAGE).alias("n")).select(
        *[F.col(c).alias(f"at_{c}") for c in cell],
        (F.sum("n").over(Window.partitionBy(*unit).orderBy("bucket")) - F.col("n")).alias("first"),
        F.sum("n").over(Window.partitionBy(*unit)).alias("pages"))
    same = [F.col(c).eqNullSafe(F.col(f"at_{c}")) for c in cell]
    placed = ranked.join(counts, same).withColumn("page", F.col("first") + F.col("local"))
    pages = placed.groupBy("event_type", "dt", "page", "pages").agg(
        F.collect_list(F.struct(*EVENT_COLUMNS)).alias("items"))
    body = F.to_json(F.struct("items", "pages", "page"), JSON_TIME_OPTIONS)
    pages.select("event_type", "dt", "page", body.alias("body")) \
         .sortWithinPartitions("event_type", "dt", "page").write.mode("overwrite").partitionBy("event_type", "dt").parquet(root)


def q19_paged_predicates(spark, sf_dir):
    """Remote predicates: the lazy source with ``where`` on key and day, which asks for those units alone.

    Units outside the filter are keys the API refuses; asking for one would fail the query.
    """
    pin_utc(spark)
    root = new_scratch(spark, "q19-predicates")
    _landed_pages(spark, sf_dir, f"{root}/api")
    events = read_table(spark, sf_dir, "events", ["ts", "event_type"])
    days = incremental.days_of(events, "ts")
    some = days[len(days) // 3: 2 * len(days) // 3]
    if not some:
        return read_table(spark, sf_dir, "events", EVENT_COLUMNS).withColumn("dt", F.to_date("ts")).limit(0)
    grid = incremental.work_grid(events.select("event_type").distinct(), days)
    allowed = {"types": ["click", "view"], "first": some[0].isoformat(), "last": some[-1].isoformat()}
    with paged.predicate_pushdown(spark):
        fetched = paged.read_paged(spark, grid, "strata.plans.registry:refusing_pages", key_col="event_type",
                                   parallel_pages=False, params={"root": f"{root}/api", "key_col": "event_type", **allowed})
        wanted = fetched.where(F.col("key").isin("click", "view") & (F.col("day") >= F.lit(some[0])) & (F.col("day") <= F.lit(some[-1])))
        paged.items_of(wanted).write.parquet(f"{root}/stage")
    return _paged_events(spark.read.parquet(f"{root}/stage"), spark, sf_dir)


def refusing_pages(key, day, page, params):
    """Pages of the units within ``params``; asking for any other is an error."""
    if key not in params["types"] or not params["first"] <= day <= params["last"]:
        raise PermissionError(f"{key} of {day} was not to be asked for")
    return paged.parquet_pages(key, day, page, params)


def _paged_events(items, spark, sf_dir):
    """Fetched items back as events with their key and day."""
    schema = read_table(spark, sf_dir, "events", EVENT_COLUMNS).drop("event_type").schema
    parsed = items.select(F.from_json("item", schema, JSON_TIME_OPTIONS).alias("e"), F.col("day").alias("dt"), F.col("key").alias("event_type"))
    return parsed.select("e.*", "dt", "event_type")


# Pages of a unit that the capped read fetches (fixed value).
PAGE_CAP = 2


def q19_paged_capped(spark, sf_dir):
    """A page cap never cuts silently: per unit, the pages fetched, the pages there are,
    whether the cap left some unread, and the events of the fetched pages."""
    pin_utc(spark)
    root = new_scratch(spark, "q19-capped")
    _landed_pages(spark, sf_dir, f"{root}/api")
    events = read_table(spark, sf_dir, "events", ["ts", "event_type"])
    grid = incremental.work_grid(events.select("event_type").distinct(), incremental.days_of(events, "ts"))
    fetched = paged.read_paged(spark, grid, "strata.sources.paged:parquet_pages", key_col="event_type", max_pages=PAGE_CAP,
                               params={"root": f"{root}/api", "key_col": "event_type"})
    fetched.write.parquet(f"{root}/stage")
    fetched = spark.read.parquet(f"{root}/stage")
    counts = paged.items_of(fetched).groupBy(F.col("key").alias("k"), F.col("day").alias("d")).agg(F.count(F.lit(1)).alias("n_events"))
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("day") == F.col("d"))
    return paged.fetch_report(fetched).join(counts, same, "left").select(
        F.col("key").alias("event_type"), F.col("day").alias("dt"), "pages_fetched", "truncated", "pages_total",
        F.coalesce("n_events", F.lit(0)).alias("n_events"))


def q19_paged_excluded(spark, sf_dir):
    """q19 without the deprecated key ``error``: its cells are neither asked for nor written."""
    return q19_paged_source(spark, sf_dir, deprecated=("error",))


def q19_paged_source(spark, sf_dir, deprecated=()):
    """Work grid (event types × every day) → paged source on executors → raw landing
    by (dt, event_type), empty cells cleared → re-read with typed partition columns."""
    pin_utc(spark)
    root = new_scratch(spark, "q19")
    _landed_pages(spark, sf_dir, f"{root}/api")
    events = read_table(spark, sf_dir, "events", ["ts", "event_type"])
    days = incremental.days_of(events, "ts")
    out = spark.createDataFrame([(d,) for d in deprecated], "event_type string") if deprecated else None
    grid = incremental.work_grid(events.select("event_type").distinct(), days, exclude=out)
    fetched = paged.read_paged(spark, grid, "strata.sources.paged:parquet_pages", key_col="event_type",
                               params={"root": f"{root}/api", "key_col": "event_type"})
    # Remote pages are fetched exactly once per run: stage them as a table in the
    # shared scratch folder; the raw landing and its key bookkeeping read the stage.
    fetched.write.mode("overwrite").parquet(f"{root}/stage")
    fetched = spark.read.parquet(f"{root}/stage")
    raw = paged.items_of(fetched).select(F.col("item").alias("value"), F.col("day").alias("dt"),
                                         F.col("key").alias("event_type"))
    base = f"{root}/raw/events"
    write_keys(raw, base, ["dt", "event_type"], requested=grid, fmt="text")
    schema = read_table(spark, sf_dir, "events", EVENT_COLUMNS).drop("event_type").schema
    return incremental.read_keyed(spark, base, schema, {"dt": "date", "event_type": "string"},
                                  fmt="json", options=JSON_TIME_OPTIONS)


# ── q20 / q21: ad-hoc lake SQL, Kafka-shaped rows ───────────────────────────

def q20_lake_sql(spark, sf_dir):
    """Analyst SQL over lake files: a CSV copy (declared schema) and a parquet path."""
    root = new_scratch(spark, "q20")
    cust = read_table(spark, sf_dir, "customer")
    cust.write.mode("overwrite").option("header", True).csv(f"{root}/customer_csv")
    spark.read.schema(cust.schema).option("header", True).csv(f"{root}/customer_csv") \
        .createOrReplaceTempView("customer_csv")
    return spark.sql(f"""
        SELECT c.c_mktsegment AS segment,
               c.c_nationkey  AS nationkey,
               count(*)       AS customers,
               round(sum(c.c_acctbal), 2) AS acctbal,
               max(n.n_name)  AS nation
        FROM customer_csv c
        LEFT JOIN parquet.`{sf_dir.rstrip('/')}/nation.parquet` n ON c.c_nationkey = n.n_nationkey
        GROUP BY c.c_mktsegment, c.c_nationkey
    """)


def q21_kafka_rows(spark, sf_dir):
    """Events serialised as Kafka (key, value) rows and parsed back by the consumer contract."""
    pin_utc(spark)
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    rows = S.to_kafka_rows(ev.select(
        "event_id", "event_type", "user_id", F.col("value").alias("amount"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), "props"), key_col="event_id")
    back = F.from_json("value", S.EVENT_SCHEMA + ", props string")
    return rows.select("key", back.alias("e")).select(
        "key", "e.event_type", "e.user_id", "e.amount", "e.ts_ms", "e.props")


def queries() -> dict[str, Query]:
    return {
        "q01_entries_explode": q01_entries_explode,
        "q01_rates": q01_rates,
        "q02_nested_lists": q02_nested_lists,
        "q02_industries": q02_industries,
        "q02_document_files": q02_document_files,
        "q03_project": q03_project,
        "q04_posting_fields": q04_posting_fields,
        "q04_merged_postings": q04_merged_postings,
        "q05_tree": q05_tree,
        "q05_tree_files": q05_tree_files,
        "q06_bundle": q06_bundle,
        "q07_day_write": q07_day_write,
        "q08_day_range": q08_day_range,
        "q08_resumed_load": q08_resumed_load,
        "q08_stream_keyed": q08_stream_keyed,
        "q09_hop_metrics": q09_hop_metrics,
        "q10_hop_sliced": q10_hop_sliced,
        "q10_panes": q10_panes,
        "q11_hop_stream": q11_hop_stream,
        "q11_hop_stream_sliced": q11_hop_stream_sliced,
        "q11_hop_stream_dirty": q11_hop_stream_dirty,
        "q11_losses": q11_losses,
        "q11_compacted": q11_compacted,
        "q12_metrics_dedupe": q12_metrics_dedupe,
        "q13_metrics_load": q13_metrics_load,
        "q13_metrics_dirty": q13_metrics_dirty,
        "q13_listed_types": q13_listed_types,
        "q13_new_files": q13_new_files,
        "q14_recent": q14_recent,
        "q14_recent_files": q14_recent_files,
        "q14_recent_metrics": q14_recent_metrics,
        "q15_pivot_cnt": q15_pivot_cnt,
        "q15_pivot_avg": q15_pivot_avg,
        "q16_totals": q16_totals,
        "q17_kpis": q17_kpis,
        "q18_latest": q18_latest,
        "q19_paged_source": q19_paged_source,
        "q19_paged_excluded": q19_paged_excluded,
        "q19_paged_predicates": q19_paged_predicates,
        "q19_paged_capped": q19_paged_capped,
        "q20_lake_sql": q20_lake_sql,
        "q21_kafka_rows": q21_kafka_rows,
    }
