"""Paged REST collections as a partitioned Spark source (``format("paged_json")``).

A *unit* is one (key, day) cell of the work grid — e.g. one role for one day.  The
source splits the units over Spark partitions; each task fetches its units page by
page through an injected *page getter* and emits every item as JSON text, so the
fan-out runs on executors instead of a process pool on one machine.

Page loop per unit (``page = start_page, start_page + 1, ...``):
* stop at an empty page, or after the last page when the payload says how many
  pages there are (``pages_key``);
* a getter call that fails for the moment (``TransientError``, a broken or timed-out
  connection) is tried ``retries`` times with exponential back-off, waiting at least as
  long as the error's ``retry_after`` asks; any other error stops the read at once;
* ``max_pages`` (default: none) caps the pages per unit.  A cap never drops rows
  silently: every unit also yields *report rows* (``item`` null) with the pages
  fetched and ``truncated = true`` when pages were left unread, by the cap or because a
  page that should hold items came back empty; ``fetch_report`` adds them up per unit.

Options (all strings):
    units         JSON list of [key, "YYYY-MM-DD"] pairs (the work grid)
    getter        "package.module:function"; called as f(key, day, page, params) and
                  returning a dict (with ``items_key``) or a bare list of items
    params        JSON object passed to the getter (remote predicates: role, area, text)
    items_key     key of the item list in a dict payload (default "items")
    pages_key     key of the page count in a dict payload (default "pages")
    start_page    first page number (default 0)
    max_pages     cap of pages per unit (default: no cap)
    retries       tries per page (default 3); backoff  first pause in seconds (default 0.5)
    num_partitions  Spark partitions to spread the units over (default: one per unit)

Predicates: with ``spark.sql.python.filterPushdown.enabled`` on, ``where`` filters on
``key`` (=, IN) and ``day`` (=, IN, <, <=, >, >=) prune units before any page is
fetched — the Spark form of the remote predicates (lazy reads, ``parallel_pages=False``).
The filters are still handed back to Spark, so results are exact either way.

Hot units: ``read_paged(parallel_pages=True)`` (the default) fetches page 0 of every
unit first and then spreads the further pages over the tasks as ranges of pages.  It uses
the same page loop, but its units and ranges are rows of a DataFrame.  A getter with an
attribute ``by_range``, a function (key, day, first, last, params) → [(page, payload)],
is asked for a range at once.
"""

from __future__ import annotations

import datetime as _dt
import importlib
import json
import os
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual)
from pyspark.sql.types import StructType

from strata.session import default_parallelism, scratch_root, ship_package
from strata.sinks.layout import partition_path

class TransientError(Exception):
    """A page can't be had now but may be later; ``retry_after``: seconds to wait at least."""

    def __init__(self, message: str, retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


TRANSIENT = (TransientError, ConnectionError, TimeoutError)
# Answers that ask to come back later (fixed values).
BUSY_STATUS = (429, 503)

#: Pages of a range that a task fetches in one go, and item rows of an Arrow batch.
PAGES_PER_RANGE, BATCH_ROWS = 16, 1000

SCHEMA = ("key string, day date, page int, item string, "
          "pages_fetched int, truncated boolean, pages_total int")


class _Units(InputPartition):
    """Work items of one task, each ending in one report row:

    ``[key, day, first_page, "all", fetched_before]``: loop pages from ``first_page``;
    ``[key, day, first_page, "range", last_page]``: fetch exactly those pages.
    """

    def __init__(self, units: list[list]):
        super().__init__(units)
        self.units = units


def _resolve(path: str):
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.start_page = int(options.get("start_page", "0"))
        self.units = [_work_item(u, self.start_page) for u in json.loads(options.get("units", "[]"))]
        self.getter = options["getter"]
        self.params = json.loads(options.get("params", "{}"))
        self.items_key = options.get("items_key", "items")
        self.pages_key = options.get("pages_key", "pages")
        self.max_pages = int(options["max_pages"]) if options.get("max_pages") else None
        self.retries = int(options.get("retries", "3"))
        self.backoff = float(options.get("backoff", "0.5"))
        self.num_partitions = int(options.get("num_partitions", "0")) or len(self.units) or 1

    def partitions(self) -> Sequence[InputPartition]:
        n = max(1, min(self.num_partitions, len(self.units)))
        return [_Units(self.units[i::n]) for i in range(n)]

    def _pages(self, get, key, day, first, last):
        """(page, payload) of a range: in one call where the getter can (``by_range``), else page by page."""
        if hasattr(get, "by_range"):
            yield from self._fetch(get.by_range, key, day, first, last)
            return
        for page in range(first, last + 1):
            yield page, self._fetch(get, key, day, page)

    def _fetch(self, get, key, day, *pages):
        tries = max(1, self.retries)  # always at least one call
        for attempt in range(tries):
            try:
                return get(key, day, *pages, self.params)
            except TRANSIENT as exc:
                if attempt == tries - 1:
                    raise
                time.sleep(max(self.backoff * (2 ** attempt), getattr(exc, "retry_after", None) or 0.0))

    def _split(self, payload):
        if isinstance(payload, dict):
            total = payload.get(self.pages_key)
            return payload.get(self.items_key) or [], None if total is None else int(total)
        return payload or [], None

    def read(self, partition: _Units) -> Iterator[tuple]:
        get = _resolve(self.getter)
        for key, day, first, mode, number in partition.units:
            d = _dt.date.fromisoformat(day)
            if mode == "range":
                held, missing = 0, False
                for page, payload in self._pages(get, key, day, first, number):
                    items, _ = self._split(payload)
                    held, missing = held + bool(items), missing or not items
                    for item in items:
                        yield (key, d, page, json.dumps(item, ensure_ascii=False), None, None, None)
                yield (key, d, None, None, held, missing, None)
                continue
            page, truncated, total, fetched = first, False, None, number
            while True:
                items, said = self._split(self._fetch(get, key, day, page))
                total = total if said is None else said
                fetched += 1
                if not items:
                    truncated = total is not None and page < self.start_page + total
                    break
                for item in items:
                    yield (key, d, page, json.dumps(item, ensure_ascii=False), None, None, None)
                if total is not None and page >= self.start_page + total - 1:
                    break  # that was the last page
                if self.max_pages is not None and fetched >= self.max_pages:
                    truncated = True  # the cap stopped the loop with pages left (or unknown)
                    break
                page += 1
            yield (key, d, None, None, fetched, truncated, total)


def _work_item(unit, start_page: int) -> list:
    """``[key, day]`` (a whole unit) or an explicit item of :class:`_Units`."""
    return list(unit) if len(unit) == 5 else [unit[0], unit[1], start_page, "all", 0]


_DAY_TESTS = {
    EqualTo: lambda d, v: d == v,
    GreaterThan: lambda d, v: d > v,
    GreaterThanOrEqual: lambda d, v: d >= v,
    LessThan: lambda d, v: d < v,
    LessThanOrEqual: lambda d, v: d <= v,
}


class _PushdownPagedReader(_PagedReader):
    """The reader with unit pruning by ``key`` / ``day`` predicates."""

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) else None
            if column == "key" and isinstance(f, (EqualTo, In)):
                allowed = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.units = [u for u in self.units if u[0] in allowed]
            elif column == "day" and isinstance(f, In):
                allowed = set(f.value)
                self.units = [u for u in self.units if _dt.date.fromisoformat(u[1]) in allowed]
            elif column == "day" and type(f) in _DAY_TESTS:
                test = _DAY_TESTS[type(f)]
                self.units = [u for u in self.units if test(_dt.date.fromisoformat(u[1]), f.value)]
            yield f  # Spark re-checks every filter; pruning only saves fetches


class PagedJsonSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        if self.options.get("pushdown", "false").lower() == "true":
            return _PushdownPagedReader(self.options)
        return _PagedReader(self.options)


def register(spark: SparkSession) -> None:
    ship_package(spark)  # the workers import this module and the page getters
    spark.dataSource.register(PagedJsonSource)


@contextmanager
def predicate_pushdown(spark: SparkSession) -> Iterator[None]:
    """Within the block, lazy reads of the session hand ``where`` on key and day to the source.

    Spark reads the setting when a query is planned, so read, filter and write inside the block."""
    name = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_paged(spark: SparkSession, units: DataFrame, getter: str, key_col: str = "key",
               day_col: str = "dt", parallel_pages: bool = True, pages_per_range: int = PAGES_PER_RANGE,
               **options) -> DataFrame:
    """Read the units of a work grid (a DataFrame of key and day) through ``getter``.

    A null key is a unit like any other (the getter gets None); a null day is no unit and
    raises.  Returns item rows and report rows.

    ``parallel_pages``: units and page ranges are rows of DataFrames that the fetching tasks
    read; the driver holds neither, whatever their number.  Page 0 of every unit is fetched
    first (and checkpointed, so it is fetched once); it tells how many pages each unit has, and the
    further pages are dealt over the tasks in ranges of ``pages_per_range``, so a unit with
    very many pages is not read by one task page after page.  Units whose payloads carry no page count
    continue page by page.  The page-0 probe runs when this function is called, so filter
    the grid (not the result) to choose units.

    With ``parallel_pages=False`` the read is the lazy ``paged_json`` source: ``where`` on key/day
    prunes units through predicate pushdown.  Its grid is collected to build the
    partitions, so it is for grids of moderate size.
    """
    register(spark)
    grid = units.select(F.col(key_col).cast("string").alias("key"), F.col(day_col).cast("date").alias("day")).distinct()
    if grid.where(F.col("day").isNull()).limit(1).collect():
        raise ValueError(f"the grid has cells without a day in {day_col}")
    opts = {k: (json.dumps(v) if isinstance(v, (dict, list)) else str(v)) for k, v in options.items()
            if v is not None}
    opts.setdefault("num_partitions", str(default_parallelism(spark) * 2))
    if not parallel_pages:
        cells = sorted(([r[0], r[1].isoformat()] for r in grid.collect()), key=lambda u: (u[0] is not None, u[0] or "", u[1]))
        opts.setdefault("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
        return (spark.read.format("paged_json").option("units", json.dumps(cells))
                     .option("getter", getter).options(**opts).load())
    scratch_root(spark)
    cap = int(opts["max_pages"]) if "max_pages" in opts else None
    start = int(opts.get("start_page", "0"))
    plain = {**opts, "getter": getter}
    whole, none = F.lit("all"), F.lit(None)
    probe = grid.select("key", "day", F.lit(start).alias("first"), whole.alias("mode"), F.lit(0).alias("number"))
    first = _fetch_rows(probe, {**plain, "max_pages": "1"}).checkpoint(eager=True)
    report = fetch_report(first)
    more = report.where(F.col("truncated"))
    counted, blind = more.where(F.col("pages_total").isNotNull()), more.where(F.col("pages_total").isNull())
    last = F.col("pages_total") if cap is None else F.least("pages_total", F.lit(cap))
    step = F.lit(pages_per_range)
    n = F.explode(F.sequence(F.lit(1), last - 1, step)).alias("n")
    ranges = counted.where(last > 1).select("key", "day", last.alias("last"), n).select(
        "key", "day", (F.lit(start) + F.col("n")).alias("first"), F.lit("range").alias("mode"),
        (F.lit(start) + F.least(F.col("n") + step, F.col("last")) - 1).cast("int").alias("number"))
    goes_on = cap is None or cap > 1  # the probe used up a cap of one page
    rest = blind.where(F.lit(goes_on)).select("key", "day", F.lit(start + 1).alias("first"), whole.alias("mode"), F.lit(1).alias("number"))
    page, item = none.cast("int").alias("page"), none.cast("string").alias("item")
    capped = F.lit(False) if cap is None else F.col("pages_total") > cap
    reports = _as_rows(report.where(~F.coalesce("truncated", F.lit(False)))) \
        .unionByName(counted.select("key", "day", page, item, F.lit(1).alias("pages_fetched"), capped.alias("truncated"), "pages_total")) \
        .unionByName(_as_rows(blind.where(F.lit(not goes_on))))
    return items_of(first, full=True).unionByName(reports).unionByName(_fetch_rows(ranges.unionByName(rest), plain))


def _fetch_rows(work: DataFrame, options: dict[str, str]) -> DataFrame:
    """Fetch the work items of ``work`` (see :class:`_Units`; one per row), spread over the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType.fromDDL(SCHEMA)

    def fetch(batches):
        import pyarrow as pa

        reader, arrow = _PagedReader(options), to_arrow_schema(schema)

        def batch(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        held: list[tuple] = []
        for b in batches:
            items = [[r["key"], r["day"].isoformat(), r["first"], r["mode"], r["number"]] for r in b.to_pylist()]
            for row in reader.read(_Units(items)):
                held.append(row)
                if len(held) >= BATCH_ROWS:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    return work.repartition(int(options["num_partitions"])).mapInArrow(fetch, schema)


def _as_rows(report: DataFrame) -> DataFrame:
    return report.select("key", "day", F.lit(None).cast("int").alias("page"),
                         F.lit(None).cast("string").alias("item"), "pages_fetched", "truncated", "pages_total")


def items_of(df: DataFrame, full: bool = False) -> DataFrame:
    """The item rows (``full`` keeps every column, for unions with report rows)."""
    rows = df.where(F.col("item").isNotNull())
    return rows if full else rows.select("key", "day", "page", "item")


def fetch_report(df: DataFrame) -> DataFrame:
    """One row per unit: pages fetched, whether pages were left unread, page count."""
    return df.where(F.col("item").isNull()).groupBy("key", "day").agg(
        F.sum("pages_fetched").cast("int").alias("pages_fetched"), F.max("truncated").alias("truncated"),
        F.max("pages_total").alias("pages_total"))


# ── page getters ────────────────────────────────────────────────────────────

def file_pages(key: str, day: str, page: int, params: dict):
    """Pages stored as files ``<root>/<key>/<day>/<page>.json``; a missing file is an
    empty page.  Stands in for the remote API in tests."""
    path = os.path.join(params["root"], str(key), day, f"{page}.json")
    if not os.path.exists(path):
        return []
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _filesystem(uri: str):
    """pyarrow file system and path for a Hadoop-style URI (``file:/x``, ``s3a://b/x``)."""
    from pyarrow import fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def parquet_pages(key: str, day: str, page: int, params: dict):
    """Pages held in a parquet dataset partitioned by ``<key_col>=…/dt=…`` with
    columns ``page`` and ``body`` (a JSON payload), as landed by Spark."""
    return _parquet_page_range(key, day, page, page, params)[0][1]


def _parquet_page_range(key: str, day: str, first: int, last: int, params: dict) -> list[tuple[int, dict]]:
    """(page, payload) of a range of pages: the unit's folder is opened once for all of them."""
    import pyarrow.dataset as ds
    from pyarrow import fs as pafs

    filesystem, root = _filesystem(params["root"])
    folder = partition_path(root, {params.get("key_col", "key"): key, "dt": day})
    found = {}
    if filesystem.get_file_info(folder).type == pafs.FileType.Directory:
        number = ds.field("page")
        table = ds.dataset(folder, format="parquet", filesystem=filesystem).to_table(
            filter=(number >= first) & (number <= last), columns=["page", "body"])
        found = dict(zip(table.column("page").to_pylist(), table.column("body").to_pylist(), strict=True))
    return [(n, json.loads(found[n]) if n in found else {"items": [], "pages": 0}) for n in range(first, last + 1)]


parquet_pages.by_range = _parquet_page_range


def http_pages(key: str, day: str, page: int, params: dict):
    """GET ``params["url"]`` with the unit as query parameters (``key_param``, the day
    as ``date_from``/``date_to`` half-open, ``page``); JSON body.  A busy answer and a
    failed connection are transient; every other status is an error."""
    import urllib.error
    import urllib.parse
    import urllib.request

    nxt = (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()
    query = {**params.get("query", {}), params.get("key_param", "key"): key,
             "date_from": day, "date_to": nxt, "page": page}
    url = f"{params['url']}?{urllib.parse.urlencode(query)}"
    req = urllib.request.Request(url, headers=params.get("headers", {}))
    try:
        with urllib.request.urlopen(req, timeout=float(params.get("timeout", 10))) as resp:
            return json.loads(resp.read().decode("utf-8"))
    except urllib.error.HTTPError as exc:
        if exc.code in BUSY_STATUS:
            raise TransientError(f"{url}: {exc.code}", seconds_of(exc.headers.get("Retry-After"))) from exc
        raise
    except urllib.error.URLError as exc:
        raise TransientError(f"{url}: {exc.reason}") from exc


def seconds_of(retry_after: str | None) -> float | None:
    """Seconds a ``Retry-After`` header asks for: a number, or a date in the future."""
    from email.utils import parsedate_to_datetime

    if not retry_after:
        return None
    try:
        return max(0.0, float(retry_after))
    except ValueError:
        pass
    try:
        at = parsedate_to_datetime(retry_after)
    except ValueError:
        return None
    return max(0.0, at.timestamp() - time.time())
