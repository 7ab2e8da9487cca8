"""strata: layered lake transforms as plain DataFrame -> DataFrame functions on Spark.

Sub-packages
    sources    readers: JSON documents, whole-text files, tolerant NDJSON, paged REST source,
               incremental listings, recent rows by file statistics
    functions  column helpers: JSON paths and kinds over VARIANT
    operators  flatten (explode / tree / bundle), hopping metrics, read-side metrics
    sinks      lake layout, partitioned writers with safe reruns, compaction behind a manifest
    streaming  event parsing, the streaming metrics job, keyed batches with a ledger, Kafka-shaped rows
    plans      source-specific transforms (rates, catalogue, postings), incremental and resumable
               loads, merges by id, jobs

The names below are the public surface; import them from here.
"""

from strata.functions.json import (is_json_array, json_doc, json_entries, json_items, json_kind,
                                   json_length, json_string, json_value, to_variant)
from strata.operators.flatten import (explode_bundle, explode_entries, explode_path, flatten_tree,
                                      flatten_tree_sql, pluck, project_fields)
from strata.operators.metrics import (dedupe_windows, kpis, latest, pivot_metric, recent,
                                      round_metrics, totals)
from strata.operators.windows import hop_metrics, recent_hop_metrics
from strata.plans.incremental import day_range, day_slice, days_of, read_keyed, run_days, work_grid
from strata.plans.jobs import (build_catalogue, build_postings, build_rates, dashboard_frames, keep_compact,
                               load_postings, merge_postings, run_metrics_stream)
from strata.plans.merge import merge_latest, read_merged
from strata.plans.progress import Progress, load_days
from strata.session import CLUSTER_CONF, build_session, clear_scratch, new_scratch, object_store_conf, pin_utc, scratch_root
from strata.sinks.compaction import compact, read_live, vacuum
from strata.sinks.layout import partition_path, processed_dir, processed_root, raw_dir
from strata.sinks.writers import land_raw, write_keys, write_partition
from strata.sources.documents import json_docs, ndjson, parse_docs, whole_text
from strata.sources.file_stats import file_ranges, recent_metrics, recent_rows
from strata.sources.files import list_files, path_value
from strata.sources.metric_files import line_quality, load_metrics
from strata.sources.paged import fetch_report, items_of, read_paged
from strata.sources.snapshots import Snapshots, process_new
from strata.streaming.events import (LossListener, drain_until_idle, event_quality, parse_events, rolling_metrics,
                                     start_metrics_stream, text_stream, to_kafka_rows)
from strata.streaming.keyed import read_committed, start_keyed_stream

__version__ = "0.1.0"

__all__ = [name for name in dir() if not name.startswith("_")]
