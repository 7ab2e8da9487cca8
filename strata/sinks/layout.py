"""Lake path convention (partition *directories*, never single files).

    <root>/raw/<source>/<dataset>/dt=YYYY-MM-DD/     data as received
    <root>/processed/<dataset>/dt=YYYY-MM-DD/...     typed parquet

``dt`` is always an argument: a job's day is its partition key, never "today".
"""

from __future__ import annotations

from datetime import date, datetime

# Characters Spark escapes in partition directory names, and its null marker
# (fixed values, so that paths built here match the ones Spark writes and reads).
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _text(value) -> str:
    if value is None or value == "":
        return NULL_PARTITION  # Spark files empty strings under the null marker too
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, datetime):  # Spark's text of a timestamp (fraction without trailing zeros)
        fraction = f".{value.microsecond:06d}".rstrip("0") if value.microsecond else ""
        value = f"{value:%Y-%m-%d %H:%M:%S}{fraction}"
    elif isinstance(value, date):
        return value.isoformat()
    return "".join(f"%{ord(ch):02X}" if ch in _ESCAPED else ch for ch in str(value))


def partition_path(base: str, keys: dict) -> str:
    """``base/k1=v1/k2=v2`` with Spark's escaping of the values."""
    parts = [f"{k}={_text(v)}" for k, v in keys.items()]
    return "/".join([base.rstrip("/"), *parts])


def raw_dir(root: str, source: str, dataset: str, dt: date | str) -> str:
    return partition_path(f"{root.rstrip('/')}/raw/{source}/{dataset}", {"dt": dt})


def processed_root(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/processed/{dataset}"


def processed_dir(root: str, dataset: str, dt: date | str) -> str:
    return partition_path(processed_root(root, dataset), {"dt": dt})
