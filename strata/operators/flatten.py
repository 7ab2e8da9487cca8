"""Flatten nested documents into rows.

All of these are generators over single rows (``explode``): they run inside the
scan's tasks, need no shuffle and split as finely as the input does.  Only the
tree walk (:func:`flatten_tree`) runs several jobs, one per ``LEVELS`` depth levels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.json import json_entries, json_items, json_value, to_variant
from strata.session import scratch_root

# A field spec is (json path, spark type), e.g. {"area_id": ("$.id", "string")}.
FieldSpec = Mapping[str, tuple[str, str]]

#: Levels of a tree that one pass of the walk unnests (fixed value; no depth cap).
LEVELS = 4


def explode_entries(df: DataFrame, map_col: str, key: str = "key", value: str = "value",
                    keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of a map (an object with data-dependent keys).

    ``map_col`` may be a MAP column or a VARIANT object.  An empty or null map
    gives no rows, as a lateral ``json_each`` does.
    """
    field = df.schema[map_col].dataType.typeName()
    entries = json_entries(map_col) if field == "variant" else F.col(map_col)
    return df.select(*keep, F.explode(entries).alias(key, value))


def explode_path(df: DataFrame, steps: Sequence[tuple[str, str]],
                 keep: Sequence[str] = ()) -> DataFrame:
    """Chained lateral unnests, e.g. ``[("categories", "cat"), ("cat.roles", "role")]``.

    Each step explodes an array column (which may be a field of an earlier step)
    into a new column.  Inner semantics: a parent whose list is empty or null
    vanishes, as with comma joins against ``UNNEST``.
    """
    out, carried = df, list(keep)
    for path, alias in steps:
        out = out.select(*carried, F.explode(F.col(path)).alias(alias))
        carried.append(alias)
    return out


def project_fields(df: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """Select nested fields under new names: ``{"area_id": "area.id", ...}``.

    A null struct gives null fields.  Keyword-named fields need back-quotes
    (``"salary.`from`"``).  Parquet scans prune to the nested fields used.
    """
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(name)
                       for name, src in fields.items()])


def pluck(array_col: str | Column, field: str) -> Column:
    """``list_transform(arr, x -> x.field)``: the field of every element; null list → null."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    return F.transform(arr, lambda x: x[field])


def _extract(node: Column, fields: FieldSpec) -> list[Column]:
    return [json_value(node, path, type_).alias(name) for name, (path, type_) in fields.items()]


def explode_bundle(df: DataFrame, doc: str, fields: FieldSpec, name_col: str = "dict_name",
                   keep: Sequence[str] = ()) -> DataFrame:
    """A bundle object ``{name: [item, ...], ...}`` → one row per item of every array entry.

    ``doc`` is JSON text or VARIANT.  Entries whose value is not an array (objects,
    numbers, strings such as ``"[x]"``, null) are skipped; empty arrays give no
    rows; an item without a requested key gives null for that field.
    """
    v = to_variant(doc) if df.schema[doc].dataType.typeName() == "string" else F.col(doc)
    entries = df.select(*keep, F.explode(json_entries(v)).alias(name_col, "_value"))
    items = entries.select(*keep, name_col, F.explode(json_items("_value")).alias("_item"))
    return items.select(*keep, name_col, *_extract(F.col("_item"), fields))


def flatten_tree(df: DataFrame, doc: str, fields: FieldSpec, children: str = "$.areas",
                 keep: Sequence[str] = (), checkpoint: bool = True, rebalance: bool = True) -> DataFrame:
    """Flatten trees of any depth: one output row per node, with ``fields`` extracted.

    ``doc`` holds a JSON array of root nodes (text or VARIANT); each node's children
    are the array at ``children``.  Bag semantics: every node of every document is
    emitted once per occurrence.  Nodes whose children are missing, null, empty or
    not an array are leaves.

    The walk goes in rounds of ``LEVELS`` levels.  Within a round a node's fields are
    extracted in the pass that unnests it, so a level costs neither a copy of the subtrees
    nor a job; the round's flat rows are materialised once, with the children of its deepest
    nodes, which are the next round's frontier, until no node has children left.  There is
    no depth cap.  With ``checkpoint`` each round is a reliable checkpoint in the session's
    checkpoint folder, so it is computed once and survives executor loss, and plans stay
    short however deep the tree is.

    ``explode`` keeps rows where they are, so without help one huge document would
    be walked by one task at every level.  With ``rebalance`` each frontier is
    rebalanced (AQE sizes the partitions) before it is walked, so the nodes
    of a hot document spread over the cluster from the first level on.  It applies
    only with ``checkpoint``: without the lineage cut, a shuffle per round would pile
    up in one ever deeper plan.
    """
    v = to_variant(doc) if df.schema[doc].dataType.typeName() == "string" else F.col(doc)
    if checkpoint:
        scratch_root(df.sparkSession)  # make sure a (shared) checkpoint folder is set
    names = list(fields)
    below = json_items("_node", children).alias("_below")

    def walk(frontier: DataFrame) -> DataFrame:
        """(keep, fields, _below) of the frontier's nodes and of LEVELS - 1 levels under them."""
        rows = (frontier.hint("rebalance") if rebalance and checkpoint else frontier).select(
            *keep, *_extract(F.col("_node"), fields), below)
        for _ in range(LEVELS - 1):  # a node (at position 0) and then its children
            family = F.concat(F.array(F.lit(None).cast("variant")), F.coalesce("_below", F.array().cast("array<variant>")))
            rows = rows.select(*keep, *names, F.posexplode(family).alias("_at", "_node"))
            rows = rows.select(*keep, *[F.when(F.col("_at") == 0, F.col(f"`{n}`")).otherwise(x).alias(n)
                                        for n, x in zip(names, _extract(F.col("_node"), fields))], below)
        return rows.checkpoint(eager=True) if checkpoint else rows

    rounds = [walk(df.select(*keep, F.explode(json_items(v)).alias("_node")))]
    while not (pending := rounds[-1].where("size(_below) > 0")).isEmpty():
        rounds.append(walk(pending.select(*keep, F.explode("_below").alias("_node"))))
    out = rounds[0].select(*keep, *names)
    for rows in rounds[1:]:
        out = out.unionAll(rows.select(*keep, *names))
    return out


def flatten_tree_sql(spark, view: str, doc: str, fields: FieldSpec,
                     children: str = "$.areas") -> DataFrame:
    """The same walk as a recursive CTE over a temp view (one statement, no checkpoints).

    Spark caps recursion at 100 levels and 1,000,000 rows by default; this form is
    used with ``spark.sql.cteRecursionLevelLimit`` / ``spark.sql.cteRecursionRowLimit``
    raised by the caller.  It is the cross-check of :func:`flatten_tree`.
    """
    cols = ",\n  ".join(f"try_variant_get(node, '{p}', '{t}') AS `{n}`"
                        for n, (p, t) in fields.items())
    return spark.sql(f"""
        WITH RECURSIVE nodes(node) AS (
            SELECT explode(try_variant_get(parse_json(`{doc}`), '$', 'array<variant>')) FROM {view}
            UNION ALL
            SELECT explode(try_variant_get(node, '{children}', 'array<variant>')) FROM nodes
        )
        SELECT {cols} FROM nodes
    """)
