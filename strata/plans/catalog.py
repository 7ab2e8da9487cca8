"""Reference catalogues: nested dictionaries flattened into tables.

Each function takes parsed documents (or raw JSON text for the tree and the bundle)
and returns the flat table; none of them collects or shuffles, except the final
ordering of the role catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.flatten import explode_bundle, explode_path, flatten_tree

# Field names of the catalogue documents (fixed values).
ROLE = ("struct<id: string, name: string, accept_incomplete_resumes: boolean, is_default: boolean, "
        "select_deprecated: boolean, search_deprecated: boolean>")
ROLES_SCHEMA = f"categories array<struct<id: string, name: string, roles: array<{ROLE}>>>"
INDUSTRIES_SCHEMA = "id string, name string, industries array<struct<id: string, name: string>>"
LANGUAGES_SCHEMA = "id string, name string, uid string"

AREA_FIELDS = {
    "area_id": ("$.id", "string"),
    "parent_id": ("$.parent_id", "string"),
    "name": ("$.name", "string"),
    "lat": ("$.lat", "double"),
    "lng": ("$.lng", "double"),
}
BUNDLE_FIELDS = {"id": ("$.id", "string"), "name": ("$.name", "string")}


def professional_roles(docs: DataFrame, order: bool = True) -> DataFrame:
    """categories[] → roles[]: one row per (category, role); empty/null lists vanish.

    Ordered by the ids read as integers (``"2"`` before ``"10"``); ``bigint`` so
    long ids do not overflow.  Ids that are not numbers sort after the numbers, by
    their text, instead of failing the job.
    """
    rows = explode_path(docs, [("categories", "cat"), ("cat.roles", "role")])
    out = rows.select(  # output column names (fixed values)
        F.col("cat.id").alias("category_id"), F.col("cat.name").alias("category_name"),
        F.col("role.id").alias("role_id"), F.col("role.name").alias("role_name"),
        F.col("role.accept_incomplete_resumes").alias("accept_incomplete_resumes"),
        F.col("role.is_default").alias("is_default"),
        F.col("role.select_deprecated").alias("select_deprecated"),
        F.col("role.search_deprecated").alias("search_deprecated"),
    )
    if order:
        out = out.orderBy(F.col("category_id").try_cast("bigint").asc_nulls_last(), "category_id",
                          F.col("role_id").try_cast("bigint").asc_nulls_last(), "role_id")
    return out


def industries(groups: DataFrame) -> DataFrame:
    """group[] → industries[]: one row per industry with its group."""
    rows = explode_path(groups, [("industries", "sub")], keep=["id", "name"])
    return rows.select(
        F.col("id").alias("industry_group_id"), F.col("name").alias("industry_group_name"),
        F.col("sub.id").alias("industry_id"), F.col("sub.name").alias("industry_name"),
    )


def languages(rows: DataFrame) -> DataFrame:
    """Flat dictionary: id, name, uid."""
    return rows.select("id", "name", "uid")


def areas(texts: DataFrame, text_col: str = "value", checkpoint: bool = True, rebalance: bool = True) -> DataFrame:
    """Region tree (``[{id, parent_id, name, lat, lng, areas: [...]}, ...]``) → flat rows.

    ``lat``/``lng`` may arrive as numbers or text; text that is not a number → null.
    """
    return flatten_tree(texts, text_col, AREA_FIELDS, children="$.areas", checkpoint=checkpoint, rebalance=rebalance)


def dictionaries(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """Bundle ``{name: [ {id, name}, ... ], ...}`` → (dict_name, id, name)."""
    return explode_bundle(texts, text_col, BUNDLE_FIELDS)
