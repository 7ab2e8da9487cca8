"""Job postings: nested items → one flat row per posting, role lists kept as arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.flatten import pluck, project_fields

# Field names of the posting items (fixed values).
_REF = "struct<id: string, name: string>"
SCHEMA = (
    f"id string, name string, area {_REF}, employer {_REF}, "
    "salary struct<`from`: double, `to`: double, currency: string, gross: boolean>, "
    f"experience {_REF}, employment {_REF}, schedule {_REF}, type {_REF}, "
    "published_at string, created_at string, alternate_url string, "
    f"professional_roles array<{_REF}>"
)


def vacancies(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested posting items → flat table.

    Struct fields become ``<struct>_<field>`` columns (null struct → null fields);
    timestamps with an offset are cast to instants; ``professional_roles`` becomes
    two parallel arrays of ids and names (null list → null arrays).  ``keep``
    columns (e.g. partition keys) are passed through unchanged.
    """
    # output column names (fixed values)
    fields: dict = {"id": "id", "name": "name"}
    for ref in ("area", "employer"):
        fields[f"{ref}_id"], fields[f"{ref}_name"] = f"{ref}.id", f"{ref}.name"
    fields.update({
        "salary_from": "salary.`from`", "salary_to": "salary.`to`",
        "salary_currency": "salary.currency", "salary_gross": "salary.gross",
    })
    for ref in ("experience", "employment", "schedule", "type"):
        fields[f"{ref}_id"], fields[f"{ref}_name"] = f"{ref}.id", f"{ref}.name"
    fields.update({
        "published_at": F.col("published_at").cast("timestamp"),
        "created_at": F.col("created_at").cast("timestamp"),
        "alternate_url": "alternate_url",
        "professional_role_ids": pluck("professional_roles", "id"),
        "professional_role_names": pluck("professional_roles", "name"),
    })
    fields.update({c: c for c in keep})
    return project_fields(items, fields)
