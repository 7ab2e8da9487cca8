"""Exchange-rate documents: ``{Date, Valute: {code: {Name, Value, Nominal}}}`` → rows.

Output: date, currency, name, rate (double, per ``nominal`` units — not divided),
nominal (int), ordered by currency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.flatten import explode_entries

# Field names of the rate documents (fixed values).  Numbers are read as text and
# cast strictly, so a malformed rate fails the job instead of turning into null.
SCHEMA = "Date string, Valute map<string, struct<Name: string, Value: string, Nominal: string>>"


def rates(docs: DataFrame, order: bool = True) -> DataFrame:
    """Flatten parsed rate documents (columns ``Date`` and ``Valute``).

    ``date`` is the UTC calendar date of the document's instant: the text is cast
    to a timestamp (offset honoured) and then to a date, under the UTC session zone.
    """
    rows = explode_entries(docs, "Valute", "currency", "_v", keep=["Date"])
    out = rows.select(
        F.col("Date").cast("timestamp").cast("date").alias("date"),
        "currency",
        F.col("_v.Name").alias("name"),
        F.col("_v.Value").cast("double").alias("rate"),
        F.col("_v.Nominal").cast("int").alias("nominal"),
    )
    # Ordered by currency; the tie-breakers make the order total, which also lets the
    # range partitioner split a currency that holds much of the data over tasks.
    return out.orderBy("currency", "date", "name", "rate", "nominal") if order else out
