"""Rows to keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_messages(rows: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, value) with the whole row as JSON; NULL columns are left out of the JSON."""
    return rows.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
