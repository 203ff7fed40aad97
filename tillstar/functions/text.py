"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardize(df: DataFrame, *columns: str) -> DataFrame:
    """Lower-case and trim spaces (spaces only: tabs and newlines stay)."""
    return df.withColumns({c: F.expr(f"lower(trim({c}))") for c in columns})
