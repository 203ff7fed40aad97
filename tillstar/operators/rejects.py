"""Cells that cleaning turns into null, and rows of the wrong length, as rows of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from tillstar.functions import parse_order_date
from tillstar.schemas import TABLE_SCHEMAS, Tables

# Key of a row, in the order of preference, by table.
ROW_KEYS = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_item_id", "order_id"),
}
CORRUPT = "_corrupt_record"
_CELL = "array<struct<column_name:string,raw_text:string,reason:string>>"


def _typed(table: str) -> dict[str, tuple[Column, str]]:
    """The columns of a table that are not text, as cleaning reads them, and why they may
    be null there."""
    out = {}
    for field in TABLE_SCHEMAS[table].fields:
        text = F.col(field.name).cast("string")
        if field.name == "order_date":
            out[field.name] = (parse_order_date(text), "not_a_date")
        elif isinstance(field.dataType, IntegerType):
            out[field.name] = (text.try_cast("int"), "not_an_integer")
        elif isinstance(field.dataType, DoubleType):
            out[field.name] = (text.try_cast("double"), "not_a_number")
    return out


def rejected_cells(raw: DataFrame, table: str) -> DataFrame:
    """(table_name, row_key, column_name, raw_text, reason) of one table as it was read,
    with text in the columns that cleaning types.

    One row per cell that has text but no value once it is typed; a row that may have
    several. Where the reader kept lines of the wrong length in ``_corrupt_record``, such a
    line is one more row, with its whole text and no column. Empty cells are null, not
    rejected. One scan of the table, nothing is shuffled.
    """
    cells = [
        F.when(
            F.col(c).isNotNull() & value.isNull(),
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw_text"), F.lit(why).alias("reason")),
        )
        for c, (value, why) in _typed(table).items()
        if c in raw.columns
    ]
    if CORRUPT in raw.columns:
        line = F.col(CORRUPT)
        text = F.lit(None).cast("string")
        cells.append(
            F.when(
                line.isNotNull(),
                F.struct(text.alias("column_name"), line.alias("raw_text"), F.lit("wrong_length").alias("reason")),
            )
        )
    found = F.array_compact(F.array(*cells)) if cells else F.lit(None)
    key = F.coalesce(*[F.col(k).cast("string") for k in ROW_KEYS[table]], F.lit(None).cast("string"))
    rows = raw.select(F.lit(table).alias("table_name"), key.alias("row_key"), found.cast(_CELL).alias("cells"))
    return rows.select("table_name", "row_key", F.inline("cells"))


def all_rejected_cells(tables: Tables) -> DataFrame:
    """The same of all four tables, read raw."""
    return reduce(
        DataFrame.unionByName, [rejected_cells(df, name) for name, df in tables._asdict().items()]
    )
