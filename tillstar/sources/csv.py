"""Headed CSV files with the declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tillstar.schemas import CSV_OPTIONS, TABLE_SCHEMAS


def read_csv_table(
    spark: SparkSession, path: str, table: str, escape: str = '"', multi_line: bool = False
) -> DataFrame:
    """Scan ``<path>/<table>.csv``.

    CSV binds columns by position, so a file with swapped columns would be read
    silently wrong. ``enforceSchema=False`` makes every task compare the header of
    the file it reads with the declared names and fail on a difference. Cells that
    do not fit their type become null, short rows are padded with nulls and extra
    cells are ignored (the permissive mode).

    A quote within a quoted cell is doubled, as most writers do; ``escape="\\\\"`` reads
    files that put a backslash before it. A line break within a cell ends the row unless
    ``multi_line``, which reads each file in one task.
    """
    return (
        spark.read.schema(TABLE_SCHEMAS[table])
        .options(**(CSV_OPTIONS | {"escape": escape, "multiLine": multi_line}))
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(f"{path.rstrip('/')}/{table}.csv")
    )


def read_raw_csv_table(
    spark: SparkSession, path: str, table: str, escape: str = '"', multi_line: bool = False
) -> DataFrame:
    """The same scan with every cell as the text that it is, and the lines that have too
    few or too many cells in ``_corrupt_record``: what ``rejected_cells`` looks at."""
    names = [*TABLE_SCHEMAS[table].fieldNames(), "_corrupt_record"]
    return (
        spark.read.schema(StructType([StructField(n, StringType()) for n in names]))
        .options(**(CSV_OPTIONS | {"escape": escape, "multiLine": multi_line}))
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("columnPruning", False)  # or cells that are not read are not counted
        .csv(f"{path.rstrip('/')}/{table}.csv")
    )
