"""The physical order of rows, which is part of what a table says.

A position is a column of its own, POSITION: an array of texts that sort like the rows stand.  Rows read from files have the file's
folder, part number and name, where Spark's piece of the file begins in it, and their place in the piece (Parquet: the row's number in the file), so it does not matter how pieces are
packed into tasks.  Whatever keeps rows keeps the column.  A table without it stands in the order in which Spark delivers its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITION = "__pos"
#: The part (a file's name) of a table that is kept part by part.
PART = "__part"
#: The number of a scan's point, from 0.
POINT = "__point"


def digits(number: Column) -> Column:
    """A whole number that is not negative as text that sorts like it."""
    return F.lpad(F.hex(number), 16, "0")


def from_files(df: DataFrame, row_index: bool = False) -> DataFrame:
    """df, just read from files, with the position of each row; row_index where the format has one."""
    if POSITION in df.columns:
        return df
    m = F.col("_metadata")
    place = [digits(m["row_index"])] if row_index else [digits(m["file_block_start"]), digits(F.monotonically_increasing_id())]
    # parts count up in their names, with five digits or more
    file = [F.regexp_replace(m["file_path"], "[^/]*$", ""), F.lpad(F.regexp_extract(m["file_name"], r"^part-(\d+)", 1), 12, "0"), m["file_name"]]
    return df.select("*", F.array(*file, *place).alias(POSITION))


def positioned(df: DataFrame) -> DataFrame:
    """df with positions: its own, or those in which Spark delivers its rows."""
    return df if POSITION in df.columns else df.withColumn(POSITION, F.array(digits(F.monotonically_increasing_id())))


def behind(df: DataFrame, port: int) -> DataFrame:
    """df with positions that come after those of all lower ports."""
    return positioned(df).withColumn(POSITION, F.concat(F.array(F.lit(f"{port:08d}")), F.col(POSITION)))


def numbered(df: DataFrame, number: str) -> DataFrame:
    """df with a column of whole numbers as the rows' positions."""
    return df.withColumn(POSITION, F.array(digits(F.col(number))))


def plain(df: DataFrame) -> DataFrame:
    """df as its user sees it."""
    return df.drop(POSITION, PART)


def in_order(df: DataFrame) -> DataFrame:
    """df's rows, sorted over all partitions by their positions, without them."""
    return plain(df.orderBy(POSITION)) if POSITION in df.columns else df
