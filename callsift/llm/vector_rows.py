"""Rows of vectors made ready for searches: which take part, numbers, cells of tasks.

A search compares query rows with all rows in cells of a grid: rows are dealt to tiles
and queries to groups by a hash of a row number, which no content can make uneven, and
every group meets every tile that it needs. Both kinds of rows of a cell are bounded, so
a task holds a bounded number of vectors whatever the size of the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """All components are there and are finite numbers."""

    def fine(x: Column) -> Column:
        x = x.cast("double")
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return F.coalesce(F.forall(vector, fine), F.lit(False)) & (F.size(vector) > 0)


def dimension(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have; of equally frequent ones the larger; 0 without rows."""
    sizes = rows.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return sizes["size"] if sizes else 0


def parts(count: int, most: int) -> int:
    """How many tiles or groups of about ``most`` rows."""
    return max(1, -(-count // most))


def dealt(number: str, among: int, salt: int = 0) -> Column:
    """A tile or group by the hash of a row number."""
    return F.pmod(F.xxhash64(number, F.lit(salt)), F.lit(among)).cast("int")


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def best(found: DataFrame, by: list[str], order: list[Column], most: int, rank: str) -> DataFrame:
    """The first rows of each group, numbered from 1."""
    window = Window.partitionBy(*by).orderBy(*order)
    return found.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= most)
