"""Vectors as integers: what the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers are components times this, rounded down.
SCALE = 256
#: Integers beyond this are held there, so that squared distances of 127 dimensions fit into a long.
MOST = 1 << 27


def _integer(x: Column) -> Column:
    held = F.least(F.greatest(x.cast("double") * SCALE, F.lit(float(-MOST))), F.lit(float(MOST)))
    return F.floor(held).cast("int")


def integers(table: DataFrame, key: str, column: str, *others: str) -> DataFrame:
    """key, v (array of int) and ``others`` of the rows whose vector is finite throughout."""
    finite = F.forall(column, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return table.filter(finite).select(F.col(key).cast("long").alias(key), F.transform(column, _integer).alias("v"), *others)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array of lists of one length, without nulls, as 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an array of lists."""
    ends = np.arange(len(rows) + 1) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel()))


def sums(owner: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the rows of each owner; exact up to 2**53, for batches of integers up to ``MOST``."""
    return np.stack([np.bincount(owner, c, groups) for c in rows.T.astype(float)], 1).astype(np.int64)


def floor_means(totals: list[int], count: int) -> list[int]:
    return [t // count for t in totals]
