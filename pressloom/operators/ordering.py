"""Order, top-k and positions. List order is data here: ``seq`` carries it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.constants import ARTICLES_PER_ISSUE
from pressloom.functions.text import read_time
from pressloom.lineage import cut

_SLICES = 256


def with_instant(articles: DataFrame) -> DataFrame:
    """Add ``published_ts`` (null when unreadable) and ``assumed_utc``."""
    read = articles.withColumn("_read", read_time(F.col("published_at")))
    return read.withColumns(
        {
            "published_ts": F.timestamp_micros(F.col("_read.micros")),
            "assumed_utc": F.coalesce(F.col("_read.assumed_utc"), F.lit(False)),
        }
    ).drop("_read")


def newest_first(*seq: str) -> list[Column]:
    """Newest first, unreadable times last, equal times in the order of ``seq`` columns."""
    return [F.col("published_ts").desc_nulls_last(), *(F.col(c).asc() for c in seq or ("seq",))]


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, position: str = "position"
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1.

    Every map task already reduces its rows to ``k`` per group. A group's survivors are then
    ranked in slices of tasks before the final ranking, so that the last task of a group sees
    at most ``k * 256`` rows even if the whole table belongs to it.
    """
    sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(_SLICES)))
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn(position, F.row_number().over(local))
        .filter(F.col(position) <= k)
        .drop("_slice", position)
        .withColumn(position, F.row_number().over(final).cast("bigint"))
        .filter(F.col(position) <= k)
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int = ARTICLES_PER_ISSUE, position: str = "position") -> DataFrame:
    """The first ``k`` rows of the table, numbered from 1; only those reach the numbering."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(position, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def with_position(df: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """Number all rows from 1 in ``order``, which must be total, without one task seeing them all.

    The table is range-partitioned and sorted, and frozen with its place in the partitions.
    Positions follow from the row counts of the partitions before; that table has one row per
    partition, which bounds both its window and its broadcast.
    """
    placed = cut(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(position, F.col("_offset") + inside + 1)
        .drop("_part", "_offset", "_place")
    )


def sort_newest(articles: DataFrame, seq: str = "seq") -> DataFrame:
    """Stable sort, newest first; the order is written down in ``position``."""
    return with_position(with_instant(articles), newest_first(seq))
