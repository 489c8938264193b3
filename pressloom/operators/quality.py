"""Validity of raw records, and row counts along the way."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pressloom.constants import REMOVED_MARKER
from pressloom.functions.text import strip_or_empty


def is_valid(title: Column, description: Column, url: Column) -> Column:
    """Title and URL are not blank, and neither title nor description is the removed marker.

    An absent description is fine.
    """
    plain_title, plain_description = strip_or_empty(title), strip_or_empty(description)
    return (
        (plain_title != "")
        & (strip_or_empty(url) != "")
        & (F.lower(plain_title) != REMOVED_MARKER)
        & (F.lower(plain_description) != REMOVED_MARKER)
    )


def valid_articles(raw: DataFrame) -> DataFrame:
    return raw.filter(is_valid(F.col("title"), F.col("description"), F.col("url")))


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point, as a by-product of whatever action runs the plan."""
    watch = Observation(stage)
    return df.observe(watch, F.count(F.lit(1)).alias("n")), watch


def observed_by_group(df: DataFrame, stage: str, groups: int, group: str = "group_idx") -> tuple[DataFrame, Observation]:
    """The same with a count ``g<i>`` for each of the numbered groups."""
    watch = Observation(stage)
    counts = [F.count_if(F.col(group) == i).alias(f"g{i}") for i in range(groups)]
    return df.observe(watch, F.count(F.lit(1)).alias("n"), *counts), watch


def funnel_counts(flagged: DataFrame, group: str, stages: Mapping[str, Column]) -> DataFrame:
    """Rows per stage as a table ``(stage, n)``, from one pass over flagged rows.

    ``stages`` maps a stage name to the condition for having reached it. Each value of
    ``group`` also gets its own ``group_<value>`` row with the raw number of rows.
    """
    counts = [F.count_if(reached).alias(name) for name, reached in stages.items()]
    per_group = flagged.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *counts)
    listed = F.array(
        F.struct(F.concat(F.lit("group_"), F.col(group).cast("string")).alias("stage"), F.col("rows").alias("n")),
        *[F.struct(F.lit(name).alias("stage"), F.col(name).alias("n")) for name in stages],
    )
    return per_group.select(F.inline(listed)).groupBy("stage").agg(F.sum("n").alias("n"))
