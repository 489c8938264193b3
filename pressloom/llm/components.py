"""Connected components of links of any number, by contraction with random priorities.

In each round every node joins the neighbour of smallest priority (or stays), and links are redrawn
between the joined nodes. Priorities are new hashes in each round, so the expected number of rounds
is logarithmic whatever the shape: stars and cliques end in one, a chain shrinks by a constant part.
Every round is a stored table, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import dropped, stored


def _priority(column: str, seed: int) -> Column:
    return F.struct(F.xxhash64(column, F.lit(seed)).alias("rank"), F.col(column).alias("node"))


def components(links: DataFrame) -> DataFrame:
    """node, component for every node in ``links`` (a long, b long); a component is one of its nodes."""
    links = stored(links.select("a", "b").filter("a != b").distinct())
    steps: list[DataFrame] = []
    while not links.isEmpty():
        seed = len(steps)
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(_priority("b", seed)).alias("least"))
        step = stored(least.select(F.col("a").alias("node"), F.least("least", _priority("a", seed))["node"].alias("to")))
        steps.append(step)
        drawn = (
            links.join(step.select(F.col("node").alias("a"), F.col("to").alias("c")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("d")), "b")
            .filter("c != d")
            .select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
            .distinct()
        )
        old, links = links, stored(drawn)
        dropped(old)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[-1].select("node", F.col("to").alias("component"))
    for step in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("to"), "component")
        found = step.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    result = stored(found)
    for step in steps:
        dropped(step)
    return result
