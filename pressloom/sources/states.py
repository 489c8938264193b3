"""States of the issues in an archive, kept up to date without reading the archive again.

Beside the archive lies a table of states, ``report.issue_states`` of each issue with the version of the
issue it was made from. A version is known from the listing alone: names, sizes and times of the issue's
files. An update makes the states of new and rewritten issues and appends them; states of versions that
are no longer there stay in the table and are passed over, so a reader never meets a half-made update.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.operators.report import issue_states
from pressloom.sources.archive import read_archive

_VERSION = ("issue_date", "n_files", "version")


def issue_versions(spark: SparkSession, path: str) -> DataFrame:
    """issue_date, n_files and version of the issues in the archive; only folders are listed, no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    if "issue_date" not in files.columns:  # an archive without issues
        return spark.createDataFrame([], "issue_date date, n_files bigint, version bigint")
    name = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    return files.groupBy(F.col("issue_date").cast("date").alias("issue_date")).agg(
        F.count(F.lit(1)).alias("n_files"), F.bit_xor(name).alias("version")
    )


def _same_version(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    on = [a[c].eqNullSafe(b[c]) for c in _VERSION]
    return a.join(b, on, how)


def _known(spark: SparkSession, states: str) -> DataFrame | None:
    try:
        return spark.read.parquet(states)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update_states(spark: SparkSession, path: str, states: str) -> int:
    """Make the states that the table at ``states`` lacks; how many those were.

    Only the folders of new and rewritten issues are read. Their dates, one for a day of the calendar at
    most, go through the driver to become a filter on folders.
    """
    present, known = issue_versions(spark, path), _known(spark, states)
    stale = present if known is None else _same_version(present, known.select(*_VERSION), "left_anti")
    days = [r.issue_date for r in stale.select("issue_date").collect()]
    if not days:
        return 0
    day = F.col("issue_date")
    read = read_archive(spark, path).filter(day.isin([d for d in days if d]) | (day.isNull() if None in days else F.lit(False)))
    made = issue_states(read)
    # The listing from before the read: an issue rewritten meanwhile counts as stale at the next update.
    versioned = made.join(F.broadcast(stale.withColumnRenamed("issue_date", "day")), day.eqNullSafe(F.col("day"))).drop("day")
    versioned.write.mode("append").parquet(states)
    return len(days)


def read_states(spark: SparkSession, path: str, states: str) -> DataFrame:
    """The states of all issues that the archive holds now, for the ``*_of`` tables of ``operators.report``.

    An issue without a state of its present version is missing; ``update_states`` comes first.
    """
    known = _known(spark, states)
    if known is None:
        return issue_states(read_archive(spark, path).filter("false"))
    present = _same_version(known, issue_versions(spark, path), "left_semi")
    return present.dropDuplicates(["issue_date"]).drop("n_files", "version")
