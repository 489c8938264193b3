"""A zone map of stored article files: which files a date window can be in.

For tables that hold publication times as text only, in no order by date. Per file, the map has the
first and the last UTC date of its articles; it is a small table beside the articles. A window reads the
files whose zone meets it, and files that the map does not know yet. Articles without a readable time
are in no window, so a file of only those is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.text import parse_instant, utc_date
from pressloom.issue import Issue
from pressloom.operators.search import date_window

_ZONES = "file string, first date, last date"


def _known(spark: SparkSession, zones: str) -> DataFrame:
    try:
        return spark.read.schema(_ZONES).parquet(zones)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ZONES)


def _unmapped(spark: SparkSession, path: str, known: DataFrame) -> list[str]:
    """Files that are not in the map; Spark lists the files of a table on the driver in any case."""
    files = spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")
    return [r.file for r in files.join(known, "file", "left_anti").collect()]


def update_zones(spark: SparkSession, path: str, zones: str) -> int:
    """Add the files of the Parquet table ``path`` that the map at ``zones`` lacks; how many those were.

    To be called by the job that lands files. Only the new files are read, and only their times.
    """
    new = _unmapped(spark, path, _known(spark, zones))
    if new:
        day = utc_date(parse_instant(F.col("published_at")))
        rows = spark.read.parquet(*new).select(F.input_file_name().alias("file"), day.alias("day"))
        per_file = rows.groupBy("file").agg(F.min("day").alias("first"), F.max("day").alias("last"))
        per_file.coalesce(1).write.mode("append").parquet(zones)  # one row per file
    return len(new)


def files_in_windows(spark: SparkSession, path: str, zones: str, issues: Sequence[Issue]) -> list[str]:
    """Files that may hold articles of a window of ``issues``."""
    known = _known(spark, zones)
    meets = F.lit(False)
    for issue in issues:
        meets = meets | ((F.col("first") <= F.lit(issue.window_end)) & (F.col("last") >= F.lit(issue.window_start)))
    present = set(spark.read.parquet(path).inputFiles())  # files that are gone may still be in the map
    return [r.file for r in known.filter(meets).select("file").collect() if r.file in present] + _unmapped(spark, path, known)


def read_window(spark: SparkSession, path: str, zones: str, issue: Issue) -> DataFrame:
    """Articles of the table published inside the search window of ``issue``."""
    files = files_in_windows(spark, path, zones, [issue])
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return date_window(rows, issue)
