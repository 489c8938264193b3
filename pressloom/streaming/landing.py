"""Search responses as they land: the same source, filter and projection on a stream.

All of it is stateless per record, so it needs no watermark. Duplicates are not removed here,
because which of them survives depends on the whole list of an issue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressloom.functions.text import parse_instant, utc_date
from pressloom.operators.quality import valid_articles
from pressloom.sources.responses import parse_responses, project_articles, raw_articles, rejected_responses


def stream_articles(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Valid articles from new response files (JSON lines) under ``path``."""
    responses = _landed(spark, path, files_per_trigger)
    articles = project_articles(valid_articles(raw_articles(responses)))
    return articles.withColumn("published_date", utc_date(parse_instant(F.col("published_at"))))


def stream_rejected(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The responses among them that report an error or could not be read, wholly or in part."""
    return rejected_responses(_landed(spark, path, files_per_trigger))


def _landed(spark: SparkSession, path: str, files_per_trigger: int) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return parse_responses(lines.filter("trim(value) <> ''"), "value")


def store_articles(articles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to an article table partitioned by UTC date, which the date window then prunes.

    Processes what has landed and stops; schedule it or keep calling it.
    """
    return (
        articles.writeStream.format("parquet")
        .partitionBy("published_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
