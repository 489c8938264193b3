"""Landed search responses: envelopes of raw articles, read from JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.constants import UNKNOWN_SOURCE
from pressloom.functions.text import strip, strip_or_empty
from pressloom.schemas import RESPONSE


def read_responses(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per response: per line, or per file with ``multi_line``.

    The schema is fixed, so nothing is inferred; a text that is not JSON, or not of this schema, ends
    up in ``_corrupt`` instead of failing the read. Texts are parsed whole whatever columns are asked
    for, since a file reader that prunes columns does not see what is wrong with the others.
    """
    return parse_responses(spark.read.text(path, wholetext=multi_line).filter("trim(value) <> ''"), "value")


def parse_responses(bodies: DataFrame, body: str = "body") -> DataFrame:
    """The same rows from a table that keeps response bodies as text."""
    parsed = F.from_json(
        F.col(body), RESPONSE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    return bodies.select(parsed.alias("r")).select("r.*")


def _accepted() -> Column:
    return F.coalesce(F.col("status") == "ok", F.lit(False))


def raw_articles(responses: DataFrame) -> DataFrame:
    """Raw records of accepted responses, with their place in the response.

    A response whose status is not ``ok`` or that has no article list gives no rows. ``unreadable``
    marks records of a response of which some part did not fit the schema and was nulled.
    """
    return (
        responses.filter(_accepted())
        .select("group_idx", "_corrupt", F.posexplode("articles").alias("pos", "raw"))
        .select(
            "group_idx",
            F.col("pos").cast("bigint").alias("pos"),
            F.col("raw.title").alias("title"),
            F.col("raw.description").alias("description"),
            F.col("raw.url").alias("url"),
            F.col("raw.source.name").alias("source_name"),
            F.col("raw.publishedAt").alias("published_at"),
            F.col("raw.urlToImage").alias("image_url"),
            F.col("_corrupt").isNotNull().alias("unreadable"),
        )
    )


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses that report an error, and those of which all or some could not be read."""
    return responses.filter(~_accepted() | F.col("_corrupt").isNotNull()).select(
        "group_idx", "status", "code", "message", F.col("_corrupt").isNotNull().alias("unreadable")
    )


def source_name(name: Column) -> Column:
    """A missing or empty source becomes ``Unknown``; a blank one becomes empty."""
    return strip(F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN_SOURCE)))


def project_articles(raw: DataFrame) -> DataFrame:
    """Raw records to article columns; run the validity filter first, it looks at raw values.

    Other columns of ``raw`` pass through.
    """
    kept = [c for c in raw.columns if c not in ("title", "description", "url", "source_name", "published_at")]
    return raw.select(
        *[c for c in kept if c != "image_url"],
        strip(F.col("title")).alias("title"),
        strip_or_empty(F.col("description")).alias("description"),
        strip(F.col("url")).alias("url"),
        source_name(F.col("source_name")).alias("source"),
        F.coalesce(F.col("published_at"), F.lit("")).alias("published_at"),
        *[c for c in kept if c == "image_url"],
    )
