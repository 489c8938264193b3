"""Requests to and answers from the model that translates, summarises and classifies.

The calls themselves happen elsewhere. They read :func:`requests` and land their attempts as a
table ``(key, attempt, outcome, text)``; :func:`enrich` turns those into finished articles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.constants import CATEGORIES, DEFAULT_CATEGORY, MAX_ATTEMPTS, SUMMARY_FAILED, SUMMARY_MISSING
from pressloom.functions.replies import parse_reply
from pressloom.functions.text import strip_fence


def request_text(title: Column, source: Column, description: Column, url: Column) -> Column:
    """The prompt for one article; the description line is left out when it is empty."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Title: "), title),
        F.concat(F.lit("Source: "), source),
        F.when(description != "", F.concat(F.lit("Description: "), description)),
        F.concat(F.lit("URL: "), url),
    )


def requests(articles: DataFrame, key: Sequence[str] = ("seq",)) -> DataFrame:
    prompt = request_text(F.col("title"), F.col("source"), F.col("description"), F.col("url"))
    return articles.select(*key, prompt.alias("prompt"))


def normalize_category(category: Column) -> Column:
    """Unknown, differently spelt or null categories become the default one."""
    return F.when(category.isin([k for k, _ in CATEGORIES]), category).otherwise(F.lit(DEFAULT_CATEGORY))


def category_label(category: Column) -> Column:
    label = F.lit(dict(CATEGORIES)[DEFAULT_CATEGORY])
    for key, text in CATEGORIES:
        label = F.when(category == key, F.lit(text)).otherwise(label)
    return label


def parse_attempts(attempts: DataFrame) -> DataFrame:
    """Add the decoded ``reply``; only texts of attempts that went through are decoded."""
    text = F.when(F.col("outcome") == "ok", strip_fence(F.col("text")))
    return attempts.filter(F.col("attempt").between(1, MAX_ATTEMPTS)).withColumn("reply", parse_reply(text))


def pick_attempt(attempts: DataFrame, key: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per key: the first readable attempt (``reply``, null if there is none), its
    number, and whether the job gave up because the last attempt met an API error.

    A key has at most three attempts, so the aggregate stays small for every key.
    """
    usable = F.col("reply.ok")
    last_failed = (F.col("attempt") == MAX_ATTEMPTS) & (F.col("outcome") == "api_error")
    return (
        parse_attempts(attempts)
        .groupBy(*key)
        .agg(
            F.min(F.when(usable, F.struct("attempt", "reply"))).alias("best"),
            F.max(last_failed).alias("_last_failed"),
        )
        .select(
            *key,
            F.col("best.attempt").alias("attempt"),
            F.col("best.reply").alias("reply"),
            (F.col("best").isNull() & F.col("_last_failed")).alias("aborted"),
        )
    )


def failed_requests(attempts: DataFrame, key: Sequence[str] = ("seq",)) -> DataFrame:
    """Keys whose last attempt met an API error and that have no readable attempt."""
    return pick_attempt(attempts, key).filter("aborted").select(*key)


def enrich(
    articles: DataFrame, attempts: DataFrame, key: Sequence[str] = ("seq",), strict: bool = False
) -> DataFrame:
    """One row per article with ``title_ja``, ``summary_ja`` and ``category`` filled in.

    A readable reply with a missing key takes the default of that key; an article without a
    readable reply falls back to its own title and description. ``strict`` makes the job fail
    on a key that :func:`failed_requests` would list.
    """
    picked = pick_attempt(attempts, key).drop("attempt")
    if strict:
        message = F.lit("the last attempt of an article met an API error")
        picked = picked.filter(F.when(F.col("aborted"), F.raise_error(message).cast("boolean")).otherwise(True))
    joined = articles.drop("title_ja", "summary_ja", "category").join(picked, list(key), "left")
    answered, description = F.col("reply").isNotNull(), F.nullif(F.col("description"), F.lit(""))

    def filled(field: str, missing: Column, failed: Column) -> Column:
        present = F.when(F.col(f"reply.has_{field}"), F.col(f"reply.{field}")).otherwise(missing)
        return F.when(answered, present).otherwise(failed).alias(field)

    return joined.select(
        *[c for c in articles.columns if c not in ("title_ja", "summary_ja", "category")],
        filled("title_ja", F.col("title"), F.col("title")),
        filled(
            "summary_ja",
            F.coalesce(description, F.lit(SUMMARY_MISSING)),
            F.coalesce(description, F.lit(SUMMARY_FAILED)),
        ),
        normalize_category(F.col("reply.category")).alias("category"),
    )
