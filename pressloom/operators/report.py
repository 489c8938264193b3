"""Tables of a published issue. All are grouped by ``issue_date``; an issue without articles
does not exist. Input are enriched articles with ``position`` inside their issue.

Tables of counts and first titles are made in two steps: a state per issue, of fixed size, and the table
from the states. States can be stored (``sources.states``); the tables then need no articles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.constants import CATEGORIES, CATEGORY_SEPARATOR, ISSUE_PREFIX, PREVIEW_TITLES, SEARCH_DAYS
from pressloom.functions.text import japanese_date, published_label, report_date
from pressloom.operators.enrich import category_label
from pressloom.operators.ordering import with_position


def issue_key(as_of: Column) -> Column:
    """Date that names the issue of a run at ``as_of``."""
    return report_date(as_of)


def issue_name(issue_date: Column) -> Column:
    return F.concat(F.lit(ISSUE_PREFIX), F.date_format(issue_date, "yyyy-MM-dd"))


def _per_category() -> list[Column]:
    """One counter per category: a fixed, short list, so one hash aggregate does them all."""
    return [F.count_if(F.col("category") == key).alias(f"n_{key}") for key, _ in CATEGORIES]


def issue_states(articles: DataFrame) -> DataFrame:
    """One row per issue: its number of articles, one counter per category, its first titles.

    What a table does not read of a state is pruned from the aggregate.
    """
    first = F.when(F.col("position") <= PREVIEW_TITLES, F.struct("position", "title_ja"))
    return articles.groupBy("issue_date").agg(
        F.count(F.lit(1)).alias("total_articles"), *_per_category(), F.array_sort(F.collect_list(first)).alias("first_titles")
    )


def category_counts(articles: DataFrame) -> DataFrame:
    """Every category of every issue in report order, zeros included. A category outside the
    list is counted nowhere."""
    return counts_of(issue_states(articles))


def counts_of(states: DataFrame) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("cat_ord"),
                F.lit(key).alias("category"),
                F.lit(label).alias("label"),
                F.col(f"n_{key}").alias("n"),
            )
            for i, (key, label) in enumerate(CATEGORIES)
        ]
    )
    return states.select("issue_date", F.inline(rows))


def category_badges(articles: DataFrame) -> DataFrame:
    return category_counts(articles).filter(F.col("n") > 0)


def article_cards(articles: DataFrame) -> DataFrame:
    return articles.select(
        "issue_date",
        "position",
        "category",
        category_label(F.col("category")).alias("label"),
        "title_ja",
        "summary_ja",
        "source",
        published_label(F.col("published_at")).alias("published_label"),
        "url",
    )


def issue_header(articles: DataFrame) -> DataFrame:
    return header_of(issue_states(articles))


def header_of(states: DataFrame) -> DataFrame:
    end = F.col("issue_date")
    return states.select(
        "issue_date",
        japanese_date(end).alias("issue_label"),
        F.date_format(F.date_sub(end, SEARCH_DAYS), "yyyy/MM/dd").alias("period_start"),
        F.date_format(end, "yyyy/MM/dd").alias("period_end"),
        F.year(end).cast("bigint").alias("year"),
        "total_articles",
    )


def archive_index(issue_names: DataFrame, name: str = "name") -> DataFrame:
    """Known issues, newest file name first (``rank``), with the date as shown in the archive.

    A name that holds no date shows what follows the prefix.
    """
    rest = F.replace(F.col(name), F.lit(ISSUE_PREFIX), F.lit(""))
    well_formed = rest.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    day = F.when(well_formed, F.try_to_date(rest, "yyyy-M-d"))
    shown = F.coalesce(F.date_format(day, "yyyy年MM月dd日号"), rest)
    named = (
        issue_names.filter(F.startswith(F.col(name), F.lit(ISSUE_PREFIX)))
        .select(F.col(name).alias("name"))
        .distinct()
        .select("name", F.concat("name", F.lit(".html")).alias("file_name"), shown.alias("display_date"))
    )
    return with_position(named, [F.col("file_name").desc()], "rank").orderBy("rank")


def _category_text() -> Column:
    parts = [
        F.when(F.col(f"n_{key}") > 0, F.concat(F.lit(f"{label}: "), F.col(f"n_{key}").cast("string"), F.lit("件")))
        for key, label in CATEGORIES
    ]
    return F.concat_ws(CATEGORY_SEPARATOR, *parts)


def digest_category_text(articles: DataFrame) -> DataFrame:
    """Non-zero categories of an issue in one line of text, empty if there are none."""
    return category_text_of(issue_states(articles))


def category_text_of(states: DataFrame) -> DataFrame:
    return states.select("issue_date", _category_text().alias("categories"))


def digest_preview(articles: DataFrame) -> DataFrame:
    """First titles of an issue, and how many articles come after them."""
    return preview_of(issue_states(articles))


def preview_of(states: DataFrame) -> DataFrame:
    remaining = F.greatest(F.col("total_articles") - PREVIEW_TITLES, F.lit(0)).alias("remaining")
    rows = states.select("issue_date", remaining, F.explode("first_titles").alias("row"))
    return rows.select("issue_date", F.col("row.position").alias("position"), F.col("row.title_ja").alias("title_ja"), "remaining")


def digest_row(articles: DataFrame, base_url: str, title: str) -> DataFrame:
    """Subject line, link and numbers of the notification for an issue."""
    return notification_of(issue_states(articles), base_url, title)


def notification_of(states: DataFrame, base_url: str, title: str) -> DataFrame:
    link = F.concat(F.rtrim(F.lit(base_url), F.lit("/")), F.lit("/"), issue_name(F.col("issue_date")), F.lit(".html"))
    subject = F.concat(
        F.lit(f"{title} "),
        japanese_date(F.col("issue_date")),
        F.lit("号 — "),
        F.col("total_articles").cast("string"),
        F.lit("件の記事"),
    )
    return states.select(
        "issue_date",
        subject.alias("subject"),
        link.alias("report_url"),
        "total_articles",
        _category_text().alias("categories"),
    )
