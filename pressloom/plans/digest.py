"""The whole job: from an article table and a table of model attempts to published issues."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pressloom.constants import (
    ARTICLES_PER_GROUP,
    ARTICLES_PER_ISSUE,
    EXCLUDED_DOMAINS,
    KEYWORD_GROUPS,
    TITLE_SIMILARITY,
)
from pressloom.functions.text import strip, strip_or_empty
from pressloom.issue import Issue
from pressloom.lineage import cut
from pressloom.operators import report
from pressloom.operators.dedup import drop_near_duplicates_per_group
from pressloom.operators.enrich import enrich, failed_requests, requests
from pressloom.operators.ordering import newest_first, top_k_per_group, with_instant
from pressloom.operators.quality import observed, observed_by_group, valid_articles
from pressloom.operators.search import (
    assign_issues,
    exclude_domains,
    in_language,
    in_list_order,
    match_groups,
    most_relevant,
)
from pressloom.sources.responses import source_name


@dataclass(frozen=True)
class Settings:
    """What a deployment may change; the defaults are the fixed values of the job."""

    groups: Sequence[Sequence[str]] = KEYWORD_GROUPS
    excluded: Sequence[str] = EXCLUDED_DOMAINS
    lang: str = "en"
    per_group: int = ARTICLES_PER_GROUP
    per_issue: int = ARTICLES_PER_ISSUE
    similarity: float = TITLE_SIMILARITY
    strict: bool = False
    key: Sequence[str] = ("article_id",)
    date_column: str | None = None
    base_url: str = "https://example.com/digest/"
    title: str = "Weekly digest"


@dataclass(frozen=True)
class Collected:
    """Articles chosen for each issue, numbered by ``position``, and row counts on the way."""

    articles: DataFrame
    counters: dict[str, Observation] = field(default_factory=dict)

    def funnel(self) -> DataFrame:
        """The counts as a table ``(stage, n)``: found per group, found in all, valid, unique, final."""
        raw = self.counters["collected"].get
        rows = [(f"group_{name[1:]}", n) for name, n in sorted(raw.items()) if name != "n"] + [("all", raw["n"])]
        rows += [(stage, self.counters[stage].get["n"]) for stage in ("valid", "unique", "final")]
        return self.articles.sparkSession.createDataFrame(rows, "stage string, n bigint")


@dataclass(frozen=True)
class Digest:
    """Tables of the published issues, each derived from ``articles`` when asked for."""

    articles: DataFrame
    attempts: DataFrame
    settings: Settings

    @cached_property
    def header(self) -> DataFrame:
        return report.issue_header(self.articles)

    @cached_property
    def counts(self) -> DataFrame:
        return report.category_counts(self.articles)

    @cached_property
    def cards(self) -> DataFrame:
        return report.article_cards(self.articles)

    @cached_property
    def preview(self) -> DataFrame:
        return report.digest_preview(self.articles)

    @cached_property
    def notification(self) -> DataFrame:
        return report.digest_row(self.articles, self.settings.base_url, self.settings.title)

    @cached_property
    def error_rows(self) -> DataFrame:
        """Articles of the issues whose last attempt met an API error."""
        key = list(self.settings.key)
        return self.articles.select("issue_date", *key).join(failed_requests(self.attempts, key), key, "left_semi")


def collect(articles: DataFrame, issues: Sequence[Issue], settings: Settings = Settings()) -> Collected:
    """Search, clean, deduplicate, order and cap the articles of one or many issues.

    ``articles`` are raw: title, description, url, source, published_at, lang and a key that
    also breaks ties of relevance. Every step works per ``issue_date``, so issues of a whole
    year cost one pass over the articles. The cap per keyword group comes before the validity
    filter, as a search returns its hits before anyone looks at them.
    """
    searched = exclude_domains(in_language(articles, settings.lang), settings.excluded)
    searched = assign_issues(with_instant(searched).drop("assumed_utc"), issues, settings.date_column)
    matches = match_groups(searched, settings.groups)
    hits = most_relevant(matches, settings.per_group, ["issue_date"], settings.key)
    hits, seen_raw = observed_by_group(hits, "collected", len(settings.groups))

    valid = valid_articles(in_list_order(hits)).withColumns(
        {
            "title": strip(F.col("title")),
            "description": strip_or_empty(F.col("description")),
            "url": strip(F.col("url")),
            "source": source_name(F.col("source")),
        }
    )
    valid, seen_valid = observed(valid, "valid")
    valid = cut(valid)  # at most per_group rows for each issue and group: search runs once
    # An issue's list is capped at its groups times ``per_group`` rows.
    unique = drop_near_duplicates_per_group(valid, ["issue_date"], threshold=settings.similarity)
    unique, seen_unique = observed(unique, "unique")
    chosen = top_k_per_group(unique, ["issue_date"], newest_first(), settings.per_issue)
    chosen, seen_final = observed(chosen, "final")
    counters = {"collected": seen_raw, "valid": seen_valid, "unique": seen_unique, "final": seen_final}
    return Collected(cut(chosen.drop("hits", "rank", "group_idx")), counters)


def prompts(collected: Collected, settings: Settings = Settings()) -> DataFrame:
    """What to ask the model, one row per distinct article of all issues."""
    return requests(collected.articles.dropDuplicates(list(settings.key)), settings.key)


def publish(collected: Collected, attempts: DataFrame, settings: Settings = Settings()) -> Digest:
    """Only attempts on collected articles are decoded; the result is frozen because every
    report table reads it."""
    wanted = attempts.join(collected.articles.select(*settings.key).distinct(), list(settings.key), "left_semi")
    return Digest(cut(enrich(collected.articles, wanted, settings.key, settings.strict)), wanted, settings)


def weekly_digest(
    articles: DataFrame, attempts: DataFrame, issues: Sequence[Issue], settings: Settings = Settings()
) -> Digest:
    return publish(collect(articles, issues, settings), attempts, settings)
