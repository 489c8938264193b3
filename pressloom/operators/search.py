"""Search predicates over an article table.

Which records a remote search returns for a keyword, how it scores them, and whether its end
date is inclusive is not knowable. Chosen here: a phrase matches when it occurs in the title
or the description, without regard to case; the score is the number of occurrences; both
window dates are included whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.constants import ARTICLES_PER_GROUP, EXCLUDED_DOMAINS, KEYWORD_GROUPS
from pressloom.functions.phrases import phrase_counter
from pressloom.functions.text import host_of, in_domains, occurrences, parse_instant, utc_date
from pressloom.issue import Issue
from pressloom.lineage import cut
from pressloom.operators.ordering import newest_first, top_k_per_group

#: Ranks inside a group stay below this, so ``group_idx * GROUP_STRIDE + rank`` keeps the order.
GROUP_STRIDE = 1 << 32


#: Up to so many phrases become expressions, each of which reads the text again.
EXPRESSIONS = 64
#: Characters of the phrases of one automaton; longer lists are matched by several.
AUTOMATON_CHARS = 8_000_000
#: Domains of one depth up to this number are broadcast.
DOMAIN_ROWS = 2_000_000


def match_groups(
    articles: DataFrame, groups: Sequence[Sequence[str]] = KEYWORD_GROUPS, expressions: int = EXPRESSIONS
) -> DataFrame:
    """One row per article and keyword group it matches, with ``group_idx`` and ``hits``.

    A short list becomes expressions over the row; a longer one an automaton that finds all phrases in one
    pass of each text. In both cases there is no join and no shuffle, and an article without a match
    never leaves its task.
    """
    if sum(map(len, groups)) > expressions:
        return _matched_by_automata(articles, groups)
    # Lower-cased once here; the optimizer keeps the projection because it is used often.
    lowered = articles.withColumn("_title", F.lower(F.coalesce("title", F.lit("")))).withColumn(
        "_text", F.lower(F.coalesce("description", F.lit("")))
    )

    def hits(phrases: Sequence[str]) -> Column:
        total = F.lit(0).cast("bigint")
        for phrase in phrases:
            total = total + occurrences(F.col("_title"), phrase.lower()) + occurrences(F.col("_text"), phrase.lower())
        return total

    per_group = F.array(
        *[F.struct(F.lit(g).alias("group_idx"), hits(p).alias("hits")) for g, p in enumerate(groups)]
    )
    return (
        lowered.select(*articles.columns, F.explode(per_group).alias("_match"))
        .filter(F.col("_match.hits") > 0)
        .select(*articles.columns, "_match.group_idx", "_match.hits")
    )


def _matched_by_automata(articles: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    sc, parts, size = articles.sparkSession.sparkContext, [[]], 0
    for g, phrases in enumerate(groups):  # whole groups, so that hits of a group are added up in one place
        size += sum(map(len, phrases))
        if size > AUTOMATON_CHARS and parts[-1]:
            parts, size = [*parts, []], sum(map(len, phrases))
        parts[-1].append((g, [p.lower() for p in phrases]))
    lowered = articles.withColumns({"_title": F.lower(F.coalesce("title", F.lit(""))), "_text": F.lower(F.coalesce("description", F.lit("")))})
    found = [phrase_counter(sc.broadcast(part))("_title", "_text") for part in parts]
    return (
        lowered.withColumn("_match", F.explode(F.concat(*found)))
        .select(*articles.columns, "_match.group_idx", "_match.hits")
    )


def _published_date(date_column: str | None) -> Column:
    return F.col(date_column) if date_column else utc_date(parse_instant(F.col("published_at")))


def date_window(articles: DataFrame, issue: Issue, date_column: str | None = None) -> DataFrame:
    """Articles published inside the search window of ``issue``.

    Give ``date_column`` when the table stores the UTC date, best as its partition column:
    the filter then prunes folders and row groups instead of parsing every text.
    """
    return articles.filter(
        _published_date(date_column).between(F.lit(issue.window_start), F.lit(issue.window_end))
    )


def assign_issues(articles: DataFrame, issues: Sequence[Issue], date_column: str | None = None) -> DataFrame:
    """One row per article and issue whose window holds it, with ``issue_date``.

    Lets one plan build many issues. Windows of neighbouring issues may overlap. The windows
    become a calendar of ``(day, issue_date)``, a handful of rows per issue that was asked for,
    so it is broadcast; a ``published_ts`` that is there is not read again, and the outer dates of all windows still prune the scan.
    """
    days = {(i.window_start + timedelta(n), i.issue_date) for i in issues for n in range(i.days + 1)}
    calendar = articles.sparkSession.createDataFrame(sorted(days), "_day date, issue_date date")
    timed = "published_ts" in articles.columns and not date_column
    day = utc_date(F.col("published_ts")) if timed else _published_date(date_column)
    first, last = min(i.window_start for i in issues), max(i.window_end for i in issues)
    return (
        articles.withColumn("_day", day)
        .filter(F.col("_day").between(F.lit(first), F.lit(last)))
        .join(F.broadcast(calendar), "_day")
        .drop("_day")
    )


def in_language(articles: DataFrame, lang: str = "en") -> DataFrame:
    return articles.filter(F.col("lang") == lang)


def exclude_domains(articles: DataFrame, domains: Sequence[str] = EXCLUDED_DOMAINS) -> DataFrame:
    """Drop articles on the given hosts or below them; a URL without a host stays."""
    return articles.filter(~in_domains(host_of(F.coalesce("url", F.lit(""))), domains))


def exclude_listed(articles: DataFrame, domains: DataFrame, column: str = "domain", most: int = DOMAIN_ROWS) -> DataFrame:
    """:func:`exclude_domains` for a list of any length, given as a table.

    A host lies on or below a domain of n labels if its last n labels are that domain. So the list is
    split by its number of labels, of which there are few, and each part takes out its rows by an
    anti-join: with a broadcast of the part, so that articles are never shuffled, or, beyond ``most``
    domains, on the keys.
    """
    names = domains.select(F.lower(column).alias("_domain")).filter("_domain != ''").distinct()
    names = cut(names.withColumn("_labels", F.size(F.split("_domain", r"\."))))
    rows = articles.withColumn("_host", host_of(F.coalesce("url", F.lit(""))))
    for labels, n in sorted((r["_labels"], r["count"]) for r in names.groupBy("_labels").count().collect()):
        part = names.filter(F.col("_labels") == labels).select("_domain")
        part = F.broadcast(part) if n <= most else part
        rows = rows.join(part, F.substring_index("_host", ".", -labels) == F.col("_domain"), "left_anti")
    return rows.select(*articles.columns)


def most_relevant(
    matches: DataFrame, k: int = ARTICLES_PER_GROUP, scope: Sequence[str] = (), seq: Sequence[str] = ("seq",)
) -> DataFrame:
    """At most ``k`` articles per keyword group (and scope): most hits, then newest, then ``seq``.

    Needs ``published_ts``. Adds ``rank``.
    """
    return top_k_per_group(
        matches, [*scope, "group_idx"], [F.col("hits").desc(), *newest_first(*seq)], k, position="rank"
    )


def in_list_order(ranked: DataFrame, position: str = "rank", seq: str = "seq") -> DataFrame:
    """Bag union of the groups: group order, then order inside the group, written to ``seq``.

    An article found by several groups stays as often as it was found. The number is composed
    instead of counted, so the union needs no global sort.
    """
    return ranked.withColumn(seq, F.col("group_idx").cast("bigint") * F.lit(GROUP_STRIDE) + F.col(position))
