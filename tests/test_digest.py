"""The whole job against the same job written as a plain loop over rows."""

import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from models import enriched, survivors

from pressloom.issue import Issue
from pressloom.plans import catalog
from pressloom.plans import tables as src
from pressloom.plans.digest import Settings, collect, prompts, publish

SF_DIR = "/root/testdata/sf0.01"
ISSUES = [Issue(datetime(2024, 1, day, 22, 0)) for day in (6, 13, 20)]
SETTINGS = Settings(groups=src.GROUPS, excluded=src.DOMAINS, per_issue=7, base_url="https://example.org/", title="News")


def text(value):
    return (value or "").strip()


def plain_digest(raw, attempts, issues=ISSUES, settings=SETTINGS, per_group=None):
    """{issue_date: [(position, article_id, title, source, title_ja, summary_ja, category)]}, counters"""
    out, counters = {}, dict.fromkeys(("collected", "valid", "unique", "final"), 0)
    for issue in issues:
        hits = []
        for g, phrases in enumerate(settings.groups):
            found = []
            for r in raw:
                host = re.match(r"\w+://([^/?#:]+)", text(r.url))
                host = host.group(1).lower() if host else ""
                when = r.published_at and datetime.fromisoformat(r.published_at.replace("Z", "+00:00"))
                if r.lang != "en" or not when or not issue.window_start <= when.date() <= issue.window_end:
                    continue
                if any(host == d or host.endswith("." + d) for d in settings.excluded):
                    continue
                score = sum((s or "").lower().count(p) for p in phrases for s in (r.title, r.description))
                if score:
                    found.append((-score, -when.timestamp(), r.article_id, r))
            hits += [(g, rank, f[3]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[: settings.per_group])]
        if per_group is not None:
            per_group.update(g for g, _, _ in hits)
        valid = [h for h in hits if text(h[2].title) and text(h[2].url)]
        valid = [h for h in valid if "[removed]" not in (text(h[2].title).lower(), text(h[2].description).lower())]
        kept = survivors([(n, text(h[2].title), text(h[2].url)) for n, h in enumerate(valid)])
        rows = sorted((valid[n][2] for n in kept), key=lambda r: r.published_at, reverse=True)
        chosen = rows[: settings.per_issue]
        for name, rows_ in zip(counters, (hits, valid, kept, chosen)):
            counters[name] += len(rows_)
        out[issue.issue_date] = [
            (i + 1, r.article_id, text(r.title), (r.source or "Unknown").strip(), *enriched(text(r.title), text(r.description), attempts[r.article_id]))
            for i, r in enumerate(chosen)
        ]
    return out, counters


@pytest.fixture(scope="module")
def inputs(spark):
    raw = src.raw_articles(spark, SF_DIR).withColumnsRenamed({"seq": "article_id", "source_name": "source"})
    # The same articles again a little later, so that groups, titles and URLs collide more.
    copies = raw.selectExpr("article_id + 1000 as article_id", "title || '!' as title", "* except (article_id, title)")
    return raw.unionByName(copies), src.attempts(spark, SF_DIR).withColumnRenamed("seq", "article_id")


def test_digest_equals_the_plain_loop(spark, inputs):
    raw, attempts = inputs
    tries = defaultdict(dict)
    for a in attempts.collect():
        tries[a.article_id][a.attempt] = (a.outcome, a.text)
    want, counters = plain_digest(raw.collect(), tries)

    collected = collect(raw.repartition(3), ISSUES, SETTINGS)
    digest = publish(collected, attempts, SETTINGS)
    got = defaultdict(list)
    for r in digest.articles.orderBy("issue_date", "position").collect():
        got[r.issue_date].append((r.position, r.article_id, r.title, r.source, r.title_ja, r.summary_ja, r.category))
    assert sum(map(len, want.values())) > 8
    assert dict(got) == {day: rows for day, rows in want.items() if rows}
    assert {name: watch.get["n"] for name, watch in collected.counters.items()} == counters

    days = [day for day, rows in want.items() if rows]
    assert sorted(r.issue_date for r in digest.header.collect()) == days
    assert digest.counts.count() == 7 * len(days)
    assert digest.cards.count() == digest.articles.count()
    assert {r.total_articles for r in digest.notification.collect()} == {len(want[d]) for d in days}
    assert digest.preview.count() == sum(min(5, len(want[d])) for d in days)
    assert digest.error_rows.count() == sum(1 for d in days for r in want[d] if tries[r[1]].get(3, ("",))[0] == "api_error")
    ids = {r[1] for rows in want.values() for r in rows}
    assert {r.article_id for r in prompts(collected, SETTINGS).collect()} == ids


def test_queries_of_the_digest_equal_the_plain_loop(spark):
    """Every count of the funnel and every card, over the whole tables."""
    raw = src.raw_articles(spark, SF_DIR).withColumnsRenamed({"seq": "article_id", "source_name": "source"}).collect()
    tries = defaultdict(dict)
    for a in src.attempts(spark, SF_DIR).collect():
        tries[a.seq][a.attempt] = (a.outcome, a.text)
    issues, groups = [Issue(datetime(2024, 1, day, 22, 0)) for day in (3, 10, 17)], Counter()
    want, counters = plain_digest(raw, tries, issues, Settings(groups=src.GROUPS, excluded=src.DOMAINS), groups)
    funnel = {r.stage: r.n for r in catalog.digest_funnel(spark, SF_DIR).collect()}
    found = {f"group_{g}": groups[g] for g in range(len(src.GROUPS))}
    assert funnel == found | {"all": counters["collected"]} | {k: counters[k] for k in ("valid", "unique", "final")}
    cards = catalog.digest_cards(spark, SF_DIR).collect()
    got = sorted((r.issue_date, r.position, r.source, r.title_ja, r.summary_ja, r.category) for r in cards)
    assert got == sorted((str(day), r[0], *r[3:]) for day, rows in want.items() for r in rows)
    assert len(got) > 5


def test_no_hits_make_no_issue(spark, inputs):
    raw, attempts = inputs
    digest = publish(collect(raw, [Issue(datetime(2030, 1, 1))], SETTINGS), attempts, SETTINGS)
    assert digest.header.count() == digest.counts.count() == digest.cards.count() == 0


def test_window_of_an_issue():
    issue = Issue(datetime(2024, 1, 10, 22, 0))
    assert issue.window_end - issue.window_start == timedelta(days=7)
    assert issue.issue_date == date(2024, 1, 11)
