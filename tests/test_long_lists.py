"""Operators on long lists: many phrases, many domains, many titles, many URLs."""

import os
import random

import numpy as np
import pytest
from models import ratio
from pyspark.sql import functions as F

from pressloom.functions import similarity
from pressloom.functions.phrases import Phrases
from pressloom.operators import dedup, search, title_candidates, titles
from pressloom.plans import tables

SF_DIR = "/root/testdata/sf0.001"
ARTICLE = "seq bigint, title string, description string, url string"


def plain_hits(text, phrases):
    return sum(text.count(p) for p in phrases if p)


def test_phrases_are_counted_without_overlaps():
    rng = random.Random(3)
    groups = [(g, ["".join(rng.choice("ab ") for _ in range(rng.randrange(5))) for _ in range(6)]) for g in range(40)]
    automaton = Phrases(groups)
    for _ in range(200):
        text = "".join(rng.choice("ab ") for _ in range(rng.randrange(60)))
        hits = dict.fromkeys(range(40), 0)
        automaton.add_hits(text, hits)
        assert hits == {g: plain_hits(text, phrases) for g, phrases in groups}
    none = Phrases([(0, [""])])
    none.add_hits("text", {})


@pytest.mark.parametrize("chars", [8_000_000, 10])
def test_automata_match_what_expressions_do(spark, monkeypatch, chars):
    monkeypatch.setattr(search, "AUTOMATON_CHARS", chars)
    groups = [("Paint Booth", "booth", "oo"), ("ÄRGER", "İx"), ("absent",), ("aa", "aaa", "aa")]
    rows = [(1, "Paint booth BOOTH", None, "u"), (2, None, "ärger aaaa aaaaa", "u"), (3, "", "", "u"), (4, "none", "at all", "u")]
    df = spark.createDataFrame(rows, ARTICLE)
    got = sorted(map(tuple, search.match_groups(df, groups, expressions=0).collect()), key=repr)
    assert got == sorted(map(tuple, search.match_groups(df, groups, expressions=100).collect()), key=repr)
    assert len(got) == 3


@pytest.mark.parametrize("most", [1000, 0])
def test_listed_domains_exclude_what_a_short_list_does(spark, most):
    domains = ["bad.example", "EVIL.com", "a.b.c.d.net", "localhost", "com.evil", "", None]
    hosts = ["bad.example", "x.bad.example", "notbad.example", "example", "evil.com", "y.z.EVIL.com", "evil.com.org"]
    hosts += ["a.b.c.d.net", "q.a.b.c.d.net", "b.c.d.net", "localhost", "x.localhost", "com.evil"]
    rows = [(i, "t", "d", f"https://user@{h}:80/p?x=y") for i, h in enumerate(hosts)] + [(90, "t", "d", None), (91, "t", "d", "no url")]
    df = spark.createDataFrame(rows, ARTICLE).withColumns({"_host": F.lit("kept"), "domain": F.lit("kept")}).drop("_host")
    listed = spark.createDataFrame([(d,) for d in domains + domains], "domain string")
    got = search.exclude_listed(df, listed, most=most)
    assert got.columns == df.columns
    want = search.exclude_domains(df, [d for d in domains if d])
    assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in want.collect())
    assert search.exclude_listed(df, listed.limit(0)).count() == len(rows)


@pytest.mark.parametrize("suspects", [1000, 1])
def test_rows_with_a_url_of_their_own_are_not_ranked(spark, suspects):
    rows = [(i, "t", "d", f"http://a/{i}" if i > 9 else f"http://A/{i % 4}" + "/" * i) for i in range(50)]
    df = spark.createDataFrame(rows, ARTICLE).repartition(6)
    got = dedup.first_per_url(df, suspects=suspects)
    assert got.columns == df.columns and sorted(r.seq for r in got.collect()) == [*range(4), *range(10, 50)]


def recall(df, **options):
    got = {r.later_title: r for r in title_candidates.first_similar_candidates(df, **options).collect()}
    want = {r.later_title: r for r in titles.first_similar_titles(df).collect()}
    for r in got.values():
        assert r.later_title in want and r.earlier_seq >= want[r.later_title].earlier_seq and r.earlier_seq < r.later_seq
        assert r.ratio >= 0.75 and r.ratio == ratio(r.later_title, r.earlier_title)
        assert (r.later_seq, r.later_n) == (want[r.later_title].later_seq, want[r.later_title].later_n)
    return len(got) / len(want)


def test_candidates_find_nine_in_ten_of_the_given_titles(spark):
    assert recall(tables.with_near_copies(spark, SF_DIR)) >= 0.9


def test_families_that_no_value_parts_are_searched_exactly(spark):
    rng = random.Random(7)
    rows = [(i, "the very same headline of the day" + "!" * (i % 50)) for i in range(300)]
    rows += [(1000 + i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) for _ in range(6))) for i in range(150)]
    rows += [(2000, ""), (2001, None), (2002, "a"), (2003, "A"), (2004, "ab"), (2005, "\U0001f600 " * 30), (2006, "x" * 5000), (2007, "x" * 5001)]
    df = spark.createDataFrame(rows, "seq bigint, title string")
    small, large = title_candidates.bucketed(titles.distinct_titles(df.filter("title is not null"), [], "title", "seq"), 8, 2, 5)
    assert large.count() > 0 and small.groupBy("bucket").count().agg({"count": "max"}).first()[0] <= 5
    assert recall(df, depth=2, most=5) >= 0.9
    assert title_candidates.first_similar_candidates(df.limit(0)).count() == 0


def test_issue_files_are_replaced_whole_or_not_at_all(spark, tmp_path):
    from pressloom.sources import archive

    path = f"{tmp_path}/issues"

    def issue(days, mark, fail=False):
        rows = [(p, day, mark) for day in days for p in (2, 1, 3)]
        df = spark.createDataFrame(rows, "position bigint, day string, title string")
        text = [F.lit(None).cast("string").alias(c) for c in ("description", "url", "source", "published_at", "image_url", "title_ja", "summary_ja")]
        title = F.concat("title", F.lit(" 新\n"), F.col("position").cast("string"))
        if fail:
            title = F.when(F.col("day") == days[-1], F.raise_error(F.lit("broken"))).otherwise(title)
        return df.repartition(4).select("position", title.alias("title"), *text, F.lit("other").alias("category"), F.to_date("day").alias("issue_date"))

    def stored():
        found = archive.read_issue_files(spark, f"{path}/*.json").filter("not unreadable").collect()
        return sorted((str(r.issue_date), r.position, r.title, r.category) for r in found)

    def want(*issues):
        return sorted((day, p, f"{mark} 新\n{p}", "other") for day, mark in issues for p in (1, 2, 3))

    days = ["2026-03-02", "2026-03-09", "2026-03-16"]
    archive.write_issue_files(issue(days[:2], "old"), path)
    assert stored() == want((days[0], "old"), (days[1], "old"))
    with pytest.raises(Exception, match="broken"):
        archive.write_issue_files(issue(days, "new", fail=True), path)
    assert stored() == want((days[0], "old"), (days[1], "old"))
    archive.write_issue_files(issue(days[1:], "new"), path)
    assert stored() == want((days[0], "old"), (days[1], "new"), (days[2], "new"))
    assert sorted(os.listdir(path)) == [f"articles-{d}.json" for d in days]


def test_groups_of_any_size_give_the_first_match_of_each_title(monkeypatch):
    monkeypatch.setattr(similarity, "_PAIRS_AT_ONCE", 500)
    rng = random.Random(11)
    titles_, groups = [], []
    for group, size in enumerate([1, 3, 31, 70, 2, 150]):
        for _ in range(size):
            length = rng.choice([0, 3, 12, 40, 70, 130, 300]) if group % 2 else rng.choice([8, 9, 10])
            titles_.append("".join(rng.choice("ab c") for _ in range(length)))
            groups.append(group)
    long = "".join(rng.choice("abcdefgh ") for _ in range(4200))
    titles_, groups = titles_ + [long, long[:64] + long[70:]], groups + [9, 9]
    filled = [k for k, t in enumerate(titles_) if t]
    titles_, groups = [titles_[k] for k in filled], np.array(groups)[filled]
    want = {}
    for i, t in enumerate(titles_):
        for j in range(i):
            if groups[i] == groups[j] and (r := ratio(t, titles_[j])) >= 0.75:
                want[i] = (j, r)
                break
    got = similarity.first_matches_in_groups(titles_, groups, 0.75)
    assert {i: (j, r) for i, j, r in got} == want and len(got) == len(want)


def test_families_are_compared_without_a_call_for_each(spark, monkeypatch):
    """Crowded buckets that are not huge go through the calls that hold many buckets."""
    rng = random.Random(12)
    bases = ["".join(rng.choice("abcdefghij ") for _ in range(50)) for _ in range(20)]
    rows = [(f * 1000 + k, base[:-2] + f"{k:02d}") for f, base in enumerate(bases) for k in range(40)]
    df = spark.createDataFrame(rows, "seq long, title string")

    def blocks(*_):
        raise AssertionError("searched in blocks")

    with monkeypatch.context() as own:
        own.setattr(title_candidates, "first_rivals", blocks)
        got = {r.later_seq: r.earlier_seq for r in title_candidates.first_similar_candidates(df).collect()}
    assert len(got) >= 770 and all(seq // 1000 == first // 1000 and first < seq for seq, first in got.items())
    monkeypatch.setattr(title_candidates, "FAMILY", 20)
    again = {r.later_seq: r.earlier_seq for r in title_candidates.first_similar_candidates(df).collect()}
    assert again == got
