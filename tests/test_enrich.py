import json

import pytest
from models import enriched
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pressloom.functions.replies import decode_reply
from pressloom.operators import enrich

GOOD = json.dumps({"title_ja": "題", "summary_ja": "要約", "category": "market", "extra": 1}, ensure_ascii=False)
CASES = {
    "plain": {1: ("ok", GOOD)},
    "fenced": {1: ("ok", f" ```json\n{GOOD}\n```\nthat is all")},
    "fence left open": {1: ("ok", f"```\n{GOOD}")},
    "empty fence, then good": {1: ("ok", "```json\n```"), 2: ("ok", GOOD)},
    "one-line fence": {1: ("ok", f"```{GOOD}```"), 2: ("ok", "no"), 3: ("ok", "no")},
    "garbage, then good": {1: ("ok", "Sorry"), 2: ("ok", GOOD)},
    "all bad": {1: ("ok", "a"), 2: ("ok", "{"), 3: ("ok", "")},
    "limited, then good": {1: ("rate_limited", None), 2: ("api_error", None), 3: ("ok", GOOD)},
    "fourth attempt does not exist": {1: ("ok", "x"), 2: ("ok", "x"), 3: ("ok", "x"), 4: ("ok", GOOD)},
    "first readable wins": {2: ("ok", GOOD), 1: ("ok", '{"title_ja": "先"}'), 3: ("ok", GOOD)},
    "no title": {1: ("ok", '{"summary_ja": "s", "category": "company"}')},
    "no summary": {1: ("ok", '{"title_ja": "t", "category": "company"}')},
    "no category": {1: ("ok", '{"title_ja": "t", "summary_ja": "s"}')},
    "nulls stay": {1: ("ok", '{"title_ja": null, "summary_ja": null, "category": null}')},
    "unknown category": {1: ("ok", '{"category": "sports"}')},
    "wrong case": {1: ("ok", '{"category": "Equipment"}')},
    "number as category": {1: ("ok", '{"category": 5}')},
    "not an object": {1: ("ok", '["title_ja"]'), 2: ("ok", GOOD)},
    "trailing text": {1: ("ok", GOOD + " ok?"), 2: ("ok", GOOD)},
    "single quotes": {1: ("ok", "{'title_ja': 'x'}")},
    "text of a failed call": {1: ("api_error", GOOD)},
    "no attempt": {},
}


@pytest.fixture(scope="module")
def tables(spark):
    articles, attempts, want = [], [], {}
    for i, (name, tries) in enumerate(CASES.items()):
        for j, description in enumerate(["text", ""]):
            seq = 2 * i + j
            articles.append((seq, f"Title of {name}", description, "Daily", f"http://a/{seq}"))
            attempts += [(seq, number, *tries[number]) for number in tries]
            want[seq] = enriched(f"Title of {name}", description, tries)
    return (
        spark.createDataFrame(articles, "seq bigint, title string, description string, source string, url string"),
        spark.createDataFrame(attempts, "seq bigint, attempt int, outcome string, text string").repartition(3),
        want,
    )


def test_enrich_equals_the_sequential_rule(tables):
    articles, attempts, want = tables
    rows = enrich.enrich(articles, attempts).collect()
    assert {r.seq: (r.title_ja, r.summary_ja, r.category) for r in rows} == want
    assert len(rows) == len(want)


def test_an_api_error_on_the_last_attempt(spark, tables):
    articles, attempts, _ = tables
    assert enrich.failed_requests(attempts).count() == 0
    extra = spark.createDataFrame([(0, 3, "api_error", None), (900, 1, "ok", "x"), (900, 3, "api_error", None)], attempts.schema)
    assert [r.seq for r in enrich.failed_requests(attempts.unionByName(extra)).collect()] == [900]
    assert enrich.enrich(articles, attempts, strict=True).count() == len(CASES) * 2
    with pytest.raises(PySparkException, match="last attempt"):
        enrich.enrich(articles, attempts.unionByName(extra), strict=True).collect()


def test_replies_that_json_allows_but_columns_do_not():
    assert decode_reply('{"title_ja": "\\ud800x"}')[4] == "�x"
    assert decode_reply('{"category": []}')[0] is False
    assert decode_reply("[" * 100_000)[0] is False
    assert decode_reply(None)[0] is False
    assert decode_reply('{"summary_ja": {"a": "é"}}')[5] == '{"a": "é"}'
    assert decode_reply('{"title_ja": "a", "title_ja": "b"}')[4] == "b"


def test_prompt(tables):
    articles, _, _ = tables
    prompts = {r.seq: r.prompt for r in enrich.requests(articles).collect()}
    assert prompts[0] == "Title: Title of plain\nSource: Daily\nDescription: text\nURL: http://a/0"
    assert prompts[1] == "Title: Title of plain\nSource: Daily\nURL: http://a/1"


def test_labels(column):
    assert column(enrich.category_label, ["market", "other", "Market", None]) == ["市場動向", "その他", "その他", "その他"]
    assert column(enrich.normalize_category, ["market", "other", " market", None, ""]) == ["market", "other", "other", "other", "other"]


def test_only_texts_that_went_through_are_decoded(spark):
    rows = [(1, 1, "api_error", GOOD), (1, 4, "ok", GOOD)]
    parsed = enrich.parse_attempts(spark.createDataFrame(rows, "seq bigint, attempt int, outcome string, text string"))
    assert [(r.attempt, r.reply.ok) for r in parsed.select("attempt", F.col("reply")).collect()] == [(1, False)]
