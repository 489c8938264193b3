from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pressloom.functions import text as tx

BLANK_CHARACTERS = [chr(i) for i in range(1, 0x3100) if chr(i).isspace()]


def test_strip_knows_every_blank(column):
    assert sorted(tx.BLANKS) == BLANK_CHARACTERS
    values = [c + "a" + c + "b" + c for c in BLANK_CHARACTERS] + ["", " \t　", "​a"]
    assert column(tx.strip, values) == [v.strip() for v in values]


def test_normalize_url(column):
    urls = ["http://A.com/x/", "http://a.com/x///", "HTTP://a.com/x?q=1/", "/", "http://a.com/x#F/", "http://a.com/İ/"]
    assert column(tx.normalize_url, urls) == [u.rstrip("/").lower() for u in urls]


def test_domains_do_not_match_inside_a_label(column):
    urls = ["https://x.com/a", "https://netflix.com/a", "https://www.X.com:8080/", "http://u@m.x.com?q", "nothing", "https://x.com.evil.org"]
    assert column(lambda c: tx.in_domains(tx.host_of(c), ["x.com"]), urls) == [True, False, True, True, False, False]


def test_occurrences_do_not_overlap(column):
    values = ["aaaa", "aa", "a", "", "baab aa"]
    assert column(lambda c: tx.occurrences(c, "aa"), values) == [v.count("aa") for v in values]


INSTANTS = [
    "2026-02-20T10:00:00Z", "2026-02-20", "2026-02-20T10:00", "2026-02-20T10Z", "2026-02-20 10:00:00.123456789+09:00",
    "20260220T100000Z", "20260220", "20260220T1000", "2026-02-20T10:00:00+0900", "2026-02-20T10:00:00-05",
    "2026-02-20T10:00:00,5Z", "2026-02-30T00:00:00Z", "2026-02-20T25:00:00Z", "2026", "2026-02", "12:30", "", "x",
    "2026-02-20T10:00:00ZZ", "0001-01-01T00:00:00Z", "0000-01-01", "2024-02-29T23:59:59.9+00:00", "now", "epoch",
    "2026-02-20t10:00:00+00:00", "2026-02-20_10:00:00Z", "2026-02-20T100000Z", "2026-02-20T10:00:00+09:00:30",
    "2026-02-20T10:00:00+18:30", "2026-02-20T10:00:00-23:59", "2026-02-20T10:00:00+24:00", "2026-W08-5", "2026W085", "2026-W08",
    "2026W08T10", "2026-W53-1", "2020-W53-7T01:02:03Z", "2026-W00-1", "2026-W08-8", "2026-W085", "2026W08-5", "20260220T10:00:00Z",
    "2026-02-20T1000:00Z", "2026-0220", "202602-20", "2026-02-20T10:60Z", "2026-02-20T10:00:00+0900:30", "2026-02-20T10:00:00+090030.5",
    "2026-02-20\n10:00", "2026-02-20T", "2026-02-20T10:00:00.Z", "2026-02-20+09:00", "\n2026-02-20", "2026-02-20\n", "１026-02-20",
]


def python_micros(text):
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_parse_instant_does_not_depend_on_the_session(spark, column, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert column(lambda c: F.unix_micros(tx.parse_instant(c)), INSTANTS) == [python_micros(t) for t in INSTANTS]
        assert column(tx.published_label, ["2026-02-23T21:14:09Z", "2026-02-18T16:04:00Z", "2026-02-20T14:59:59Z", "soon", ""]) == [
            "2026年02月24日", "2026年02月19日", "2026年02月20日", "soon", ""]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_missing_offset_is_flagged(column):
    texts = ["2026-02-20T10:00:00Z", "2026-02-20T10:00:00", "2026-02-20", "x", None, "2026-02-20T10:00-05"]
    assert column(tx.lacks_offset, texts) == [False, True, True, False, False, False]
    assert column(lambda c: tx.parse_instant(c).isNull(), [None]) == [True]


@pytest.mark.parametrize(
    ("text", "content"),
    [
        ('```json\n{"a":1}\n```', '{"a":1}'),
        ("```\n{}", "{}"),
        ("```json\n```", ""),
        ("```", ""),
        ("a```\nb", "a```\nb"),
        (' {"x":1} \n', '{"x":1}'),
        ("```json\n1\n```\nafter", "1"),
        ('```{"a":1}```', ""),
        ("```json\n\n{}\n  ```\n", "\n{}\n  ```"),
        ("\n```\na\n```b\nc", "a"),
        ("", ""),
    ],
)
def test_strip_fence(column, text, content):
    assert column(tx.strip_fence, [text]) == [content]
