import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from pressloom.lineage import shared_dir
from pressloom.operators.quality import valid_articles
from pressloom.schemas import ARTICLE
from pressloom.sources import archive, responses
from pressloom.streaming.landing import store_articles, stream_articles, stream_rejected


def raw(**fields):
    base = {"source": {"name": "Daily"}, "title": "T", "description": "D", "url": "http://a/1", "publishedAt": "2026-02-20T10:00:00Z", "urlToImage": None}
    return {**base, **fields}


RECORDS = [
    raw(title=" Padded　", description=None, url=" http://a/2 "),
    raw(title=None),
    raw(title="   "),
    raw(url=""),
    raw(title=" [REMOVED]\n"),
    raw(description="[removed] "),
    raw(title="[Removed] soon", source={"name": ""}),
    raw(title="blank source", source={"name": "  "}),
    raw(title="null source", source=None),
    raw(title="no source name", source={}),
    {k: v for k, v in raw(title="no time").items() if k != "publishedAt"},
]
RESPONSES = [
    {"group_idx": 1, "status": "ok", "articles": RECORDS},
    {"group_idx": 2, "status": "error", "code": "rateLimited", "message": "slow down", "articles": [raw()]},
    {"group_idx": 3, "status": "ok"},
    {"group_idx": 4, "articles": [raw()]},
    {"group_idx": 6, "status": "ok", "articles": "oops"},
]


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    lines = [json.dumps(r, ensure_ascii=False) for r in RESPONSES] + ["{broken"]
    (folder / "a.json").write_text("\n".join(lines), encoding="utf-8")
    return str(folder)


def test_responses(spark, landed):
    read = responses.read_responses(spark, landed)
    rows = responses.raw_articles(read).collect()
    assert [r.pos for r in rows] == list(range(len(RECORDS)))
    assert {r.group_idx for r in rows} == {1}
    rejected = {(r.group_idx, r.code, r.unreadable) for r in responses.rejected_responses(read).collect()}
    assert rejected == {(2, "rateLimited", False), (4, None, False), (6, None, True), (None, None, True)}
    assert not any(r.unreadable for r in rows)


def test_a_field_of_another_type_flags_its_response(spark, tmp_path):
    body = {"group_idx": 7, "status": "ok", "articles": [raw(source="BBC")]}
    (tmp_path / "one.json").write_text(json.dumps(body, indent=1))
    read = responses.read_responses(spark, str(tmp_path), multi_line=True)
    assert [(r.group_idx, r.title, r.source_name, r.unreadable) for r in responses.raw_articles(read).collect()] == [(7, "T", None, True)]
    assert [(r.group_idx, r.unreadable) for r in responses.rejected_responses(read).collect()] == [(7, True)]


def test_text_bodies_give_the_same_rows(spark, landed):
    read = responses.raw_articles(responses.read_responses(spark, landed))
    parsed = responses.raw_articles(responses.parse_responses(spark.read.text(landed).withColumnRenamed("value", "body")))
    assert sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, parsed.collect()), key=str)


def test_projection(spark, landed):
    valid = valid_articles(responses.raw_articles(responses.read_responses(spark, landed)))
    got = {r.title: r for r in responses.project_articles(valid).collect()}
    assert set(got) == {"Padded", "[Removed] soon", "blank source", "null source", "no source name", "no time"}
    assert (got["Padded"].description, got["Padded"].url) == ("", "http://a/2")
    assert {t: got[t].source for t in got} == {
        "Padded": "Daily", "[Removed] soon": "Unknown", "blank source": "", "null source": "Unknown",
        "no source name": "Unknown", "no time": "Daily"}
    assert got["no time"].published_at == ""


def stored(spark, issue_date, n, mark):
    rows = [(i + 1, f"t{i}", "", f"http://a/{i}", "S", "2026-02-20T10:00:00Z", None, f"題{mark}{i}", "要約", "other", issue_date) for i in range(n)]
    fields = ", ".join(f"{f.name} string" for f in ARTICLE)
    return spark.createDataFrame(rows, f"position bigint, {fields}, issue_date date")


def test_archive_overwrites_only_the_written_issue(spark, tmp_path):
    path = str(tmp_path / "archive")
    first, second = date(2026, 2, 22), date(2026, 2, 23)
    archive.write_archive(stored(spark, first, 3, "a").unionByName(stored(spark, second, 8, "a")), path)
    archive.write_archive(stored(spark, second, 2, "b"), path)
    read = archive.read_archive(spark, path)
    assert {r.issue_date: r["count"] for r in read.groupBy("issue_date").count().collect()} == {first: 3, second: 2}
    assert [r.title_ja for r in read.filter(F.col("issue_date") == second).orderBy("position").collect()] == ["題b0", "題b1"]
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "archive").rglob("*.json"))
    assert "題b0" in text and '"image_url":null' in text
    assert read.select(*[f.name for f in ARTICLE]).schema.names == ARTICLE.names


def test_issue_files(spark, tmp_path):
    for day, n in (("2026-02-22", 3), ("2026-02-23", 8)):
        items = [{f.name: f"{f.name} {i}" for f in ARTICLE} | {"image_url": None} for i in range(n)]
        (tmp_path / f"articles-{day}.json").write_text(json.dumps(items, indent=2), encoding="utf-8")
    rows = archive.read_issue_files(spark, str(tmp_path / "articles-*.json")).collect()
    assert len(rows) == 11
    assert all(r.title == f"title {r.position - 1}" and r.image_url is None for r in rows)
    assert {r.issue_date for r in rows} == {date(2026, 2, 22), date(2026, 2, 23)} and not any(r.unreadable for r in rows)
    (tmp_path / "articles-2026-02-24.json").write_text("[{broken")
    (tmp_path / "articles-2026-02-25.json").write_text("[]")
    (tmp_path / "articles-undated.json").write_text(json.dumps([{"title": "t"}]))
    rows = archive.read_issue_files(spark, str(tmp_path / "articles-*.json")).collect()
    assert sorted((str(r.issue_date), r.title) for r in rows if r.unreadable) == [("2026-02-24", None), ("None", "t")]
    assert len(rows) == 13


def test_stream_picks_up_new_files_once(spark, landed, tmp_path):
    out, state = str(tmp_path / "articles"), str(tmp_path / "state")

    def run():
        query = store_articles(stream_articles(spark, landed), out, state)
        query.awaitTermination(120)
        return spark.read.parquet(out)

    rejected = stream_rejected(spark, landed).writeStream.format("memory").queryName("rejected").trigger(availableNow=True).start()
    rejected.awaitTermination(120)
    assert {r.group_idx for r in spark.table("rejected").collect()} == {2, 4, 6, None}
    assert run().count() == 6
    (tmp_path / "landed" / "b.json").write_text(json.dumps({"group_idx": 5, "status": "ok", "articles": [raw(title="late")]}))
    assert run().count() == 7
    assert {str(r.published_date) for r in run().select("published_date").distinct().collect()} == {"2026-02-20", "None"}


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
