import os
import shutil
from datetime import date
from glob import glob

import pytest
from pyspark.sql import functions as F

from pressloom.operators import report
from pressloom.sources import archive, states

DAYS = [date(2026, 2, 22), date(2026, 2, 23), date(2026, 3, 2)]


def articles(spark, sizes, category="market"):
    rows = [
        (i + 1, f"t{i}", "d", f"http://a/{i}", "s", "2026-02-20T10:00:00Z", None, f"題{i}", "要約", category if i % 3 else "other", day)
        for day, n in sizes.items()
        for i in range(n)
    ]
    return spark.createDataFrame(rows, archive._STORED.simpleString()[7:-1].replace(":", " ")).repartition(3)


def tables(read):
    made = (report.counts_of, report.header_of, report.category_text_of, report.preview_of, lambda s: report.notification_of(s, "http://x", "T"))
    return [sorted(map(str, table(read).collect())) for table in made]


@pytest.fixture
def store(tmp_path):
    return f"{tmp_path}/issues", f"{tmp_path}/states"


def test_tables_follow_the_archive(spark, store):
    path, kept = store
    archive.write_archive(articles(spark, dict(zip(DAYS, (3, 8, 1)))), path)
    assert states.read_states(spark, path, kept).count() == 0
    assert states.update_states(spark, path, kept) == 3
    assert states.update_states(spark, path, kept) == 0
    archive.write_archive(articles(spark, {DAYS[1]: 2, date(2026, 3, 9): 7}, "equipment"), path)
    assert sorted(r.issue_date for r in states.read_states(spark, path, kept).collect()) == [DAYS[0], DAYS[2]]
    assert states.update_states(spark, path, kept) == 2
    shutil.rmtree(f"{path}/issue_date={DAYS[2]}")
    full = report.issue_states(archive.read_archive(spark, path))
    assert tables(states.read_states(spark, path, kept)) == tables(full)
    assert full.count() == 3


def test_only_rewritten_issues_are_read(spark, store):
    path, kept = store
    archive.write_archive(articles(spark, dict(zip(DAYS, (3, 8, 1)))), path)
    states.update_states(spark, path, kept)
    # Files of an issue that changes by stealth: size and time stay, so its state must stay as well.
    for file in glob(f"{path}/issue_date={DAYS[1]}/*.json"):
        before = os.stat(file)
        with open(file, "rb+") as f:
            text = f.read().replace(b'"market"', b'"mraket"')
            f.seek(0)
            f.write(text)
        os.utime(file, ns=(before.st_atime_ns, before.st_mtime_ns))
    archive.write_archive(articles(spark, {DAYS[0]: 6}), path)
    assert states.update_states(spark, path, kept) == 1
    n = {r.issue_date: r.n_market for r in states.read_states(spark, path, kept).collect()}
    assert n == {DAYS[0]: 4, DAYS[1]: 5, DAYS[2]: 0}


def test_updates_that_overlap_count_once(spark, store):
    path, kept = store
    archive.write_archive(articles(spark, {DAYS[0]: 4}), path)
    states.update_states(spark, path, kept)
    spark.read.parquet(kept).coalesce(1).write.mode("append").parquet(kept)
    assert states.read_states(spark, path, kept).select("total_articles").collect() == [(4,)]


def test_an_archive_without_issues(spark, store):
    path, kept = store
    os.makedirs(path)
    assert states.update_states(spark, path, kept) == 0
    assert tables(states.read_states(spark, path, kept)) == [[]] * 5


def test_an_issue_without_a_date(spark, store):
    path, kept = store
    archive.write_archive(articles(spark, {DAYS[0]: 2}).withColumn("issue_date", F.lit(None).cast("date")), path)
    archive.write_archive(articles(spark, {DAYS[0]: 3}), path)
    assert states.update_states(spark, path, kept) == 2
    assert sorted((str(r.issue_date), r.total_articles) for r in states.read_states(spark, path, kept).collect()) == [("2026-02-22", 3), ("None", 2)]
