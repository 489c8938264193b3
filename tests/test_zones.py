from datetime import datetime

from pressloom.issue import Issue
from pressloom.operators.search import date_window
from pressloom.sources import zones


def landed(spark, path, days, mode="append"):
    rows = [(d * 10 + i, f"2026-02-{d:02d}T{i:02d}:00:00Z") for d in days for i in range(3)]
    df = spark.createDataFrame(rows, "seq bigint, published_at string")
    df.repartitionByRange(len(days), "published_at").write.mode(mode).parquet(path)


def test_only_files_of_the_window_are_read(spark, tmp_path):
    path, at = str(tmp_path / "articles"), str(tmp_path / "zones")
    issue = Issue(datetime(2026, 2, 12), days=2)
    landed(spark, path, range(1, 29))
    everything = spark.read.parquet(path)
    want = sorted(r.seq for r in date_window(everything, issue).collect())
    assert len(want) == 9

    def found():
        return sorted(r.seq for r in zones.read_window(spark, path, at, issue).collect())

    assert found() == want  # no map yet: all files
    files = len(everything.inputFiles())
    assert zones.update_zones(spark, path, at) == files > 20
    assert zones.update_zones(spark, path, at) == 0
    assert found() == want
    assert len(zones.files_in_windows(spark, path, at, [issue])) <= 5
    assert len(zones.read_window(spark, path, at, issue).inputFiles()) <= 5

    landed(spark, path, [11, 27])  # landed since: read until the map knows them
    assert len(found()) == 12 and len(zones.files_in_windows(spark, path, at, [issue])) <= 7
    assert zones.update_zones(spark, path, at) == 2
    assert len(found()) == 12 and len(zones.files_in_windows(spark, path, at, [issue])) <= 6

    none = spark.createDataFrame([(1, None), (2, "soon")], "seq bigint, published_at string")
    none.coalesce(1).write.mode("append").parquet(path)
    zones.update_zones(spark, path, at)
    assert len(found()) == 12 and len(zones.files_in_windows(spark, path, at, [issue])) <= 6
    assert zones.read_window(spark, path, at, Issue(datetime(2020, 1, 1))).count() == 0


def test_window_may_start_from_files_rewritten(spark, tmp_path):
    path, at = str(tmp_path / "articles"), str(tmp_path / "zones")
    landed(spark, path, [1, 2, 3])
    zones.update_zones(spark, path, at)
    landed(spark, path, [2, 9], "overwrite")  # the files of the map are gone
    issue = Issue(datetime(2026, 2, 3), days=2)
    assert sorted(r.seq for r in zones.read_window(spark, path, at, issue).collect()) == [20, 21, 22]
