"""Every query against its SQL on another engine, over whole tables."""

from collections import Counter

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from models import ratio, survivors  # noqa: E402
from pressloom.plans import tables  # noqa: E402
from pressloom.plans.catalog import QUERIES  # noqa: E402
from pressloom.plans.catalog_sql import ORACLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, other, name):
    df = QUERIES[name](spark, SF_DIR)
    want = other.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(df.columns)
    place = [want.columns.index(c) for c in columns]
    rows = Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert rows == Counter(tuple(r[i] for i in place) for r in want.fetchall())
    assert rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.columns and df.count() > 0


def test_duplicates_of_the_whole_table_equal_the_loop(spark):
    rows = [(r.seq, r.title, r.url) for r in tables.with_near_copies(spark, SF_DIR).collect()]
    want = survivors(rows)
    assert sorted(r.seq for r in QUERIES["dedup_greedy"](spark, SF_DIR).collect()) == want
    assert len(want) < len(rows) / 2


def test_first_similar_titles_of_the_whole_table_equal_the_loop(spark):
    first = {}
    for seq, title in sorted((r.seq, r.title.lower()) for r in tables.with_near_copies(spark, SF_DIR).collect()):
        first.setdefault(title, seq)
    titles = sorted((seq, title) for title, seq in first.items())
    want = {}
    for i, (b, later) in enumerate(titles):
        for a, earlier in titles[:i]:
            if (found := ratio(later, earlier)) >= 0.75:
                want[later] = (b, earlier, a, found)
                break
    got = QUERIES["title_pairs"](spark, SF_DIR).collect()
    assert {r.later_title: (r.later_seq, r.earlier_title, r.earlier_seq, r.ratio) for r in got} == want
    assert len(got) == len(want) > 20


def test_entry(spark):
    assert contract.entry(spark).count() > 0
