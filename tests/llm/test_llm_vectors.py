"""Centroids, vector codes and fingerprints against plain statements of their results."""

import hashlib
import random
from itertools import combinations

import brute
import duckdb
import numpy as np
import pytest
import xxhash

from pressloom.llm import centroids, queries, simhash, vector_codes

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows, dims=None):
    """(id, integers, label) of the rows that count."""
    finite = [(i, v, n) for i, v, n in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    return [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], n) for i, v, n in finite if dims is None or len(v) == dims]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def best(v, table):
    return min((far(v, c), i) for i, c in enumerate(table))


def moved(vectors, owners, table):
    out = []
    for i, old in enumerate(table):
        own = [v for v, o in zip(vectors, owners, strict=True) if o == i]
        out.append([sum(c) // len(own) for c in zip(*own, strict=True)] if own else old)
    return out


def plain_centroids(rows, dims, k, rounds):
    kept = usable(rows, dims)
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    table, vectors = [v for _, v, _ in order[:k]], [v for _, v, _ in kept]
    for _ in range(rounds):
        table = moved(vectors, [best(v, table)[1] for v in vectors], table)
    found = [best(v, table) for v in vectors]
    inertia = [sum(d for d, c in found if c == i) for i in range(len(table))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in table]
    return sorted(repr((i, c, d, inertia[c], sum(inertia), digest[c])) for (i, _, _), (d, c) in zip(kept, found, strict=True))


def plain_codes(rows, parts, entries, rounds):
    kept = usable(rows)
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = next((len(v) for _, v, _ in order if v and len(v) % parts == 0), None)
    cut = lambda v, p: v[p * dims // parts : (p + 1) * dims // parts]
    fits = [r for r in kept if dims and len(r[1]) == dims]
    books = []
    for p in range(parts if dims else 0):
        own = [cut(v, p) for _, v, _ in fits]
        book = [cut(v, p) for _, v, _ in order if len(v) == dims][:entries]
        for _ in range(rounds):
            book = moved(own, [best(x, book)[1] for x in own], book)
        books.append(book)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        found = [best(cut(v, p), books[p]) for p in range(parts)] if dims and len(v) == dims else None
        out.append((i, label, found and "".join(f"{e:02x}" for _, e in found), found and sum(d for d, _ in found)))
    total = {}
    for _, label, _, error in out:
        if error is not None:
            total[label] = total.get(label, 0) + error
    return sorted(repr((i, code, error, total.get(label), digest)) for i, label, code, error in out)


def odd_vectors(dims, n=150):
    rng = random.Random(dims)
    few = [[rng.randrange(-3, 4) / 256 for _ in range(dims)] for _ in range(12)]  # many ties
    rows = [(i, rng.choice(few) if i % 3 else [rng.uniform(-1, 1) for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [nan] * dims, 1), (n + 3, [inf] + [0.0] * (dims - 1), 1), (n + 4, [None] * dims, 2)]
    rows += [(None, [0.5] * dims, 3), (None, [0.25] * dims, None), (3, [0.125] * dims, 1), rows[5], rows[5], (n + 5, [0.5] * (dims - 1), 7)]
    return rows + [(n + 6, [1000.0] * dims, 1), (n + 7, [-1000.0] * dims, 1)]


@pytest.mark.parametrize(("dims", "k", "rounds", "pivots"), [(8, 10, 3, 4), (64, 40, 2, 16), (2, 500, 2, 3), (4, 1, 1, 1)])
def test_centroids_equal_plain_rounds(spark, dims, k, rounds, pivots):
    rows = odd_vectors(dims)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS near", "3 AS cluster", "4 AS distance")
    got = centroids.clustered(table, k=k, rounds=rounds, dims=dims, pivots=pivots)
    got = got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(repr(tuple(r)) for r in got) == plain_centroids(rows, dims, k, rounds)
    assert centroids.clustered(table.limit(0), k=k).count() == 0


def test_pivots_spare_most_exact_distances(spark):
    rng = np.random.default_rng(1)
    middle = rng.uniform(-1, 1, (20, 16))
    rows = [(i, (middle[i % 20] + rng.normal(0, 0.01, 16)).tolist(), 0) for i in range(600)]
    found, _ = centroids.assigned(spark.createDataFrame(rows, SCHEMA), k=20, dims=16)
    assert found.groupBy().avg("n_measured").first()[0] < 10


def test_vectors_far_out_are_held(spark):
    rows = [(0, [3e38, -3e38], 1), (1, [0.0, 0.0], 1), (2, [3e38, -3e38], 1)]
    got = {r.vec_id: r for r in centroids.clustered(spark.createDataFrame(rows, SCHEMA), k=2, dims=2).collect()}
    assert got[0].distance == got[1].distance == got[2].distance == 0 and got[0].cluster == got[2].cluster != got[1].cluster


@pytest.mark.parametrize(("dims", "parts", "entries"), [(8, 4, 8), (64, 16, 64), (16, 16, 500), (6, 2, 1)])
def test_codes_equal_plain_search(spark, dims, parts, entries):
    rows = odd_vectors(dims)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "'x' AS code", "2 AS error", "'y' AS same")
    got = vector_codes.coded(table, parts=parts, entries=entries)
    got = got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    if entries <= 256:
        assert sorted(repr(tuple(r)) for r in got) == plain_codes(rows, parts, entries, 2)
    else:
        assert len(got) == len(usable(rows))
    assert vector_codes.coded(table.limit(0)).count() == 0


def test_search_ends_before_all_entries(spark):
    rng = np.random.default_rng(2)
    book = vector_codes.Codebook(rng.integers(-99, 99, (64, 4)))
    parts = rng.integers(-99, 99, (1000, 4))
    index, distance, measured = book.nearest(parts)
    entries = np.empty_like(book.entries)
    entries[book.index] = book.entries
    every = ((parts[:, None] - entries) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (distance == every.min(1)).all() and measured < 40 * 1000


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("embeddings", "documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r) for r in got.select(names).collect()) == sorted(want.fetchall())


def plain_fingerprint(text, k=3):
    words = brute.SPACED.findall(brute.lower(text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=2):
    """{id: (fingerprint, component)} of (id, text)."""
    values = {i: plain_fingerprint(t) for i, t in rows}
    distinct = sorted(set(values.values()))
    parent = {v: v for v in distinct}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(distinct, 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    least = {}
    for i, v in values.items():
        least[root(v)] = min(i, least.get(root(v), i))
    return {i: (f"{v:016x}", least[root(v)]) for i, v in values.items()}


def test_op12_on_the_given_table(spark, small):
    docs = [(r.doc_id, r.text) for r in small("documents").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op12_simhash(spark, SF).collect()}
    assert got == plain_groups(docs)


def test_fingerprints_of_odd_rows(spark, odd):
    got = simhash.clusters(odd).collect()
    assert len(got) == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = plain_groups([(i, t) for i, t in rows if i is not None])
    assert all((r.fingerprint, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
    alone = next(r for r in got if r.doc_id is None)
    assert alone.fingerprint == f"{plain_fingerprint('some text of a row without an id'):016x}" and alone.component_id is None
    assert simhash.clusters(odd.limit(0)).count() == 0


@pytest.mark.parametrize("radius", [2, 4])
def test_links_connect_what_all_pairs_would(spark, radius):
    rng = random.Random(radius)
    values = {0, (1 << 64) - 1}
    for _ in range(40):  # families and chains around random values
        v = rng.getrandbits(64)
        for _ in range(12):
            values.add(v)
            for _ in range(rng.randrange(4)):
                v ^= 1 << rng.randrange(64)
    values |= {1 << b for b in range(64)} | {3 << b for b in range(63)}  # a whole ball
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius).collect()
    assert all((r.a ^ r.b & (1 << 64) - 1).bit_count() <= 64 for r in links)
    parent = {v: v for v in signed}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    mask = (1 << 64) - 1
    for r in links:
        assert ((r.a ^ r.b) & mask).bit_count() <= radius
        parent[root(r.a)] = root(r.b)
    for a, b in combinations(signed, 2):
        if ((a ^ b) & mask).bit_count() <= radius:
            assert root(a) == root(b)
