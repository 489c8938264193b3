"""Vector codes by product quantisation, with equal-average search for the nearest entries.

A vector is cut into equal parts, and each part is replaced by the index of the nearest entry of its
position's codebook. Entries are sorted by the sum of their components. The search begins at the part's
own sum and goes outward on both sides, nearest sum first: by Cauchy-Schwarz, the squared distance is at
least the squared gap of the sums over the dimension, so it ends where that strictly exceeds the best
distance found. All parts of a batch go step by step together, those that have ended drop out. Tasks
return sums and counts per entry only; codebooks are of fixed size.

Rows whose vector is null or holds a null or a component that is not finite have no row in the result.
The dimension is that of the vector with the smallest id whose length ``parts`` divides; vectors of other
lengths cannot be coded, and have a null code and error. Integers beyond ``vectors.MOST`` are held there.
Of entries at equal distance the lower index wins. Repeated rows are coded each; of repeated ids the
smaller vector comes first in a codebook, and rows without an id come last. With fewer vectors than entries
codebooks are shorter; an empty table gives no rows. Sums of errors beyond a long are null. Only id,
vector and label are read of a table, whatever else it has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import dropped, map_arrow, stored
from pressloom.llm.vectors import floor_means, integers, lists, matrix, sums

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Sums of errors of up to so many labels are broadcast, more are joined by a shuffle.
BROADCAST_ROWS = 100_000


class Codebook:
    """Of one part position: its entries in the order of their sums."""

    def __init__(self, entries: np.ndarray):
        total = entries.sum(1)
        self.index = np.lexsort((np.arange(len(entries)), total))
        self.entries, self.totals = entries[self.index], total[self.index]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of each part, its squared distance, and how many entries were measured in all."""
        n, dimension = parts.shape
        own = parts.sum(1)
        high = np.searchsorted(self.totals, own)
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        chosen = np.full(n, len(self.index))
        none, live, measured = np.inf, np.arange(n), 0
        # A number on either side, so that both ends can be looked at.
        totals = np.concatenate([[-none], self.totals.astype(float), [none]])
        while len(live):
            mine = own[live].astype(float)
            down, up = mine - totals[low[live] + 1], totals[high[live] + 1] - mine
            rises = up <= down
            gap = np.where(rises, up, down)
            # Beyond 2**53 products are rounded, hence the margin; it only adds steps.
            on = (gap < none) & (gap * gap <= best[live].astype(float) * dimension * (1 + 1e-12))
            live, rises = live[on], rises[on]
            at = np.where(rises, high[live], low[live])
            apart = parts[live] - self.entries[at]
            distance, index = np.einsum("ij,ij->i", apart, apart), self.index[at]
            better = (distance < best[live]) | ((distance == best[live]) & (index < chosen[live]))
            best[live[better]], chosen[live[better]] = distance[better], index[better]
            high[live] += rises
            low[live] -= ~rises
            measured += len(live)
        return chosen, best, measured


def _cut(batch: pa.Array, parts: int) -> np.ndarray:
    """position, row, component."""
    x = matrix(batch)
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2)


def _totals(table: DataFrame, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and sums of every entry that is used, by position and index."""
    parts, (entries, width) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        search = [Codebook(b) for b in books]
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                for p, x in enumerate(_cut(batch.column(0), parts)):
                    index, _, _ = search[p].nearest(x)
                    count[p] += np.bincount(index, minlength=entries)
                    total[p] += sums(index, x, entries)
        part, entry = np.nonzero(count)
        yield {"part": part, "entry": entry, "n": count[part, entry], "total": lists(total[part, entry])}

    tasks = map_arrow(table.select("v"), run, "part int, entry int, n long, total array<long>")
    added = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)]
    rows = tasks.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect()
    return {(r.part, r.entry): (r.n, [r[f"s{i}"] for i in range(width)]) for r in rows}


def learned(table: DataFrame, key: str, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """The codebook of each part position, from vectors ``v`` of one length."""
    first = [r.v for r in table.orderBy(F.col(key).asc_nulls_last(), "v").limit(entries).select("v").collect()]
    books = list(_cut(pa.array(first, pa.list_(pa.int64())), parts))
    for _ in range(rounds):
        found = _totals(table, books)
        books = [
            np.array([floor_means(found[p, e][1], found[p, e][0]) if (p, e) in found else v for e, v in enumerate(b.tolist())], np.int64)
            for p, b in enumerate(books)
        ]
    return books


def coded(
    embeddings: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    key: str = "vec_id",
    column: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """key, code, error, label_error and codebooks_sha256 for every vector that is finite throughout."""
    kept = integers(embeddings, key, column, F.col(label).alias("label"))
    kept = stored(kept)
    whole = kept.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = whole.orderBy(F.col(key).asc_nulls_last(), "v").select(F.size("v")).first()
    fits = F.size("v") == (first[0] if first else -1)
    kind = kept.schema["label"].dataType.simpleString()
    schema = f"{key} long, label {kind}, code string, error long"
    none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
    rows, digest = kept.filter(~fits).select(key, "label", *none), hashlib.sha256(b"").hexdigest()
    if first:
        books = learned(kept.filter(fits), key, parts, entries, rounds)
        digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            search = [Codebook(b) for b in books]
            hexes = np.array([f"{i:02x}" for i in range(max(256, entries))], object)
            for batch in batches:
                if batch.num_rows:
                    found = [s.nearest(x) for s, x in zip(search, _cut(batch.column(2), parts), strict=True)]
                    code = np.add.reduce([hexes[index] for index, _, _ in found])
                    error = np.add.reduce([best for _, best, _ in found])
                    yield {key: batch.column(0), "label": batch.column(1), "code": code, "error": error}

        rows = map_arrow(kept.filter(fits).select(key, "label", "v"), run, schema).unionByName(rows)
    rows = stored(rows)
    dropped(kept)
    total = F.sum(F.col("error").cast("decimal(38,0)")).alias("total")
    by_label = stored(rows.groupBy("label").agg(total).select("label", F.col("total").try_cast("long").alias("label_error")))
    by_label = by_label.withColumnRenamed("label", "same")
    by_label = F.broadcast(by_label) if by_label.count() <= BROADCAST_ROWS else by_label
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("same")))
    return joined.select(key, "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
