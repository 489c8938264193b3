"""Benchmark decontamination by winnowing.

Fingerprints of a text are the smallest k-gram hashes of every window of ``window - k + 1``
consecutive k-grams. Two texts that share ``window`` consecutive words share a whole window of
k-grams, hence its smallest hash, so no shared span is missed. A benchmark item of fewer than
``window`` words is one window itself; for each such length the hashes of all document windows of
that length are fingerprints. Documents whose fingerprints meet a benchmark item get their hits
extended: every shared word window is marked.

Null or empty texts have no words and are never hit. Items without an id hit, but are not counted or
named. Equal items are reported each. Repeated document rows are judged each. Of equal smallest hashes
in a window any may stand for it, as both sides choose alike. A text of any length is searched whole.
Without documents there are no rows, without items no hits. Only ids and texts are read of a table,
whatever other columns it has. Word and window hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import map_arrow, received, send, utf8
from pressloom.llm.words import ALNUM, Words, of_text, slices

WINDOW, GRAM = 10, 5
#: Benchmarks up to this many words are sent to every worker; larger ones meet in a shuffled join.
BROADCAST_WORDS = 4_000_000

_REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, spans array<array<long>>"


def winnow(words: Words, window: int = WINDOW, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (k-gram hashes) and the text each belongs to, counted from the first."""
    grams, whole = words.grams(k)
    n, span = len(grams), window - k + 1
    if not n:
        return grams, np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    least = grams.copy()
    for j in range(1, min(span, n)):
        least[: n - j] = np.minimum(least[: n - j], grams[j:])
    last = np.repeat(words.first[1:], np.diff(words.first))
    full = np.arange(n) + window <= last
    least, text = least[full], text[full]
    new = np.ones(len(least), bool)  # neighbouring windows mostly share their smallest hash
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    return least[new], text[new]


class Index:
    """Windows of benchmark items: window hash -> items, with fingerprints that lead to them."""

    def __init__(self, window: int = WINDOW, k: int = GRAM):
        self.window, self.k = window, k
        self.items: list[str] = []
        self.prints: dict[int, list[np.ndarray]] = {}
        self.keys: dict[int, list[np.ndarray]] = {}
        self.owners: dict[int, list[np.ndarray]] = {}

    def add(self, ids: list[str], texts: pa.Array) -> None:
        for words in slices(texts, ALNUM):
            sizes = np.diff(words.first)
            base = len(self.items)
            self.items += ids[words.row : words.row + len(sizes)]
            self._put(self.window, words, sizes >= self.window, base)
            self.prints.setdefault(self.window, []).append(winnow(words, self.window, self.k)[0])
            for m in np.unique(sizes[(sizes > 0) & (sizes < self.window)]):
                self._put(int(m), words, sizes == m, base)

    def _put(self, m: int, words: Words, chosen: np.ndarray, base: int) -> None:
        text = np.repeat(np.arange(len(chosen)), np.diff(words.first))
        grams, whole = words.grams(m)
        use = whole & chosen[text]
        self.keys.setdefault(m, []).append(grams[use])
        self.owners.setdefault(m, []).append(text[use] + base)
        if m < self.window:
            self.prints.setdefault(m, []).append(grams[use])

    def build(self) -> Index:
        for m, parts in self.keys.items():
            key, owner = np.concatenate(parts), np.concatenate(self.owners[m])
            order = np.argsort(key, kind="stable")
            self.keys[m], self.owners[m] = key[order], owner[order]
        for m, parts in self.prints.items():
            found = np.unique(np.concatenate(parts))
            some = np.zeros(1 << 16, bool)  # a first look that rules out nearly all
            some[(found >> np.uint64(48)).astype(np.int64)] = True
            self.prints[m] = (found, some)
        return self

    def meets(self, m: int, hashes: np.ndarray) -> np.ndarray:
        found, some = self.prints[m]
        out = np.zeros(len(hashes), bool)
        maybe = np.flatnonzero(some[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(maybe) and len(found):
            at = np.minimum(np.searchsorted(found, hashes[maybe]), len(found) - 1)
            out[maybe] = found[at] == hashes[maybe]
        return out

    def candidates(self, words: Words) -> np.ndarray:
        """Texts that share a fingerprint with some item."""
        out = np.zeros(len(words.first) - 1, bool)
        for m in self.prints:
            if m == self.window:
                hashes, text = winnow(words, self.window, self.k)
            else:
                hashes, whole = words.grams(m)
                text = np.repeat(np.arange(len(out)), np.diff(words.first))[whole]
                hashes = hashes[whole]
            out[text[self.meets(m, hashes)]] = True
        return out

    def extend(self, hashes: np.ndarray) -> tuple[np.ndarray, set[str]]:
        """Which words of one text lie in a shared window, and the items those windows are of."""
        n = len(hashes)
        depth, items = np.zeros(n + 1, np.int64), set()
        words = of_text(hashes)
        for m, keys in self.keys.items():
            grams, whole = words.grams(m)
            at = np.flatnonzero(whole)
            if not len(at) or not len(keys):
                continue
            low, high = np.searchsorted(keys, grams[at], "left"), np.searchsorted(keys, grams[at], "right")
            hit = high > low
            np.add.at(depth, at[hit], 1)
            np.add.at(depth, at[hit] + m, -1)
            for a, b in np.unique(np.stack([low[hit], high[hit]], 1), axis=0):
                items.update(self.items[i] for i in self.owners[m][a:b] if self.items[i] is not None)
        return np.cumsum(depth[:-1]) > 0, items


def _spans(hit: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _judge(index: Index, ids: list, words: Words) -> dict:
    rows = {"doc_id": ids, "n_words": np.diff(words.first), "n_hit": [], "n_items": [], "items_sha256": [], "spans": []}
    none = _digest(set())
    for i, maybe in enumerate(index.candidates(words)):
        hit, items = np.zeros(0, bool), set()
        if maybe:
            hit, items = index.extend(words.hashes[words.first[i] : words.first[i + 1]])
        rows["n_hit"].append(int(hit.sum()))
        rows["n_items"].append(len(items))
        rows["items_sha256"].append(_digest(items) if items else none)
        rows["spans"].append(_spans(hit))
    return rows


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = GRAM, broadcast_words: int = BROADCAST_WORDS
) -> DataFrame:
    """One row per document: words, words hit, items met, and the hit spans in words."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), utf8("text").alias("text"))
    # A word takes two bytes at least, with the space after it.
    if (items.agg(F.sum(F.length("text"))).first()[0] or 0) <= 2 * broadcast_words:
        index = Index(window, k)
        table = items.toArrow()
        index.add(table["item_id"].to_pylist(), table["text"].combine_chunks())
        sent = send(spark, index.build())
        return _by_broadcast(docs, sent)
    return _by_join(docs, items, window, k)


def _by_broadcast(docs: DataFrame, sent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        index = received(sent)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for words in slices(batch.column(1), ALNUM):
                yield _judge(index, ids[words.row : words.row + len(words.first) - 1], words)

    return map_arrow(docs.select("doc_id", utf8("text").alias("text")), run, _REPORT)


def _by_join(docs: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """The same for benchmarks of any size: fingerprints meet in a shuffled join.

    Each document then meets only the items it shares a fingerprint with, one pair at a time.
    """
    lengths = map_arrow(
        items.select("text"),
        lambda bs: ({"m": np.diff(w.first)} for b in bs for w in slices(b.column(0), ALNUM)),
        "m long",
    )
    short = [r.m for r in lengths.filter((F.col("m") > 0) & (F.col("m") < window)).distinct().collect()]

    def prints(own: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for words in slices(batch.column(1), ALNUM):
                    sizes = np.diff(words.first)
                    hashes, text = winnow(words, window, k)
                    found = [(window, hashes, text)]
                    for m in short:
                        grams, whole = words.grams(m)
                        text = np.repeat(np.arange(len(sizes)), sizes)
                        use = whole & (sizes[text] == m) if own else whole
                        found.append((m, grams[use], text[use]))
                    ids = np.asarray(batch.column(0))[words.row : words.row + len(sizes)]
                    for m, hashes, text in found:
                        yield {"key": hashes.view(np.int64), "m": np.full(len(text), m), "row": ids[text]}

        return run

    items = items.withColumn("item", F.xxhash64("item_id", "text"))
    numbered = docs.select("doc_id", utf8("text").alias("text"))
    numbered = numbered.withColumn("at", F.xxhash64("text"))
    texts = numbered.select("at", "text").dropDuplicates(["at"])
    doc_prints = map_arrow(texts, prints(False), "key long, m long, row long").distinct()
    item_prints = map_arrow(items.select("item", "text"), prints(True), "key long, m long, row long")
    item_prints = item_prints.withColumnRenamed("row", "item").distinct()
    pairs = doc_prints.join(item_prints, ["key", "m"]).select(F.col("row").alias("at"), "item").distinct()
    pairs = pairs.join(texts, "at").join(items.withColumnRenamed("text", "item_text"), "item")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                index = Index(window, k)
                index.add(one["item_id"].to_pylist(), pa.concat_arrays([one["item_text"]]))
                index.build()
                for words in slices(pa.concat_arrays([one["text"]]), ALNUM):
                    hit, _ = index.extend(words.hashes)
                    spans = _spans(hit)
                    if spans:
                        yield {"at": one["at"].to_pylist(), "item_id": one["item_id"].to_pylist(), "spans": [spans]}

    found = map_arrow(pairs.select("at", "item_id", "item_text", "text"), extend, "at long, item_id string, spans array<array<long>>")
    found = found.groupBy("at").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
    )
    counts = map_arrow(
        numbered.select("doc_id", "text", "at"),
        lambda bs: (
            {"doc_id": b.column(0).slice(w.row, len(w.first) - 1), "at": b.column(2).slice(w.row, len(w.first) - 1), "n_words": np.diff(w.first)}
            for b in bs
            for w in slices(b.column(1), ALNUM)
        ),
        "doc_id long, at long, n_words long",
    )
    # Spans of different items overlap; sorted by start, each adds what lies beyond those before it.
    merged = F.aggregate(
        F.coalesce("spans", F.expr("array()").cast("array<array<long>>")),
        F.expr("cast(array() as array<array<long>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(F.element_at(done, -1), 2) >= s[0]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.array(F.element_at(done, -1)[0], F.greatest(F.element_at(F.element_at(done, -1), 2), s[1]))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    joined = counts.join(found, "at", "left").withColumn("spans", merged)
    return joined.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0]).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        "spans",
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return overlaps(docs, benchmark).withColumn("contaminated", F.col("n_hit") > 0).drop("spans")
