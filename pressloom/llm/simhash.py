"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 h`` bits have a value between them that differs from each
in at most ``h``. So every distinct fingerprint emits all values within ``h`` bits of itself, the shuffle
brings equal values together, and what meets is checked. A value is met by no more fingerprints than
its own ball holds (65 for ``h`` = 1), whatever the table; of those each is paired with the smallest
only. They differ in at most ``2 h`` bits all, so these pairs connect what all pairs would.

A fingerprint has a bit set if more than half the XXH64 hashes of the text's shingles have it, repeats
included. A text with fewer words than a shingle has is one shingle; without words, null or empty, its
fingerprint is zero, which is linked like any other. A text of any length is hashed in runs of bounded
number. Repeated rows give repeated results; the smallest id of a component is its name, null if
none of its rows has an id. An empty table gives no rows. Only id and text are read of a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.components import components
from pressloom.llm.shared import dropped, map_arrow, stored, utf8

WORDS, RADIUS, SEED, BITS = 3, 2, 42, 64
#: Hashes whose bits are counted at once.
_RUN = 1 << 16


def fingerprint(text: bytes, k: int = WORDS) -> int:
    """Of a UTF-8 text, unsigned. Both lower() and split() of bytes know ASCII only, as is asked for."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(k, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (begins + lengths)[k - 1 :]
    begins = begins[: len(ends)]
    above = np.zeros(BITS, np.int64)
    for at in range(0, len(ends), _RUN):
        spans = zip(begins[at : at + _RUN].tolist(), ends[at : at + _RUN].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        above += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * above > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), k) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield {"doc_id": batch.column(0), "fp": found.view(np.int64)}

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")), run, "doc_id long, fp long")


def ball(radius: int, bits: int = BITS) -> list[int]:
    """All values with at most ``radius`` bits set, as signed numbers."""
    masks = (sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r))
    return [m - (1 << bits) if m >> (bits - 1) else m for m in masks]


def links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b that connect all distinct values ``fp`` that differ in ``radius`` bits or fewer."""
    masks = F.array(*map(F.lit, ball((radius + 1) // 2)))
    variants = values.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    first = F.min("fp").over(Window.partitionBy("variant"))
    met = variants.withColumn("first", first).filter("first < fp")
    met = met.select(F.col("first").alias("a"), F.col("fp").alias("b"))
    return met.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def clusters(docs: DataFrame, k: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint in hex and component_id (the smallest id reachable by links) per row."""
    if radius % 2:
        raise ValueError("the radius has to be even, so that two halves meet")
    rows = stored(fingerprints(docs, k))
    values = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    label = components(links(values, radius)).select(F.col("node").alias("fp"), "component")
    label = stored(values.join(label, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")))
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    names = stored(label.join(least, "component").select("fp", "component_id"))
    for table in (values, label):
        dropped(table)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(names, "fp", "left").select("doc_id", digits.alias("fingerprint"), "component_id")
