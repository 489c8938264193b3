"""Language identification by a bit-sliced Bloom filter of n-grams.

The filter is one table of bit masks, one bit per language; an n-gram's languages are the bits set
at all of its positions, so one look-up answers for all languages at once. A document counts, per
language, the n-grams whose mask has the language's bit; the counts are corrected for the false
positives expected from how full the language's slice is, and the highest count decides.

n-grams are ``GRAM`` bytes of the text with letters in lower case and everything else in ASCII as
spaces. A language's slice holds its ``GRAMS`` most frequent n-grams, those left out that are over
ten times as frequent in some other language: they are quotations and noise.

Null texts and texts without a letter are ``und`` with score 0, as are all where nothing was learned.
A text too short for an n-gram gets the most frequent language, with score 0. Ties go to the language
that sorts first. Repeated rows are judged each. A text of any length is read whole, in slices with others.
An empty table gives no rows; ``accepted`` keeps all columns of a table, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import dropped, fresh, map_arrow, received, send, stored, utf8
from pressloom.llm.words import SLICE_BYTES, buffers, mix

GRAM = 4
#: Bounds of what is learned: about so many documents per language (chosen by a hash of their id),
#: n-grams per language, and positions of the filter.
SAMPLE, GRAMS, BITS, PROBES = 5_000, 50_000, 20, 3
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def remainder(column: str = "doc_id") -> Column:
    """Of a document's id, 0 for documents held out from learning."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5))


def grams(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a binary array: first row, number of rows, n-grams, row of each n-gram."""
    ends, raw = buffers(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        part = raw[ends[row] : ends[stop]]
        folded = _FOLD[part]
        # Capitals with accents are two bytes, the second 0x20 below that of the small letter.
        capital = (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[:-1] == 0xC3)
        folded[1:][capital] += 0x20
        sizes = np.diff(ends[row : stop + 1])
        text = np.repeat(np.arange(stop - row), sizes)
        padded = np.full(len(part) + 2 * (stop - row), 0x20, np.uint8)
        padded[np.arange(len(part)) + 2 * text + 1] = folded
        owner = np.repeat(np.arange(stop - row), sizes + 2)
        n = len(padded) - GRAM + 1
        if n > 0:
            key = np.zeros(n, np.uint32)
            blank = padded == 0x20
            double = blank[:-1] & blank[1:]
            use = owner[:n] == owner[GRAM - 1 :]
            for j in range(GRAM):
                key = (key << np.uint32(8)) | padded[j : j + n]
            for j in range(GRAM - 1):
                use &= ~double[j : j + n]
            yield row, stop - row, key[use], owner[:n][use]
        else:
            yield row, stop - row, np.zeros(0, np.uint32), np.zeros(0, np.int64)
        row = stop


def _places(keys: np.ndarray, bits: int, probes: int) -> list[np.ndarray]:
    h = mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(j * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64) for j in range(probes)]


@dataclass
class Filter:
    languages: list[str]  # sorted; language i has bit i % 64 of word i // 64
    common: str | None  # the language of most documents
    masks: np.ndarray  # [word, position]
    false: np.ndarray  # expected share of false positives per language
    bits: int = BITS
    probes: int = PROBES

    def counts(self, keys: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """[language, row]: n-grams found, corrected for false positives."""
        total = np.bincount(owner, minlength=rows)
        out = np.zeros((len(self.languages), rows))
        places = _places(keys, self.bits, self.probes)
        for word, masks in enumerate(self.masks):
            mask = masks[places[0]]
            for at in places[1:]:
                mask &= masks[at]
            for bit, language in enumerate(range(64 * word, min(64 * word + 64, len(self.languages)))):
                has = (mask & masks.dtype.type(1 << bit)) != 0
                out[language] = np.bincount(owner[has], minlength=rows)
        false = self.false[:, None]
        return np.clip((out - total * false) / (1 - false), 0, None)


    def decide(self, row: int, size: int, keys: np.ndarray, owner: np.ndarray, letters: pa.Array) -> tuple[list, list]:
        """Language and score of the texts from ``row`` on; ``letters`` tells which have any."""
        total, counts = np.bincount(owner, minlength=size), self.counts(keys, owner, size)
        names, scores = [], []
        for i, some in enumerate(letters.slice(row, size).to_pylist()):
            if not self.languages or not some:
                names.append(UNKNOWN)
                scores.append(0.0)
            elif not total[i]:
                names.append(self.common)
                scores.append(0.0)
            else:
                best = int(np.argmax(counts[:, i]))
                names.append(self.languages[best])
                scores.append(min(1.0, float(counts[best, i] / total[i])))
        return names, scores


def _letters() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _training(docs: DataFrame, sample: int) -> tuple[DataFrame, dict[str, int]]:
    rows = docs.filter((remainder() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return rows, sizes
    share = F.create_map(*(F.lit(x) for kv in ((k, min(1.0, sample / n)) for k, n in sorted(sizes.items())) for x in kv))
    place = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(place < share[F.col("lang")]), sizes


def learn(
    docs: DataFrame, sample: int = SAMPLE, per_language: int = GRAMS, bits: int = BITS, probes: int = PROBES
) -> Filter:
    """A filter of what the languages of ``docs`` contain; ``sample`` documents each are enough."""
    rows, sizes = _training(docs, sample)
    languages = sorted(sizes)
    count = max(1, -(-len(languages) // 64))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * t().nbytes or t is np.uint64)
    masks, false = np.zeros((count, 1 << bits), kind), np.zeros(len(languages))
    if not languages:
        return Filter(languages, None, masks, false, bits, probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            names, code = np.unique(np.asarray(batch.column(0).to_pylist(), dtype=object), return_inverse=True)
            for row, size, keys, owner in grams(batch.column(1)):
                own = code[row : row + size][owner].astype(np.uint64)
                both, n = np.unique((own << np.uint64(32)) | keys, return_counts=True)
                yield {
                    "lang": [names[i] for i in (both >> np.uint64(32)).tolist()],
                    "gram": (both & np.uint64(0xFFFFFFFF)).astype(np.int64),
                    "n": n,
                }

    counted = map_arrow(rows.select("lang", utf8("text").alias("text")), run, "lang string, gram long, n long")
    counted = counted.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    totals = F.create_map(*(F.lit(x) for k in languages for x in (k, float(min(sizes[k], sample)))))
    counted = counted.withColumn("rate", F.col("n") / totals[F.col("lang")])
    # Per n-gram a map of its few languages, in place of a join with the highest rate.
    by_gram = counted.groupBy("gram").agg(F.collect_list(F.struct("lang", "n", "rate")).alias("in"), F.max("rate").alias("top"))
    kept = by_gram.select("gram", "top", F.explode("in").alias("in")).filter((F.col("in.rate") * 10 >= F.col("top")) & (F.col("in.n") > 1))
    kept = stored(kept)
    for i, language in enumerate(languages):
        best = kept.filter(F.col("in.lang") == language).orderBy(F.desc("in.n"), "gram").limit(per_language)
        keys = np.asarray(best.select("gram").toArrow()["gram"], dtype=np.int64)
        own = np.zeros(1 << bits, bool)
        for at in _places(keys.astype(np.uint32), bits, probes):
            own[at] = True
        masks[i // 64][own] |= kind(1 << i % 64)
        false[i] = own.mean() ** probes
    dropped(kept)
    common = max(languages, key=lambda k: (sizes[k], k))
    return Filter(languages, common, masks, false, bits, probes)


def predict(docs: DataFrame, languages: Filter) -> DataFrame:
    """doc_id, lang_pred and score (the share of n-grams that the language contains) per row."""
    sent = send(docs.sparkSession, languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = received(sent)
        for batch in batches:
            for row, size, keys, owner in grams(batch.column(1)):
                names, scores = known.decide(row, size, keys, owner, batch.column(2))
                yield {"doc_id": batch.column(0).slice(row, size), "lang_pred": names, "score": scores}

    source = docs.select("doc_id", utf8("text").alias("text"), _letters())
    return map_arrow(source, run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, languages: Filter, least: float) -> DataFrame:
    """Rows of ``docs`` with a language and a score of ``least`` or more; a null lang is filled in."""
    sent, names = send(docs.sparkSession, languages), docs.columns
    bytes_, letters = fresh(docs, "text_bytes"), fresh(docs, "has_letters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(sent)
        for batch in batches:
            found = [known.decide(*part, batch[letters]) for part in grams(batch[bytes_])]
            kept = pa.array([n != UNKNOWN and s >= least for some in found for n, s in zip(*some, strict=True)], pa.bool_())
            guess = pa.array([n for some in found for n in some[0]], pa.string())
            columns = [pc.coalesce(batch[c], guess.cast(batch[c].type)) if c == "lang" else batch[c] for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(kept)

    source = docs.withColumns({bytes_: utf8("text"), letters: _letters()})
    return source.mapInArrow(run, docs.schema)


def identified(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then predict all."""
    found = predict(docs, learn(docs))
    held_out = F.coalesce(remainder() == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
