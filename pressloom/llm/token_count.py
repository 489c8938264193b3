"""Token counts by a two-tier lookup on the map side.

The tokenizer splits no token across a space that follows another character, so a text is a row of
pre-tokens, each a word with the spaces before it, and its tokens are the sum of theirs. Spaces at the
end are a pre-token of their own, and U+2581 is a space to the tokenizer. The first
tier is a table of frequent pre-tokens and their lengths, sent to all workers; the second a cache in
each worker, filled by the tokenizer. Pre-tokens are never shuffled: tasks report only their own
most frequent ones, and the table keeps ``TABLE_WORDS`` of them.

The table changes the speed and no count. Null or empty texts have no tokens. A text of any length is
counted whole, and split once. Repeated rows and ids are counted each; an empty table gives no rows. Only
id and text are read of a table, whatever other columns it has.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.shared import map_arrow

TABLE_WORDS, TASK_WORDS, CACHE_WORDS = 1 << 16, 1 << 13, 1 << 18
LIMIT = 4096
#: A pre-token longer than this is encoded each time, so that caches stay small.
LONGEST = 64


def pretokens(text: str) -> list[str]:
    """Pieces of ``text`` with their leading spaces but the first, as the tokenizer sees words.

    An empty last piece stands for a single space at the end of the text.
    """
    parts = text.replace("\u2581", " ").split(" ")
    if "" not in parts:
        return parts
    out, gap = [], ""
    for part in parts[:-1]:
        if part:
            out.append(gap + part)
            gap = ""
        else:
            gap += " "
    out.append(gap + parts[-1])
    return out


def frequent(docs: DataFrame, words: int = TABLE_WORDS, per_task: int = TASK_WORDS) -> list[str]:
    """Frequent pre-tokens over all texts, by the counts that tasks report of their most frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(p for p in pretokens(text) if len(p) <= LONGEST)
                if len(seen) > 16 * per_task:  # rare ones make room
                    seen = Counter(dict(seen.most_common(4 * per_task)))
        top = seen.most_common(per_task)
        yield {"word": [w for w, _ in top], "n": [n for _, n in top]}

    tops = map_arrow(docs.select("text").filter("text is not null and text != ''"), run, "word string, n long")
    best = tops.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return [r.word for r in best.select("word").collect()]


class Lengths:
    """Lengths of pre-tokens: the table first, then the cache, then the tokenizer."""

    def __init__(self, model_path: str, table: dict[str, int], cache_words: int = CACHE_WORDS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.table, self.cache, self.room = table, {}, cache_words
        self.last = len(self.model.encode("a ")) - len(self.model.encode("a"))

    def lengths(self, words: list[str]) -> list[int]:
        found = self.model.encode(words, num_threads=1)
        return [len(ids) if word else self.last for word, ids in zip(words, found, strict=True)]

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = pretokens(text)
        found = list(map(self.table.get, words))
        if None not in found:
            return sum(found)
        missed = [w for w, n in zip(words, found, strict=True) if n is None]
        known = list(map(self.cache.get, missed))
        total = sum(filter(None, found)) + sum(filter(None, known))
        new = [w for w, n in zip(missed, known, strict=True) if n is None]
        if new:
            fresh = self.lengths(new)
            total += sum(fresh)
            if len(self.cache) + len(new) > self.room:
                self.cache.clear()
            self.cache.update((w, n) for w, n in zip(new, fresh, strict=True) if len(w) <= LONGEST)
        return total


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row of ``docs``."""
    words = frequent(docs)
    counter = Lengths(model_path, {})
    table = dict(zip(words, counter.lengths(words) if words else [], strict=True))
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = Lengths(model_path, sent.value)
        for batch in batches:
            counts = [own.count(t) for t in batch.column(1).to_pylist()]
            yield {"doc_id": batch.column(0), "n_bytes": batch.column(2), "n_tokens": counts}

    source = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
    )
    counted = map_arrow(source, run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
