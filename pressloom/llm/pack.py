"""Packing into sequences by deficit round-robin over source queues.

Each source is a queue of tokens. A window takes from every queue its quantum, the target share of
the window's tokens; what whole tokens cannot express is carried as the queue's deficit to the next
window, across partitions too. All of it has a closed form: a queue gives tokens at the rate of its share,
in fractions of 2^-32, and after k windows it has given the whole tokens of what has flowed. So a document's
place follows from the number of tokens before it in its queue, and nothing is processed in turn. Where a
queue runs out, within a window too, the others share its rate at once in their proportions and keep their
deficits, so every window but the last is full up to less than one token a queue.

With targets, each source that is named has a queue, and all others share one, which is taken from when
those named have run out. Without, each source's share is its part of the corpus; sources that would
give less than one token a window share one queue with the sum of their shares. Both hold for any number
of sources.

The windows' tokens, one after another, are cut into full sequences; the rest at the very end goes
into sequences of powers of two. Nothing is padded and each token lies in exactly one piece.

Texts are tokenized once, into a table in the shared folder. Null or empty texts are one end token. A text
of any length is tokenized whole and cut where windows and sequences end. Repeated rows and ids are packed
each; a null source is a source of its own. Within a queue documents follow each other in the order of the
partitions, so nothing is tied. An empty table gives no pieces. Only id, text and source are read of a
table, whatever other columns it has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.shared import map_arrow, received, send, stored

SEQUENCE, SEQUENCES_PER_WINDOW, END = 1024, 64, 0
#: The queue that sources without a queue of their own share; names of others begin with "=" or are empty.
SHARED = "~"
#: Tokens of the shared queue's sources are summed up in so many parts at once.
_BUCKETS = 1024
#: Tables of token counts per task and queue up to this many rows are broadcast, larger ones joined.
BROADCAST_ROWS = 1_000_000
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256

_CELLS = 1 << 20


class Tokens:
    """Token ids of texts, each encoded whole."""

    def __init__(self, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.bpe.encode_ordinary(text), np.uint16).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 16-bit ids."""
        if SPECIAL not in text:
            return self._encode(text)
        special = np.asarray([SPECIAL_ID], np.uint16).tobytes()
        return special.join(map(self._encode, text.split(SPECIAL)))


def _tag(source: object) -> str:
    return "" if source is None else f"={source}"


def tokenized(docs: DataFrame, ranks_path: str) -> DataFrame:
    """A stored table: ids of each document and its place among its task's tokens of its source."""
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokens, part = Tokens(ranks_path), TaskContext.get().partitionId()
        end, given = np.asarray([END], np.uint16).tobytes(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                ids = [tokens.encode(t) + end for t in some.column(2).to_pylist()]
                starts = []
                for name, own in zip(some.column(1).to_pylist(), ids, strict=True):
                    starts.append(given.get(name, 0))
                    given[name] = starts[-1] + len(own) // 2
                yield {
                    "part": np.full(len(ids), part),
                    "doc_id": some.column(0),
                    "source": some.column(1),
                    "before": starts,
                    "n": [len(own) // 2 for own in ids],
                    "ids": ids,
                }

    rows = docs.select("doc_id", source.alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(map_arrow(rows, run, "part long, doc_id long, source string, before long, n long, ids binary"))


@dataclass
class Plan:
    """What each queue has given after k windows: a phase ends where a queue runs out."""

    totals: np.ndarray  # [queue]
    begins: np.ndarray  # [phase]: tokens of the stream before
    given: np.ndarray  # [phase, queue]: tokens before
    rest: np.ndarray  # [phase, queue]: what has flowed besides, in 2^-32 tokens
    rate: np.ndarray  # [phase, queue]: in 2^-32 tokens for a token of the stream
    size: int  # tokens of a window
    windows: int

    @staticmethod
    def make(totals: list[int], shares: list[float] | None, window: int) -> Plan:
        """Without shares each queue's is its part of all tokens, so that all end together."""
        share = np.asarray(totals if shares is None else shares, float)
        begins, given, rest, rates = [], [], [], []
        time, done, flowed = 0, [0] * len(totals), [0] * len(totals)
        while any(d < t for d, t in zip(done, totals, strict=True)):
            live = np.asarray([d < t for d, t in zip(done, totals, strict=True)])
            part = np.where(live, share, 0.0)
            part = np.where(live, 1.0, 0.0) if part.sum() == 0 else part
            rate = np.floor(part / part.sum() * 2**32).astype(np.int64)
            rate[(rate == 0) & (part > 0)] = 1
            begins.append(time)
            given.append(list(done))
            rest.append(list(flowed))
            rates.append(rate)
            flows = [(i, int(r)) for i, r in enumerate(rate) if r]
            steps = [-((flowed[i] - (totals[i] - done[i] << 32)) // r) for i, r in flows]
            step = max(steps) if shares is None else min(steps)
            for i, r in flows:
                whole = flowed[i] + step * r
                done[i], flowed[i] = done[i] + (whole >> 32), whole & 0xFFFFFFFF
                if done[i] >= totals[i]:
                    done[i], flowed[i] = totals[i], 0
            time += step
        table = [np.asarray(x, np.int64).reshape(len(begins), len(totals)) for x in (given, rest, rates)]
        return Plan(np.asarray(totals, np.int64), np.asarray(begins, np.int64), *table, window, -(-time // window))

    def after(self, k: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Tokens given by ``queue`` in the windows before ``k``."""
        time = k * self.size
        phase = np.maximum(np.searchsorted(self.begins, time, "right") - 1, 0)
        step, rate = time - self.begins[phase], self.rate[phase, queue]
        # step * rate in two parts, as it may exceed 64 bits.
        high, low = (step >> 30) * rate, (step & 0x3FFFFFFF) * rate
        flowed = (high >> 2) + (low + self.rest[phase, queue] + ((high & 3) << 30) >> 32)
        return np.where(k >= self.windows, self.totals[queue], np.minimum(self.given[phase, queue] + flowed, self.totals[queue]))

    def window(self, at: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """The window that takes the token ``at`` of ``queue``."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.windows, np.int64)
        while (low + 1 < high).any():  # after(low) <= at < after(high)
            mid = (low + high) // 2
            right = self.after(mid, queue) <= at
            low, high = np.where(right & (low + 1 < high), mid, low), np.where(right, high, mid)
        return low

    def place(self, k: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Where in the whole stream window ``k`` has its first token of ``queue``."""
        windows, back = np.unique(k, return_inverse=True)
        out = np.zeros(len(k), np.int64)
        every = np.arange(len(self.totals))
        step = max(1, _CELLS // max(1, len(every)))
        for a in range(0, len(windows), step):
            some = windows[a : a + step]
            begin = self.after(some[:, None], every[None, :])
            size = self.after(some[:, None] + 1, every[None, :]) - begin
            first = begin.sum(1, keepdims=True) + np.cumsum(size, 1) - size
            mine = (back >= a) & (back < a + step)
            out[mine] = first[back[mine] - a, queue[mine]]
        return out


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers low..high of every row: the row and the number."""
    size = high - low + 1
    row = np.repeat(np.arange(len(low)), size)
    return row, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[row]


def sequences(total: int, length: int = SEQUENCE) -> tuple[int, np.ndarray]:
    """Full sequences, and where those of the rest begin: powers of two, largest first."""
    rest = total % length
    sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return total // length, total - rest + np.cumsum([0, *sizes])[:-1].astype(np.int64)


def _queues(table: DataFrame, targets: dict[str, float] | None, window: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    """part, source, queue and base (tokens of the queue before); the queues with their tokens."""
    parts = stored(table.groupBy("part", "source").agg(F.sum("n").alias("n")))
    sources = stored(parts.groupBy("source").agg(F.sum("n").alias("n")))
    if targets is None:  # at most ``window`` sources hold so much
        own = F.col("n") * window >= (sources.agg(F.sum("n")).first()[0] or 0)
    else:
        own = F.col("source").isin([_tag(s) for s in targets])
    bucket = F.pmod(F.xxhash64("source"), F.lit(_BUCKETS))
    sources = stored(sources.withColumns({"queue": F.when(own, F.col("source")).otherwise(SHARED), "bucket": bucket}))
    # The shared queue holds one source after the other, by bucket and name.
    shared = sources.filter(F.col("queue") == SHARED)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = shared.groupBy("bucket").agg(F.sum("n").alias("m")).withColumn("begin", F.coalesce(F.sum("m").over(before), F.lit(0)))
    inside = F.sum("n").over(Window.partitionBy("bucket").orderBy("source")) - F.col("n")
    shared = shared.withColumn("inside", inside).join(F.broadcast(buckets), "bucket")
    begins = shared.select("source", "queue", (F.col("begin") + F.col("inside")).alias("begin"))
    begins = stored(begins.unionByName(sources.filter(F.col("queue") != SHARED).select("source", "queue", F.lit(0).cast("long").alias("begin"))))
    begins = F.broadcast(begins) if begins.count() <= BROADCAST_ROWS else begins
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")
    base = parts.withColumn("earlier", earlier).join(begins, "source")
    base = base.select("part", "source", "queue", (F.col("begin") + F.col("earlier")).alias("base"))
    sums = sources.groupBy("queue").agg(F.sum("n").alias("n")).collect()
    return (F.broadcast(base) if parts.count() <= BROADCAST_ROWS else base), sorted((r.queue, r.n) for r in sums)


def packed(
    docs: DataFrame,
    ranks_path: str,
    targets: dict[str, float] | None = None,
    length: int = SEQUENCE,
    per_window: int = SEQUENCES_PER_WINDOW,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens.

    ``targets`` gives sources, some thousands at most, their share of every window (others get none while
    those with a share last); without it the shares are those of the whole corpus.
    """
    table = tokenized(docs, ranks_path)
    base, sums = _queues(table, targets, length * per_window)
    number = {queue: i for i, (queue, _) in enumerate(sums)}
    wanted = {_tag(s): share for s, share in (targets or {}).items()}
    shares = None if targets is None else [wanted.get(queue, 0.0) for queue, _ in sums]
    plan = Plan.make([n for _, n in sums], shares, length * per_window)
    full, tail = sequences(int(plan.totals.sum()), length)
    sent = send(docs.sparkSession, (plan, number))
    rows = table.join(base, ["part", "source"]).select("doc_id", "queue", (F.col("base") + F.col("before")).alias("at"), "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        plan, number = received(sent)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                yield _pieces(batch.slice(begin, 1000), plan, number, length, full, tail)

    return map_arrow(
        rows,
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long",
    )


def _pieces(batch: pa.RecordBatch, plan: Plan, number: dict[str, int], length: int, full: int, tail: np.ndarray) -> dict:
    queue = np.asarray([number[q] for q in batch["queue"].to_pylist()], np.int64)
    at, n = np.asarray(batch["at"], np.int64), np.asarray(batch["n"], np.int64)
    # Cut at windows of the queue, then at sequences of the stream.
    doc, k = _expand(plan.window(at, queue), plan.window(at + n - 1, queue))
    low = np.maximum(plan.after(k, queue[doc]), at[doc])
    high = np.minimum(plan.after(k + 1, queue[doc]), at[doc] + n[doc])
    doc, k, low, high = (x[low < high] for x in (doc, k, low, high))
    stream = plan.place(k, queue[doc]) + low - plan.after(k, queue[doc])

    def sequence(g: np.ndarray) -> np.ndarray:
        return np.where(g < full * length, g // length, full + np.searchsorted(tail, g, "right") - 1)

    row, which = _expand(sequence(stream), sequence(stream + high - low - 1))
    begins = np.concatenate([tail, [np.iinfo(np.int64).max]])
    past = np.clip(which - full, 0, max(0, len(tail) - 1))
    first = np.where(which < full, which * length, begins[past])
    last = np.where(which < full, (which + 1) * length, begins[np.minimum(past + 1, len(tail))])
    left = np.maximum(stream[row], first)
    size = np.minimum((stream + high - low)[row], last) - left
    start = left - stream[row] + low[row] - at[doc[row]]
    crc, ids, own = [], None, -1
    data = batch["ids"]
    for d, a, m in zip(doc[row].tolist(), start.tolist(), size.tolist(), strict=True):
        if d != own:
            ids, own = np.frombuffer(data[d].as_buffer(), np.uint16).astype("<u4"), d
        crc.append(zlib.crc32(ids[a : a + m]))
    return {
        "doc_id": batch["doc_id"].take(pa.array(doc[row])),
        "start": start,
        "length": size,
        "ids_crc32": crc,
        "doc_tokens": n[doc[row]],
        "sequence_id": which,
        "offset": left - first,
        "window": k[row],
    }
