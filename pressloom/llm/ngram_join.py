"""Near duplicates: an exact Jaccard join on word n-grams with adaptive multi-match prefixes.

A document is the set of its shingles. Shingles have one global order, those estimated to be rare
first; a document posts its first ones, its prefix. Two documents that are similar enough must share
a number of posted shingles that follows from their sizes and prefix lengths, and only pairs that do
are verified. Each document chooses its prefix length: longer prefixes cost more postings but demand
more shared shingles, which pays where the estimated number of candidates is high. The estimates
come from a count sketch over all shingles of all documents, of fixed size; they change the work and
never the result.

The output is components, so no pair within a known component is looked at:

1. Equal sets are one class with one fingerprint (64 bits), and only classes go on.
2. In every list of a posted shingle, the class with the fewest rare shingles leads, and the others
   are verified against leaders only. This links groups of near copies in linear work.
   Before whole sets are fetched, pairs are ruled out by parity bitmaps: the bits in which two differ
   are at most as many as the shingles in which the sets differ.
3. Lists that still span several components yield the pairs between components; they are counted,
   verified and linked. In lists too long for that, pairs are tried by sizes and bitmaps first, in
   blocks of bounded size. What is left of a block is verified pair by pair where that is little; else
   the members that are left are cut into blocks, and every two blocks are compared in one task by a
   matrix product, exactly. So whole sets travel for members that may be similar only.

Null or empty texts have an empty set and are linked with nothing; with fewer words than a shingle
has, the whole sequence is the only shingle. Rows are judged by their texts; rows without an id get
the id of their class, or none. Repeated rows give repeated results. A text of any length is one set. Shingles
that are equally rare are ordered by their hashes, so both sides of a pair order them alike. An empty table
gives no rows. Only id and text are read of a table, whatever other columns it has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.components import components
from pressloom.llm.shared import dropped, map_arrow, received, send, stored, utf8, without
from pressloom.llm.words import SPACED, Words, mix, slices

WORDS, PERCENT = 5, 80
SKETCH_BITS = 21
#: Prefix extensions to choose from, and the cost of verifying a pair in posted shingles.
EXTENSIONS, VERIFY_COST = (1, 2, 3, 4, 6, 8), 8
#: A list of up to so many classes is joined with itself; longer ones are compared in blocks.
LIST, BLOCK_BYTES, LEAST_BYTES = 64, 4 << 20, 4096
#: Members whose bitmaps meet in one task, and pairs a member that are verified one by one.
SCREEN_ROWS, PAIRS_EACH = 1024, 4

#: Up to so many documents to be fetched are picked by a broadcast of their ids, more by a join.
BROADCAST_ROWS = 1_000_000

#: Shingles counted at once, and fingerprints a task remembers in order not to post copies again.
_HELD, _KNOWN = 1 << 18, 1 << 17

_SIZE = (1 << 28) - 1


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """The sorted shingle hashes of every text."""
    sizes = np.diff(words.first)
    grams, _ = words.grams(k)
    short = {m: words.grams(m)[0] for m in np.unique(sizes[(sizes > 0) & (sizes < k)]).tolist()}
    out = []
    for a, m in zip(words.first.tolist(), sizes.tolist(), strict=False):
        out.append(np.unique(grams[a : a + m - k + 1]) if m >= k else short[m][a : a + 1] if m else grams[:0])
    return out


def fingerprint(shingles: np.ndarray) -> int:
    """Of a set, as a signed 64-bit number."""
    total = np.add.reduce(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(mix(np.asarray([total ^ np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def parity(shingles: np.ndarray) -> bytes:
    """A bitmap of two bits a shingle or more, a power of two in all; each shingle flips one bit."""
    bits = 1 << max(6, (2 * len(shingles) - 1).bit_length())
    at = (shingles >> np.uint64(24)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two parity bitmaps differ, the larger folded to the size of the smaller."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), 0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _profiles(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """doc_id, n, fp and a hash of the text per row; one more row per task with its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sketch, waiting, held = np.zeros(1 << bits, np.uint32), [], 0
        for batch in batches:
            for words in slices(batch.column(1), SPACED):
                sets = shingle_sets(words, k)
                waiting += sets
                held += sum(map(len, sets))
                if held > _HELD:
                    _count(sketch, waiting)
                    waiting, held = [], 0
                yield {
                    "doc_id": batch.column(0).slice(words.row, len(sets)),
                    "n": [len(s) for s in sets],
                    "fp": [fingerprint(s) for s in sets],
                    "parity": [parity(s) for s in sets],
                    "at": batch.column(2).slice(words.row, len(sets)),
                    "sketch": [None] * len(sets),
                }
        _count(sketch, waiting)
        yield {"doc_id": [None], "n": [int(sketch.sum(dtype=np.int64))], "fp": [0], "parity": [None], "at": [None], "sketch": [zlib.compress(sketch.tobytes(), 1)]}

    source = docs.select("doc_id", utf8("text").alias("text"), F.xxhash64("text").alias("at"))
    return stored(map_arrow(source, run, "doc_id long, n long, fp long, parity binary, at long, sketch binary"))


def _count(sketch: np.ndarray, sets: list[np.ndarray]) -> None:
    if sets:
        at = np.concatenate(sets) & np.uint64(len(sketch) - 1)
        np.add.at(sketch, at.astype(np.int64), np.uint32(1))


def _counters(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint32)


def _add(a: bytes, b: bytes) -> bytes:
    total = np.minimum(_counters(a).astype(np.uint64) + _counters(b), np.uint64(0xFFFFFFFF))
    return zlib.compress(total.astype(np.uint32).tobytes(), 1)


def _sketch(profiles: DataFrame, bits: int) -> np.ndarray:
    """The sum of all tasks' sketches; on the way to the driver they stay packed."""
    parts: RDD = profiles.filter("sketch is not null").select("sketch").rdd.map(lambda r: bytes(r[0]))
    if parts.isEmpty():
        return np.zeros(1 << bits, np.uint32)
    # Steps of about four at a time, so that a few sketches reach the driver from any number of tasks.
    return _counters(parts.treeReduce(_add, max(2, parts.getNumPartitions().bit_length() // 2)))


def prefix(shingles: np.ndarray, sketch: np.ndarray, load: float, percent: int) -> tuple[np.ndarray, int]:
    """The posted shingles of a set, and its rare ones in 1/127 of all."""
    n = len(shingles)
    seen = sketch[(shingles & np.uint64(len(sketch) - 1)).astype(np.int64)].astype(float)
    # Other shingles of the same counter add ``load``, with a spread of its root. Those that are rare
    # beyond doubt are one class, in order of their hashes; frequent ones follow in powers of two.
    level = np.where(seen <= load + 6 * load**0.5 + 8, 0, np.log2(np.maximum(seen - load, 1)).astype(np.int64))
    order = np.lexsort((shingles, level))
    least = n + percent * n // -100 + 1  # n - ceil(percent * n / 100) + 1
    cost = np.cumsum(np.maximum(seen[order] - load - 1, 0))
    best = None
    for more in EXTENSIONS:
        size = least + more - 1
        if size > n:
            break
        found = cost[size - 1]
        price = found + VERIFY_COST * found / more
        if best is None or price < best[0]:
            best = (price, size)
    size = best[1] if best else n
    return shingles[order[:size]], int(127 * np.count_nonzero(level == 0) // n)


def _postings(docs: DataFrame, sent: Broadcast, k: int, percent: int) -> DataFrame:
    """shingle, fp, meta for the prefix of every class; meta holds rare share, set size, prefix size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts, known = received(sent), set()
        load = float(counts.mean())
        for batch in batches:
            for words in slices(batch.column(0), SPACED):
                token, fp, meta = [], [], []
                for own in shingle_sets(words, k):
                    if not len(own):
                        continue
                    key = fingerprint(own)
                    if key in known:  # a copy of one this task has posted
                        continue
                    if len(known) < _KNOWN:
                        known.add(key)
                    posted, rare = prefix(own, counts, load, percent)
                    token.append(posted.view(np.int64))
                    fp.append(np.full(len(posted), key))
                    meta.append(np.full(len(posted), rare << 56 | len(own) << 28 | len(posted)))
                if token:
                    yield {"token": np.concatenate(token), "fp": np.concatenate(fp), "meta": np.concatenate(meta)}

    return map_arrow(docs.select(utf8("text").alias("text")), run, "token long, fp long, meta long")


def _shared(postings: DataFrame) -> DataFrame:
    """Postings of shingles that two classes or more have, each with the first class of its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last = lead = None  # the row before, and the first of its list: token, fp, meta
        waiting = False  # the lead is not given out yet, nothing has followed it
        for batch in batches:
            rows = np.stack([np.asarray(c, np.int64) for c in batch.columns])
            if last is not None:
                rows = np.concatenate([last[:, None], rows], 1)
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
            first = np.ones(rows.shape[1], bool)
            first[1:] = rows[0, 1:] != rows[0, :-1]
            if last is not None:
                new[0] = False
            first, rows = first[new | first], rows[:, new | first]
            leads = rows[:, np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
            if last is not None:
                own = np.cumsum(first) == 1
                leads[:, own] = lead[:, None]
            followed = np.append(~first[1:], False)
            give = ~first | followed
            if last is not None:  # row 0 stands for the list that was open
                give[0] = False
                if waiting and followed[0]:
                    yield _listed(lead[:, None], lead[:, None])
            if give.any():
                yield _listed(rows[:, give], leads[:, give])
            open_before = last is not None and len(first) == int((np.cumsum(first) == 1).sum())
            waiting = (waiting and len(first) == 1) if open_before else bool(first[-1])
            last, lead = rows[:, -1].copy(), leads[:, -1].copy()

    schema = "token long, fp long, meta long, lead long, lead_meta long"
    ordered = postings.repartition("token").sortWithinPartitions("token", "meta", "fp")
    return stored(map_arrow(ordered, run, schema))


def _listed(rows: np.ndarray, leads: np.ndarray) -> dict:
    return dict(zip(("token", "fp", "meta", "lead", "lead_meta"), (*rows, *leads[1:]), strict=True))


def _set_size(meta: str) -> Column:
    return F.shiftright(meta, 28).bitwiseAND(F.lit(_SIZE))


def _prefix_size(meta: str) -> Column:
    return F.col(meta).bitwiseAND(F.lit(_SIZE))


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    small, large = F.least(_set_size(a), _set_size(b)), F.greatest(_set_size(a), _set_size(b))
    return small * 100 >= large * percent


def _overlap(a: str, b: str, percent: int) -> Column:
    """Shingles that a similar pair shares at least."""
    return F.ceil((_set_size(a) + _set_size(b)) * percent / (100 + percent) - 1e-6)


def _difference(a: str, b: str, percent: int) -> Column:
    return (_set_size(a) + _set_size(b) - 2 * _overlap(a, b, percent)).alias("most")


def _demanded(a: str, b: str, percent: int) -> Column:
    """How many posted shingles a similar pair shares at least.

    Where the shorter prefix ends, both have posted all they share so far; what is left of that set
    bounds the rest of the overlap.
    """
    left = F.least(_prefix_size(a) - _set_size(a), _prefix_size(b) - _set_size(b))
    return F.greatest(F.lit(1), _overlap(a, b, percent) + left)


def _fetched(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """fp and shingles of the wanted classes, read from one document of each."""
    ids = stored(classes.join(wanted, "fp").select("rep", "at", "fp"))
    small = ids.count() <= BROADCAST_ROWS
    named, nameless = (F.broadcast(i) if small else i for i in (ids.filter("rep is not null"), ids.filter("rep is null")))
    rows = docs.select(F.col("doc_id").alias("rep"), utf8("text").alias("text"), F.xxhash64("text").alias("at"))
    # Rows that share an id, were it all of them, meet the class of their own text only.
    texts = rows.join(named, ["rep", "at"]).select("text", "fp")
    if not ids.filter("rep is null").isEmpty():  # no row of these classes has an id
        others = rows.filter("rep is null").drop("rep").join(nameless.drop("rep"), "at")
        texts = texts.unionAll(others.dropDuplicates(["at"]).select("text", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for words in slices(batch.column(0), SPACED):
                own = shingle_sets(words, k)
                fps = batch.column(1).slice(words.row, len(own)).to_pylist()
                # Another text may have the same hash.
                kept = [(fp, s.tobytes()) for fp, s in zip(fps, own, strict=True) if fingerprint(s) == fp]
                yield {"fp": [fp for fp, _ in kept], "shingles": [s for _, s in kept]}

    sets = stored(map_arrow(texts, run, "fp long, shingles binary"))
    again = stored(sets.groupBy("fp").count().filter("count > 1").select("fp"))
    if again.isEmpty():
        return sets
    # Rows repeated with id and text; each would double the pairs of its class.
    once = sets.join(again, "fp", "left_semi").dropDuplicates(["fp"])
    return stored(without(sets, again, "fp").unionByName(once))


def _possible(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The pairs (a, b, most), ``most`` being how much similar ones may differ, that bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            most, x, y = batch["most"].to_pylist(), batch["x"], batch["y"]
            kept = pa.array([differing(x[i].as_buffer(), y[i].as_buffer()) <= m for i, m in enumerate(most)], pa.bool_())
            yield {"a": batch["a"].filter(kept), "b": batch["b"].filter(kept)}

    joined = pairs.join(bitmaps.select(F.col("fp").alias("a"), F.col("parity").alias("x")), "a").join(
        bitmaps.select(F.col("fp").alias("b"), F.col("parity").alias("y")), "b"
    )
    return stored(map_arrow(joined.select("a", "b", "most", "x", "y"), run, "a long, b long"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            linked = []
            for i in range(batch.num_rows):  # sets are read where they are
                x, y = (np.frombuffer(batch[c][i].as_buffer(), np.uint64) for c in ("x", "y"))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[at] == x))
                linked.append((100 + percent) * both >= percent * (len(x) + len(y)))
            kept = pa.array(linked, pa.bool_())
            yield {"a": batch["a"].filter(kept), "b": batch["b"].filter(kept)}

    joined = pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return map_arrow(joined.select("a", "b", "x", "y"), run, "a long, b long")


def possible_pairs(n: np.ndarray, groups: np.ndarray, bitmaps: list[bytes], percent: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs of different groups, and sides if given, that sizes and parity bitmaps do not rule out."""
    order = np.argsort(n, kind="stable")  # bitmaps grow with the sizes of their sets
    n, groups = n[order], groups[order]
    bits = np.asarray([len(bitmaps[k]) for k in order.tolist()])
    begin = np.flatnonzero(np.append(True, bits[1:] != bits[:-1]))
    ends = np.append(begin[1:], len(bits))
    words = [np.frombuffer(b"".join(bitmaps[k] for k in order[a:b].tolist()), np.uint64).reshape(b - a, -1) for a, b in zip(begin, ends, strict=True)]
    level = np.repeat(np.arange(len(begin)), ends - begin)
    low = np.searchsorted(100 * n, percent * n)  # the first place whose set is not too small
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(len(n)):
        own = words[level[at]][at - begin[level[at]]]
        for k in range(level[min(low[at], at)], level[at] + 1):
            a, b = max(low[at], begin[k]), min(at, ends[k])
            if a >= b:
                continue
            js = a + np.flatnonzero(groups[a:b] != groups[at])
            if side is not None:
                js = js[side[order[js]] != side[order[at]]]
            if not len(js):
                continue
            folded = np.bitwise_xor.reduce(own.reshape(-1, words[k].shape[1]), 0)
            total = n[js] + n[at]
            most = total + 2 * (-percent * total // (100 + percent))  # less twice the least overlap, rounded up
            js = js[np.bitwise_count(words[k][js - begin[k]] ^ folded).sum(1, dtype=np.int64) <= most]
            if len(js):
                found.append((np.full(len(js), order[at]), order[js]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _screened(lists: DataFrame, bitmaps: DataFrame, percent: int, rows_each: int, pairs_each: int) -> DataFrame:
    """What bitmaps leave of long lists (token, fp, meta, group): pairs (a, b), or members (token, fp) where pairs are many."""
    rows = lists.join(bitmaps.select("fp", "parity"), "fp")
    # Lists of the same classes, as the shingles of one passage have, are looked through once.
    same = [F.count("*").alias("size"), F.sum(F.shiftright(F.xxhash64("fp"), 24)).alias("sum"), F.bit_xor("fp").alias("xor")]
    blocks = F.ceil(F.greatest(F.count("*") / rows_each, F.sum(_set_size("meta") / 2) / BLOCK_BYTES)).alias("blocks")
    counts = lists.groupBy("token").agg(blocks, *same)
    counts = counts.groupBy("size", "sum", "xor").agg(F.min(F.struct("token", "blocks")).alias("list"))
    rows = rows.join(counts.select("list.*"), "token").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("token", "fp", _set_size("meta").alias("n"), "group", "parity", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        token, i, j = key
        fp = part["fp"].to_numpy()
        side = part["own"].to_numpy() if i != j else None
        x, y = possible_pairs(part["n"].to_numpy(), part["group"].to_numpy(), part["parity"].tolist(), percent, side)
        if len(x) <= pairs_each * len(fp):
            return pd.DataFrame({"token": 0, "a": np.minimum(fp[x], fp[y]), "b": np.maximum(fp[x], fp[y])})
        left = fp[np.unique(np.concatenate([x, y]))]
        return pd.DataFrame({"token": token, "a": left, "b": pd.Series([None] * len(left), dtype="Int64")})

    found = rows.groupBy("token", "i", "j").applyInPandas(run, "token long, a long, b long")
    return stored(found.distinct())


def similar_forest(fps: np.ndarray, groups: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all similar sets of different groups: a spanning forest of them."""
    n = len(sets)
    sizes = np.asarray([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(n, dtype=np.int32), sizes)[order]
    del order
    same = values[1:] == values[:-1]
    common = np.append(same, False) | np.append(False, same)  # shingles of one set only are left out
    column = np.cumsum(np.append(True, ~same)[common]) - 1
    owner = owner[common]
    del values, same, common
    shared = np.zeros((n, n), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, 512):
        low, high = np.searchsorted(column, [a, a + 512])
        block = np.zeros((n, 512), np.float32)
        block[owner[low:high], column[low:high] - a] = 1
        shared += block @ block.T
    linked = np.empty((n, n), bool)
    for i in range(n):
        linked[i] = (100 + percent) * shared[i].astype(np.int64) >= percent * (sizes[i] + sizes)
        linked[i] &= groups[i] != groups
    del shared
    free, edges = np.ones(n, bool), []
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        front = [root]
        while front:
            at = front.pop()
            found = np.flatnonzero(linked[at] & free)
            free[found] = False
            edges += [(int(fps[at]), int(fps[i])) for i in found]
            front += found.tolist()
    return edges


def _blocks(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within long lists (token, fp, meta, group): every two blocks of a list are one task's work."""
    weight = F.greatest(_set_size("meta") * 8, F.lit(LEAST_BYTES))
    # Lists of the same classes, as the shingles of one passage have, are compared once.
    same = [F.count("*").alias("size"), F.sum(F.shiftright(F.xxhash64("fp"), 24)).alias("sum"), F.bit_xor("fp").alias("xor")]
    counts = lists.groupBy("token").agg(F.ceil(F.sum(weight) / BLOCK_BYTES).alias("blocks"), *same)
    counts = counts.groupBy("size", "sum", "xor").agg(F.min("token").alias("token"), F.first("blocks").alias("blocks"))
    counts = stored(counts.select("token", "blocks"))
    rows = lists.join(counts, "token").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("token", "fp", "group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = rows.join(sets, "fp")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
        edges = similar_forest(part["fp"].to_numpy(), part["group"].to_numpy(), sets, percent)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return rows.groupBy("token", "i", "j").applyInPandas(run, "a long, b long")


def clusters(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, list_size: int = LIST, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) per row."""
    profiles = _profiles(docs, k, sketch_bits)
    own = profiles.filter("sketch is null").select("doc_id", "n", "fp", "parity", "at")
    # The row with the smallest id, and the hash of its own text; rows without an id come last.
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("rep"), "at")).alias("least")
    classes = own.filter("n > 0").groupBy("fp").agg(least, F.first("parity").alias("parity"))
    classes = stored(classes.select("fp", "least.rep", "least.at", "parity"))
    sketch = send(docs.sparkSession, _sketch(profiles, sketch_bits))
    shared = _shared(_postings(docs, sketch, k, percent))
    sketch.destroy()

    stars = shared.filter("fp != lead").filter(_sizes_fit("meta", "lead_meta", percent))
    stars = stars.groupBy("fp", "lead").agg(F.count("*").alias("times"), F.first("meta").alias("meta"), F.first("lead_meta").alias("lead_meta"))
    stars = stars.filter(F.col("times") >= _demanded("meta", "lead_meta", percent))
    stars = stars.select(F.col("fp").alias("a"), F.col("lead").alias("b"), _difference("meta", "lead_meta", percent))
    stars = _possible(stars, classes)
    sets = _fetched(docs, classes, stars.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), k)
    first = stored(_verified(stars, sets, percent))
    dropped(sets)

    groups = components(first).select(F.col("node").alias("fp"), "component")
    lists = shared.join(groups, "fp", "left").select("token", "fp", "meta", F.coalesce("component", "fp").alias("group"))
    lists = stored(lists)
    dropped(shared)
    open_ = lists.groupBy("token").agg(F.count("*").alias("size"), F.min("group").alias("low"), F.max("group").alias("high"))
    open_ = stored(open_.filter("low < high").select("token", "size"))
    rows = lists.join(open_, "token")
    short, long = stored(rows.filter(F.col("size") <= list_size).drop("size")), stored(rows.filter(F.col("size") > list_size).drop("size"))
    dropped(lists)
    other = short.select("token", F.col("fp").alias("b"), F.col("meta").alias("b_meta"), F.col("group").alias("b_group"))
    pairs = short.join(other, "token").filter((F.col("fp") < F.col("b")) & (F.col("group") != F.col("b_group")))
    pairs = pairs.filter(_sizes_fit("meta", "b_meta", percent))
    pairs = pairs.groupBy(F.col("fp").alias("a"), "b").agg(F.count("*").alias("times"), F.first("meta").alias("meta"), F.first("b_meta").alias("b_meta"))
    pairs = pairs.filter(F.col("times") >= _demanded("meta", "b_meta", percent))
    pairs = _possible(pairs.select("a", "b", _difference("meta", "b_meta", percent)), classes)
    left = _screened(long, classes, percent, SCREEN_ROWS, PAIRS_EACH)
    pairs = stored(pairs.unionAll(left.filter("b is not null").select("a", "b")).distinct())
    dense = stored(long.join(left.filter("b is null").select("token", F.col("a").alias("fp")), ["token", "fp"], "left_semi"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).unionAll(dense.select("fp")).distinct()
    sets = _fetched(docs, classes, stored(wanted), k)
    links = first.unionAll(_verified(pairs, sets, percent)).unionAll(_blocks(dense, sets, percent))

    label = components(links).select(F.col("node").alias("fp"), "component")
    label = stored(classes.join(label, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component")))
    least = stored(label.groupBy("component").agg(F.min("rep").alias("component_id")))
    label = stored(label.join(least, "component").select("fp", "component_id"))
    for table in (short, long, dense, sets):
        dropped(table)
    found = own.join(label, "fp", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
