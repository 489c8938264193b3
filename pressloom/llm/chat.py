"""Reply trees as training conversations.

Messages reply to messages. Iterative self-joins on ids alone follow replies to the root, doubling
the distance each time; every leaf then knows its root and the score of its branch, branches are
ranked by score, and the best of each conversation are formatted, one path as one conversation.

A turn is written ``<turn:role>``, its text and ``</turn>``, on lines of their own; in texts and roles
``\\``, ``<`` and ``>`` get a ``\\`` before them, so no text can hold a mark, and reading back is exact.
The loss mask covers the texts of assistant turns.

Null texts and roles are empty. A message whose parent is missing is a root. Messages that reply to
each other in a circle have no root and are on no path. Equal branch scores go to the longer branch,
then to the smaller leaf. Rows without a conversation id form one conversation.
``digests`` takes all rows by turn, repeated ones included. A text of any length is escaped whole. An empty table
gives no conversations, but ``digests`` still has the one it adds. Other columns of a table are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.shared import map_arrow, stored

LEARNED = "assistant"
_MARKED = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn:((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)\n</turn>\n", re.S)


def escape(text: str) -> str:
    return _MARKED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def linear(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a reply tree: each turn replies to the one before.

    Rows of the same turn follow each other by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = messages.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("id"))
    return rows.withColumn("parent", F.when(F.col("id") > 1, F.col("id") - 1)).withColumn("score", F.lit(0.0))


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, path, pos, id: the messages of the ``best`` branches of every conversation.

    ``messages``: conv_id, id (unique in its conversation), parent, score.
    """
    keys = messages.select("conv_id", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    parents = keys.select(F.col("conv_id").alias("c"), F.col("id").alias("i"))
    known = keys.join(parents, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("i")), "left")
    keys = known.select("conv_id", "id", F.col("i").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth"))
    state = stored(keys)
    most = state.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    jumps = []  # jumps[k]: from a message to its ancestor 2^k replies up
    finished, active = [state.filter("up is null")], state.filter("up is not null")
    while True:
        jumps.append(active.select("conv_id", "id", "up"))
        if active.isEmpty() or 1 << len(jumps) > 2 * most:
            break
        # Messages that have reached their root wait; the others add what their ancestor has.
        above = reduce(DataFrame.unionAll, [*finished, active]).select(
            F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("up").alias("up2"), F.col("total").alias("t2"), F.col("depth").alias("d2")
        )
        joined = active.join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("i")))
        moved = joined.select("conv_id", "id", F.col("up2").alias("up"), (F.col("total") + F.col("t2")).alias("total"), (F.col("depth") + F.col("d2")).alias("depth"))
        moved = stored(moved)
        finished.append(moved.filter("up is null"))
        active = moved.filter("up is not null")
    rooted = reduce(DataFrame.unionAll, finished)
    replied = jumps[0].select(F.col("conv_id").alias("c"), F.col("up").alias("i")).distinct()
    leaves = rooted.join(replied, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "left_anti")
    rank = Window.partitionBy("conv_id").orderBy(F.desc("total"), F.desc("depth"), "id")
    chosen = leaves.withColumn("path", F.row_number().over(rank).cast("long")).filter(F.col("path") <= best)
    found = chosen.select("conv_id", "path", "id")
    for jump in jumps[:-1]:
        jump = jump.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), "up")
        higher = found.join(jump, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")))
        found = stored(found.unionAll(higher.select("conv_id", "path", F.col("up").alias("id"))))
    depth = rooted.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("depth").alias("pos"))
    found = found.join(depth, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")))
    return found.select("conv_id", "path", "pos", "id")


def formatted(messages: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, path, pos, segment, begin, loss: the chosen paths, a row per turn.

    A conversation is its segments in order; ``begin`` is a segment's place in it, ``loss`` the part
    of the conversation that is learned (null: none). Rows come sorted, a conversation in one
    partition, so none is ever held whole.
    """
    chosen = paths(messages, best).withColumnsRenamed({"conv_id": "c", "id": "i"})
    texts = messages.select("conv_id", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(chosen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")))
    rows = rows.select("conv_id", "path", "pos", "role", "text").repartition("conv_id", "path").sortWithinPartitions("conv_id", "path", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, end = None, 0
        for batch in batches:
            segments, begins, losses = [], [], []
            for conv, path, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, path) != now:
                    now, end = (conv, path), 0
                head, body = f"<turn:{escape(role)}>\n", escape(text)
                segments.append(f"{head}{body}\n</turn>\n")
                begins.append(end)
                start = end + len(head)
                losses.append([start, start + len(body)] if role == LEARNED else None)
                end += len(segments[-1])
            yield {"conv_id": batch.column(0), "path": batch.column(1), "pos": batch.column(2), "segment": segments, "begin": begins, "loss": losses}

    return map_arrow(rows, run, "conv_id long, path long, pos long, segment string, begin long, loss array<long>")


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, path and digests of every formatted conversation, from its segments as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now = state = None
        for batch in batches:
            done = []
            for conv, path, _, segment, begin, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, path) != now:
                    if state:
                        done.append((*now, *_ended(state)))
                    now, state = (conv, path), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in _TURN.findall(segment):
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                if loss:
                    learned = unescape(segment[loss[0] - begin : loss[1] - begin])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(segment)
            yield _columns(done)
        if state:
            yield _columns([(*now, *_ended(state))])

    schema = "conv_id long, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(segments, run, schema)


def _ended(state: list) -> tuple:
    return state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _columns(rows: list[tuple]) -> dict:
    names = ("conv_id", "path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return dict(zip(names, zip(*rows, strict=True) if rows else [[]] * len(names), strict=True))


def digests(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Digests of all conversations, with one more whose texts hold marks of several templates."""
    hard = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionAll(more)
    return read_back(formatted(stored(linear(rows)))).drop("path")
