"""Chat records from a table with one row per turn.

The turn table is ``(conv_id, turn, role, text)``, turns unique within a conversation. A chat
record is one row ``(row_id, split, messages)``; its split is decided by the conversation id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN, VALIDATION = "train", "validation"
VALIDATION_EVERY = 20

# Turns are counted and cut in blocks of 2**TURN_BLOCK_BITS turn numbers. Turns are unique, so
# no block holds more rows than that.
TURN_BLOCK_BITS = 10
# A list of blocks to drop is broadcast up to this many rows (two bigints each).
BROADCAST_ROWS = 1_000_000


def split_of(row_id: Column) -> Column:
    return F.when(row_id % VALIDATION_EVERY == 0, F.lit(VALIDATION)).otherwise(F.lit(TRAIN))


def turn_rows(turns: DataFrame) -> DataFrame:
    """The turn table with the record columns: ``(row_id, split, turn, role, content)``."""
    return turns.select(
        F.col("conv_id").alias("row_id"),
        split_of(F.col("conv_id")).alias("split"),
        "turn",
        "role",
        F.col("text").alias("content"),
    )


def turn_block(turn: Column) -> Column:
    return F.shiftright(turn.cast("bigint"), TURN_BLOCK_BITS)


def blocks_beyond(turns: DataFrame, keep_turns: int) -> DataFrame:
    """``(row_id, block)`` of all turn blocks that start behind ``keep_turns`` earlier turns.

    Reads two columns only. Blocks are counted before the running sum, so even a conversation
    that holds a third of all turns puts a thousandth of its rows, two numbers each, in one task.
    """
    counts = turns.groupBy("row_id", turn_block(F.col("turn")).alias("block")).agg(
        F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("row_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        counts.withColumn("before", F.sum("n").over(earlier))
        .filter(F.col("before") >= keep_turns)
        .select("row_id", "block")
    )


def turn_span(turns: DataFrame) -> int:
    """How many turn numbers the turns span; as turns are unique, none has more. One look at a
    column's range."""
    low, high = turns.agg(F.min("turn"), F.max("turn")).first()
    return 0 if low is None else high - low + 1


def drop_turns_beyond(turns: DataFrame, keep_turns: int) -> DataFrame:
    """Leave at least the first ``keep_turns`` turns of a conversation and no unbounded rest.

    Only for consumers that read no further, such as a cut to ``max_length`` pieces: a rendered
    turn is at least one piece long. What remains per conversation is under ``keep_turns`` turns
    plus one block, and one turn without role or content if it has any anywhere, so that what is
    cut off still counts for whether a conversation is usable.

    In the common case that no conversation can be too long nothing is done. Otherwise the blocks to
    drop are counted. The join is on (conversation, block), which spreads a long conversation over
    all tasks, whether the list is short enough to broadcast or not.
    """
    if turn_span(turns) <= keep_turns:
        return turns
    beyond = blocks_beyond(turns, keep_turns)
    if beyond.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        beyond = F.broadcast(beyond)
    marked = turns.withColumn("block", turn_block(F.col("turn")))
    kept = marked.join(beyond, ["row_id", "block"], "left_anti").drop("block")
    return kept.unionByName(unusable_turns(turns))


def unusable_turns(turns: DataFrame) -> DataFrame:
    """One turn without role or content of each conversation that has such; combined map-side."""
    no_text = F.lit(None).cast("string")
    return (
        turns.filter(F.col("role").isNull() | F.col("content").isNull())
        .groupBy("row_id", "split")
        .agg(F.max("turn").alias("turn"))
        .select("row_id", "split", "turn", no_text.alias("role"), no_text.alias("content"))
    )


def in_turn_order() -> Column:
    """The messages of a group of turns."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    return F.transform(
        ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
    )


def gather_messages(turns: DataFrame, *group: str) -> DataFrame:
    """Group turn rows to ``messages``, in turn order."""
    return turns.groupBy(*group).agg(in_turn_order().alias("messages"))


def gather_blocks(turns: DataFrame) -> DataFrame:
    """``(row_id, messages)`` of conversations of any length: first the turns of each block are put
    in order, spread over all tasks, then the blocks of each conversation."""
    blocks = gather_messages(
        turns.withColumn("block", turn_block(F.col("turn"))), "row_id", "block"
    )
    in_order = F.array_sort(F.collect_list(F.struct("block", "messages")))
    return blocks.groupBy("row_id").agg(F.flatten(in_order["messages"]).alias("messages"))


def chat_records(turns: DataFrame, max_length: int | None = None) -> DataFrame:
    """``(row_id, split, messages)``, one row per conversation.

    For a consumer that cuts to ``max_length`` pieces one message more than that decides
    everything: the cut text, and that a longer prompt leaves no label. So no conversation is
    gathered beyond it, however long it is. Without ``max_length`` whole conversations are
    gathered.
    """
    rows = turn_rows(turns)
    if max_length is not None:
        gathered = gather_messages(drop_turns_beyond(rows, max_length + 1), "row_id")
    elif turn_span(rows) <= 1 << TURN_BLOCK_BITS:
        gathered = gather_messages(rows, "row_id")
    else:
        gathered = gather_blocks(rows)
    return gathered.select("row_id", split_of(F.col("row_id")).alias("split"), "messages")


def conversation_sizes(turns: DataFrame) -> DataFrame:
    """``(row_id, split, n_turns)``, counted without gathering anything."""
    counts = turn_rows(turns).groupBy("row_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return counts.select("row_id", split_of(F.col("row_id")).alias("split"), "n_turns")
