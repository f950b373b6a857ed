"""Text to ids and back, row by row in place: no token is ever shuffled.

Only a vocabulary too large to be broadcast is looked up by a join, of the distinct pieces of some
rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from turnspool.functions.pieces import PieceRule, split_pieces
from turnspool.operators.vocabulary import Codec
from turnspool.staging import stage

# A join looks up the pieces of 2^BATCH_BITS rows at once; a row of more pieces than this goes alone.
BATCH_BITS = 8
BATCH_PIECES = 4096


def lookup_ids(pieces: Column, codec: Codec) -> Column:
    """``array<int>`` for ``array<string>``; a piece the vocabulary lacks becomes the unk id.

    One vectorised hash probe per Arrow batch against the broadcast vocabulary, whose entries
    lie in id order, so the position of the hit is the id.
    """
    vocab, unk_id = codec.pieces, codec.unk_id

    @F.arrow_udf("array<int>")
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocab.value
        for column in batches:
            found = pc.fill_null(pc.index_in(column.flatten(), value_set=known), unk_id)
            yield _relist(column, found.cast(pa.int32()))

    return lookup(F.coalesce(pieces, F.array().cast("array<string>")))


def encode(text: Column, codec: Codec, max_length: int | None = None) -> Column:
    """Ids of ``text``, cut to the first ``max_length``."""
    return lookup_ids(truncate(split_pieces(text, codec.rule), max_length), codec)


def encode_by_join(
    df: DataFrame,
    text: Column,
    vocab: DataFrame,
    max_length: int | None = None,
    name: str = "input_ids",
) -> DataFrame:
    """``df`` with the ids of ``text`` as column ``name``, for a vocabulary of any size.

    The same ids as ``encode``, but the vocabulary stays a table. Rows are put in batches by their
    place; a batch asks for each of its pieces once, so a piece that is in every row brings one row
    per batch to the join, and no token is shuffled on its own. Rows and pieces are staged, so that
    places hold when an executor is lost. A null text has no ids.
    """
    marks = vocab.filter("is_special").orderBy("id").collect()
    rule, unk_id = PieceRule(tuple(m["piece"] for m in marks)), marks[0]["id"]
    kept = [c for c in df.columns if c != name]
    pieces = F.coalesce(truncate(split_pieces(text, rule), max_length), F.array())
    rows = stage(
        df.select(
            F.struct(F.lit(0).alias(""), *[F.col(f"`{c}`") for c in kept]).alias("row"),
            pieces.cast("array<string>").alias("pieces"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "pieces",
    )
    alone = F.size("pieces") > BATCH_PIECES
    batch = F.when(alone, -1 - F.col("place")).otherwise(F.shiftright("place", BATCH_BITS))
    rows = rows.select("row", "pieces", batch.alias("batch"))
    asked = rows.select(F.col("batch").alias("by"), F.explode(F.array_distinct("pieces")).alias("piece")).distinct()
    found = asked.join(vocab.select("piece", "id"), "piece").select("by", "piece", "id")

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        column = rows["pieces"].combine_chunks()
        at = pc.index_in(column.flatten(), value_set=found["piece"].combine_chunks())
        ids = pc.fill_null(pc.take(found["id"].combine_chunks(), at), unk_id)
        return pa.table({"row": rows["row"], "ids": _relist(column, ids.cast(pa.int32()))})

    schema = StructType().add(rows.schema["row"]).add("ids", ArrayType(IntegerType()))
    looked_up = rows.groupBy("batch").cogroup(found.groupBy("by")).applyInArrow(look_up, schema)
    return looked_up.select(
        *[F.col("row").getField(c).alias(c) for c in kept], F.col("ids").alias(name)
    )


def truncate(pieces: Column, max_length: int | None) -> Column:
    return pieces if max_length is None else F.slice(pieces, F.lit(1), F.lit(max_length))


def decode(ids: Column, codec: Codec, skip_special_tokens: bool = True) -> Column:
    """The text of ``array<int>``; ids outside the vocabulary add nothing."""
    vocab, size = codec.pieces, codec.size
    hidden = sorted(codec.special_ids.values()) if skip_special_tokens else []

    @F.arrow_udf("string")
    def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelling = pc.if_else(
            pc.is_in(pa.array(range(size), pa.int32()), value_set=pa.array(hidden, pa.int32())),
            "",
            vocab.value,
        )
        for column in batches:
            flat = column.flatten()
            inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, size))
            words = pc.take(spelling, pc.if_else(inside, flat, None))
            yield pc.binary_join(_relist(column, pc.fill_null(words, "")), "")

    return spell(F.coalesce(ids, F.array().cast("array<int>")))


def _relist(column: pa.ListArray, values: pa.Array) -> pa.ListArray:
    """``values`` cut into the same lists as ``column``, which holds no null list."""
    offsets = pc.subtract(column.offsets, column.offsets[0])
    return pa.ListArray.from_arrays(offsets.cast(pa.int32()), values)
