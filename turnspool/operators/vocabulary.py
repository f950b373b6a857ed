"""Vocabulary: fitted by one counting job, kept as a small table, shipped as a sorted list."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnspool.functions.pieces import CHATML_RULE, TURN_END, UNK, PieceRule, split_pieces
from turnspool.operators.order import nth_least_text
from turnspool.staging import stage

# A vocabulary is broadcast, so its size is measured first: all its pieces have no more bytes.
MAX_BYTES = 256 << 20


def count_pieces(texts: DataFrame, text: Column, rule: PieceRule = CHATML_RULE) -> DataFrame:
    """``(piece, n)`` over all texts, special pieces left out.

    Counting is combined in every task before the shuffle, so a piece that makes up half of
    all text sends one row per task.
    """
    return (
        texts.select(F.explode(split_pieces(text, rule)).alias("piece"))
        .filter(~F.col("piece").isin(list(rule.marks)))
        .groupBy("piece")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows of ``(piece, n)`` with the greatest counts, ties by piece.

    No top-k: the least count that makes it is found on a histogram of counts, one short row per
    distinct count, and of the pieces with just that count the last one by its first characters.
    ``counts`` is read several times.
    """
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("_pieces"))
    from_top = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    reached = histogram.withColumn("_reached", F.sum("_pieces").over(from_top))
    border = (
        reached.filter(F.col("_reached") >= size)
        .agg(F.max_by(F.struct("n", "_pieces", "_reached"), "n").alias("at"))
        .first()["at"]
    )
    if border is None or border["_reached"] == size:
        return counts if border is None else counts.filter(F.col("n") >= border["n"])
    ties = counts.filter(F.col("n") == border["n"])
    missing = size - (border["_reached"] - border["_pieces"])
    last = nth_least_text(ties, "piece", missing, border["_pieces"])
    return counts.filter(
        (F.col("n") > border["n"]) | ((F.col("n") == border["n"]) & (F.col("piece") <= last))
    )


def fit_vocabulary(
    texts: DataFrame, text: Column, max_pieces: int, rule: PieceRule = CHATML_RULE
) -> DataFrame:
    """``(piece, id, n, is_special)``: the marks, then the ``max_pieces`` most frequent pieces.

    Counts and result are staged: the choice looks at the counts several times, and whoever uses
    a vocabulary measures it before it is fetched.
    """
    n_marks = len(rule.marks)
    if not 1 <= max_pieces < (1 << 31) - n_marks:
        raise ValueError(f"max_pieces must be positive and ids must fit an int, got {max_pieces}")
    counts = stage(count_pieces(texts, text, rule), "piece-counts")
    # One task, over the pieces that made it.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "piece")) + n_marks - 1
    learned = most_frequent(counts, max_pieces).select(
        "piece", rank.alias("id"), "n", F.lit(False).alias("is_special")
    )
    entries = [
        F.struct(
            F.lit(mark).alias("piece"),
            F.lit(i).alias("id"),
            F.lit(0).cast("bigint").alias("n"),
            F.lit(True).alias("is_special"),
        )
        for i, mark in enumerate(rule.marks)
    ]
    specials = texts.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*entries)))
    return stage(specials.unionByName(learned), "vocabulary")


def save_vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.coalesce(1).write.parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "piece string, id int, n bigint, is_special boolean"
    ).parquet(path)


@dataclass(frozen=True)
class SpecialIds:
    """Resolved special tokens: what the tokenizer settings mean in ids."""

    unk_id: int
    eos_id: int | None
    pad_id: int | None
    padding_side: str


class Codec:
    """A vocabulary of checked size, ready to be used by tasks. Its special pieces, in id order, are
    its piece rule."""

    def __init__(self, vocab: DataFrame, eos: str | None = TURN_END):
        size = vocab.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
        if size > MAX_BYTES:
            raise ValueError(
                f"the vocabulary's pieces have {size} bytes, more than {MAX_BYTES} to broadcast; "
                "encode_by_join looks them up in the table"
            )
        table = vocab.select("id", "piece", "is_special").orderBy("id").toArrow()
        pieces = table["piece"].combine_chunks()
        self.size = len(pieces)
        if not table["id"].combine_chunks().equals(pa.array(range(self.size), pa.int32())):
            raise ValueError("vocabulary ids must run from 0 without gaps")
        if pc.count_distinct(pieces).as_py() != self.size:
            raise ValueError("vocabulary holds a piece twice")
        special = table.filter(pc.field("is_special"))
        self.special_ids = dict(zip(special["piece"].to_pylist(), special["id"].to_pylist()))
        if next(iter(self.special_ids), None) != UNK:
            raise ValueError(f"the first special piece of the vocabulary is not {UNK}")
        if eos is not None and eos not in self.special_ids:
            raise ValueError(f"{eos} is not a special piece of the vocabulary")
        self.rule = PieceRule(tuple(self.special_ids))
        self.unk_id = self.special_ids[UNK]
        self.eos_id = None if eos is None else self.special_ids[eos]
        self.pieces = vocab.sparkSession.sparkContext.broadcast(pieces)

    def resolve(self, pad_token: str | None = "eos", padding_side: str = "right") -> SpecialIds:
        """``"eos"`` pads with the end piece, another name with that piece, none leaves pad unset."""
        if padding_side not in ("left", "right"):
            raise ValueError(f"padding_side must be left or right, got {padding_side!r}")
        if pad_token == "eos":
            pad_id = self.eos_id
        elif pad_token:
            if pad_token not in self.special_ids:
                raise ValueError(f"{pad_token} is not a special piece of the vocabulary")
            pad_id = self.special_ids[pad_token]
        else:
            pad_id = None
        return SpecialIds(self.unk_id, self.eos_id, pad_id, padding_side)
