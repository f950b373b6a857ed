"""Batch plans: which row is in which batch of which epoch, and how far it is padded.

The plan works on lean rows (ids and counts). Token arrays join it once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnspool.functions.labels import IGNORE
from turnspool.operators.order import global_index, long_levels, md5_levels


def expand_epochs(rows: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch, numbered from 0."""
    if epochs < 1:
        raise ValueError(f"{epochs} epochs")
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def shuffle_key(seed: int, epoch: Column, row_id: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), row_id.cast("string")))


def seeded_order(rows: DataFrame, seed: int) -> DataFrame:
    """Add ``idx``: the position in the seeded order of the row's epoch."""
    keyed = rows.withColumn("_key", shuffle_key(seed, F.col("epoch"), F.col("row_id")))
    return global_index(
        keyed,
        order=[F.col("_key"), F.col("row_id")],
        levels=md5_levels(F.col("_key")),
        within=["epoch"],
    ).drop("_key")


def stored_order(rows: DataFrame) -> DataFrame:
    """Add ``idx``: the position in ``row_id`` order within the epoch, as evaluation reads rows."""
    return global_index(
        rows, order=[F.col("row_id")], levels=long_levels(F.col("row_id")), within=["epoch"]
    )


def assign_batches(rows: DataFrame, batch_size: int) -> DataFrame:
    return rows.withColumn("batch_id", F.expr(f"idx div {int(batch_size)}"))


def assign_steps(
    rows: DataFrame, rows_in_epoch: int, batch_size: int, accumulation: int, world_size: int
) -> DataFrame:
    """Add ``step``: the optimizer step, counted over all epochs from 0.

    The last step of an epoch may be short; every epoch has as many steps as the first.
    """
    per_step = batch_size * accumulation * world_size
    steps_in_epoch = -(-rows_in_epoch // per_step)
    earlier = F.col("epoch").cast("bigint") * steps_in_epoch
    return rows.withColumn("step", earlier + F.expr(f"idx div {per_step}"))


def step_manifest(
    rows: DataFrame, logging_steps: int, eval_steps: int, save_steps: int
) -> DataFrame:
    """One row per step: sizes, padded size, and what the trainer does after it.

    ``rows`` carries ``step, epoch, batch_id, n_tokens, n_active``. The flags look at the number
    of finished steps, ``step + 1``.
    """
    batches = rows.groupBy("step", "epoch", "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_active").alias("n_active"),
        (F.count(F.lit(1)) * F.max("n_tokens")).alias("n_padded"),
    )
    done = F.col("step") + 1
    return (
        batches.groupBy("step", "epoch")
        .agg(
            F.count(F.lit(1)).alias("n_batches"),
            *[F.sum(c).alias(c) for c in ("n_rows", "n_tokens", "n_active", "n_padded")],
        )
        .withColumns(
            {
                "logs": done % logging_steps == 0,
                "evaluates": done % eval_steps == 0,
                "saves": done % save_steps == 0,
            }
        )
    )


def checkpoint_step(checkpoint: str) -> Column:
    """The number of finished steps that a checkpoint folder name tells."""
    return F.regexp_extract(F.lit(checkpoint), r"checkpoint-(\d+)/*$", 1).cast("bigint")


def remaining_rows(rows: DataFrame, checkpoint: str | None) -> DataFrame:
    """What a resumed run still has to read: a checkpoint has used the steps below its number."""
    return rows if checkpoint is None else rows.filter(F.col("step") >= checkpoint_step(checkpoint))


def padded_width(rows: DataFrame) -> DataFrame:
    """Add ``width``: the longest row of the batch. The groups are as small as a batch."""
    batch = Window.partitionBy("epoch", "batch_id")
    return rows.withColumn("width", F.max("n_tokens").over(batch))


def pad(values: Column, filler: Column, width: Column, side: str) -> Column:
    fill = F.array_repeat(filler, (width - F.size(values)).cast("int"))
    return F.concat(values, fill) if side == "right" else F.concat(fill, values)


FILLERS = ("input_ids", "attention_mask", "labels")


def with_tokens(plan: DataFrame, tokens: DataFrame, *keep: str) -> DataFrame:
    """Rows of the plan with the width of their batch and their token arrays, not padded yet.

    The widths are found on the lean plan, so the token arrays are shuffled once, by row.
    """
    lean = padded_width(plan.select("epoch", "batch_id", "row_id", "n_tokens", *keep))
    return lean.join(tokens.select("row_id", *FILLERS), "row_id")


def fillers_of(pad_id: int | None) -> dict[str, int]:
    if pad_id is None:
        raise ValueError("no padding id")
    return dict(zip(FILLERS, (pad_id, 0, IGNORE)))


def padded(rows: DataFrame, fillers: dict[str, int], side: str, *keep: str) -> DataFrame:
    """Ids, mask and labels of every row padded to its ``width``. A map."""
    width = F.col("width")
    return rows.select(
        "epoch",
        "batch_id",
        "row_id",
        *keep,
        width,
        *[pad(F.col(c), F.lit(f), width, side).alias(c) for c, f in fillers.items()],
    )


def pad_batches(plan: DataFrame, tokens: DataFrame, pad_id: int, side: str = "right") -> DataFrame:
    """Pad ids, mask and labels of every row to the width of its batch."""
    fillers = fillers_of(pad_id)
    return padded(with_tokens(plan, tokens), fillers, side)


def write_batches(
    plan: DataFrame, tokens: DataFrame, path: str, pad_id: int, side: str = "right"
) -> None:
    """Padded batches as files in the order in which a trainer takes them, a folder per epoch.

    ``plan`` has ``idx``, the position in the epoch. Rows are dealt by ranges of batches, so a batch
    is in one file, the files of an epoch follow each other by name, and a reader needs no shuffle.
    Rows are padded after they are dealt and sorted: no filler is ever shuffled.
    """
    fillers = fillers_of(pad_id)
    rows = with_tokens(plan, tokens, "idx")
    dealt = rows.repartitionByRange("epoch", "batch_id").sortWithinPartitions("epoch", "idx")
    padded(dealt, fillers, side, "idx").write.partitionBy("epoch").parquet(path)
