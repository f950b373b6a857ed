"""Sizes and label counts of a prepared dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.functions.labels import active_labels
from turnspool.sources.conversations import TRAIN, VALIDATION


def split_counts(rows: DataFrame) -> DataFrame:
    """Rows per split in one row; a split without rows counts 0."""
    return rows.agg(
        F.count_if(F.col("split") == TRAIN).alias("n_train"),
        F.count_if(F.col("split") == VALIDATION).alias("n_validation"),
    )


def label_counts(prepared: DataFrame) -> DataFrame:
    """Length and active labels of every row."""
    return prepared.select(
        "row_id",
        "split",
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        active_labels(F.col("labels")).cast("bigint").alias("n_active"),
    )


def split_label_stats(prepared: DataFrame) -> DataFrame:
    """Label counts per split; ``n_without_labels`` tells how many rows teach nothing."""
    return (
        label_counts(prepared)
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_active").alias("n_active"),
            F.min("n_active").alias("min_active"),
            F.max("n_active").alias("max_active"),
            F.count_if(F.col("n_active") == 0).alias("n_without_labels"),
        )
    )


def steps_per_epoch(
    rows: DataFrame, batch_size: int, accumulation: int, world_size: int
) -> DataFrame:
    """The estimate a run prints first: whole steps that the train rows fill."""
    per_step = batch_size * accumulation * world_size
    n_train = F.count_if(F.col("split") == TRAIN).alias("n_train")
    return rows.agg(n_train).withColumn("n_steps", F.expr(f"n_train div {per_step}"))


def first_row(rows: DataFrame, split: str = TRAIN) -> DataFrame:
    """The row with the least ``row_id`` of a split.

    The id is found on the two key columns first, and filters the rows where they are read: no
    other record is gathered to show one.
    """
    of_split = rows.filter(F.col("split") == split)
    least = of_split.agg(F.min("row_id"))
    return of_split.filter(F.col("row_id") == least.scalar())


def id_prefix(prepared: DataFrame, length: int = 8) -> DataFrame:
    """The first ids of every row with a mask of ones: what a forward check is fed."""
    head = F.slice("input_ids", 1, length)
    return prepared.select(
        "row_id", head.alias("input_ids"), F.array_repeat(F.lit(1), F.size(head)).alias("mask")
    )
