"""Train and validation as one table with a ``split`` column, and the record cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnspool.operators.order import nth_least
from turnspool.sources.conversations import TRAIN, VALIDATION


def assemble_splits(train: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """One table from one table per split; validation may be missing."""
    rows = train.withColumn("split", F.lit(TRAIN))
    if validation is None:
        return rows
    return rows.unionByName(validation.withColumn("split", F.lit(VALIDATION)))


def cap_records(df: DataFrame, cap: int | None) -> DataFrame:
    """The first ``cap`` records of every split, in ``row_id`` order; none when ``cap`` <= 0.

    The id of the last one is found on counts of ids (``nth_least``); the records themselves are
    only filtered, where they are read. Ids are unique in a split; of equal ones all stay.
    """
    if cap is None:
        return df
    if cap <= 0:
        return df.limit(0)
    last = nth_least(df.select("row_id", "split"), "row_id", cap, within="split")

    def inside(split: str) -> Column:
        among = F.col("row_id") <= last[split] if split in last else F.lit(True)
        return (F.col("split") == split) & among

    return df.filter(inside(TRAIN) | inside(VALIDATION))
