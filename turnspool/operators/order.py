"""A dense position in a global order, without sorting everything in one task."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# From the upper bits of a bigint to the lowest: at most 2**21 buckets of each bucket before.
LEVEL_WIDTHS = (21, 21, 21)


def md5_levels(digest: Column) -> list[Column]:
    """65,536 even buckets of a hex digest: one per value of its first four digits."""
    return [F.substring(digest, 1, 4)]


def long_levels(value: Column) -> list[Column]:
    """Two levels of buckets for a unique bigint.

    There are at most 2**24 upper buckets, at most 2**20 lower ones in each, and, as the values
    are unique, at most 2**20 rows in a lower bucket: no group grows with the data.
    """
    value = value.cast("bigint")
    return [F.shiftright(value, 40), F.shiftright(value, 20)]


def global_index(
    df: DataFrame,
    order: Sequence[Column],
    levels: Sequence[Column],
    within: Sequence[str] = (),
    name: str = "idx",
) -> DataFrame:
    """Add ``name``: the 0-based position of a row in ``order`` among the rows of its ``within``.

    ``levels`` are bucket expressions from coarse to fine that follow the order. Rows are sorted
    inside their finest bucket only; a running sum over the bucket sizes gives each bucket its
    start. The join back is on the columns the rows are already partitioned by.
    """
    keys = [f"_level{i}" for i in range(len(levels))]
    bucketed = df.withColumns(dict(zip(keys, levels)))
    sizes = bucketed.groupBy(*within, *keys).agg(F.count(F.lit(1)).alias("_n"))
    starts = running_starts(sizes, list(within), keys)
    inside = F.row_number().over(Window.partitionBy(*within, *keys).orderBy(*order)) - 1
    return (
        bucketed.withColumn("_inside", inside)
        .join(starts, [*within, *keys])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop(*keys, "_inside", "_start")
    )


def running_starts(sizes: DataFrame, within: list[str], keys: list[str]) -> DataFrame:
    """``(within, keys, _start)``: how many rows the buckets before each bucket hold."""
    outer, inner = within + keys[:-1], keys[-1]
    earlier = Window.partitionBy(*outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if len(keys) == 1:
        return starts.drop("_n")
    upper = sizes.groupBy(*outer).agg(F.sum("_n").alias("_n"))
    return (
        starts.join(
            running_starts(upper, within, keys[:-1]).withColumnRenamed("_start", "_base"), outer
        )
        .withColumn("_start", F.col("_start") + F.col("_base"))
        .drop("_n", "_base")
    )


def nth_least(df: DataFrame, value: str, n: int, within: str) -> dict[str, int]:
    """The ``n``-th least bigint of each group that has so many; groups are few.

    Found from coarse to fine: values are counted by their upper bits, the bucket that holds the
    n-th is split by the next bits, and so on. Counts are combined in every task and no task sees
    more than one row per bucket, so neither ``n`` nor the number of rows is in the way. The jobs
    run while the plan is made, on two columns.
    """
    bits = 63
    found: dict[str, int] = {}
    for width in LEVEL_WIDTHS:
        bits -= width
        bucket = F.shiftright(F.col(value).cast("bigint"), bits)
        rows = df
        if found:
            of_group = [
                (F.col(within) == group)
                & (F.shiftright(F.col(value).cast("bigint"), bits + width) == upper)
                for group, (upper, _) in found.items()
            ]
            rows = df.filter(functools.reduce(Column.__or__, of_group))
        wanted = F.lit(n)
        for group, (_, before) in found.items():
            wanted = F.when(F.col(within) == group, F.lit(n - before)).otherwise(wanted)
        counts = rows.groupBy(within, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy(within).orderBy("_bucket")
        reached = (
            counts.withColumn("_upto", F.sum("_n").over(upto))
            .filter(F.col("_upto") >= wanted)
            .groupBy(within)
            .agg(F.min_by(F.struct("_bucket", "_upto", "_n"), "_bucket").alias("at"))
        )
        last = {r[within]: r["at"] for r in reached.collect()}
        found = {
            group: (at["_bucket"], at["_upto"] - at["_n"] + (found[group][1] if found else 0))
            for group, at in last.items()
        }
        if not found:
            return {}
    return {group: value for group, (value, _) in found.items()}


# So few values are sorted as they are.
FEW = 100_000


def nth_least_text(df: DataFrame, value: str, n: int, count: int) -> str:
    """The ``n``-th least of a column of ``count`` strings.

    Found character by character: the strings that start as the wanted one does are counted by
    their next character. No task sorts more than FEW strings or more rows than there are
    characters.
    """
    prefix = ""
    while count > FEW:
        text = F.col(value)
        rows = df.filter(F.startswith(text, F.lit(prefix))) if prefix else df
        following = F.substring(text, len(prefix) + 1, 1)
        counts = rows.groupBy(following.alias("c")).agg(F.count(F.lit(1)).alias("n"))
        for c, count in sorted((r["c"], r["n"]) for r in counts.collect()):
            if n <= count:
                break
            n -= count
        prefix += c
        if not c:
            return prefix
    rows = df.filter(F.startswith(F.col(value), F.lit(prefix)))
    return rows.orderBy(value).limit(n).agg(F.max(value)).first()[0]
