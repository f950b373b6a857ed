"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The input is cut in blocks of at most 65,536 rows. How many rows of each block go to each shard is
drawn exactly as a uniform shuffle of all rows would have it (a multivariate hypergeometric row
for each block, given what earlier blocks left over). Each block is permuted on its own, its first
rows go to shard 0, the next to shard 1, and so on; each shard is permuted again on arrival.

Nulls, empty texts, repeated rows and extra columns are carried as they are; rows are told apart by
their place, not by any key, so no value can make a block or a shard large. Columns of the input
named ``shard`` or ``slot`` are replaced. An empty input gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnspool.operators.order import global_index
from turnspool.staging import stage

BLOCK_BITS = 16
GROUPS = 1024
SLOT_BUCKET = 8192
# numpy draws exactly up to this population.
NUMPY_LIMIT = 1_000_000_000


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Row counts that differ by at most one."""
    return rows // shards + (np.arange(shards) < rows % shards)


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` rows taken from ``good + bad`` are good."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good < NUMPY_LIMIT and bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws))
    # Inversion over the values within 12 deviations of the mean; weights by their ratios.
    total = good + bad
    mean = draws * good / total
    spread = 12 * np.sqrt(mean * (bad / total) * max(total - draws, 1) / total) + 50
    low = max(0, draws - bad, int(mean - spread))
    high = min(good, draws, int(mean + spread))
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1]))


def draw_rows(counts: list[int], capacity: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A random matrix with these row sums; its column sums are ``capacity``."""
    left = [int(c) for c in capacity]
    matrix = np.zeros((len(counts), len(left)), np.int64)
    for i, count in enumerate(counts):
        open_rows, want = sum(left), int(count)
        for j, room in enumerate(left):
            open_rows -= room
            matrix[i, j] = taken = hypergeometric(room, open_rows, want, rng)
            want -= taken
        left = [room - int(taken) for room, taken in zip(left, matrix[i])]
    return matrix


def communication_matrix(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(block, upto)`` from ``(block, n)``: upto[j] rows of the block go to shards up to j.

    Drawn in two levels: for at most 1,024 groups of blocks on the driver, then for the blocks of
    each group in a task.
    """
    spark = blocks.sparkSession
    grouped = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(GROUPS)))
    sums = sorted(grouped.groupBy("group").agg(F.sum("n").alias("n")).collect())
    capacity = shard_sizes(sum(r["n"] for r in sums), shards)
    drawn = draw_rows([r["n"] for r in sums], capacity, np.random.default_rng(seed))
    shares = spark.createDataFrame(
        [(int(r["group"]), [int(x) for x in row]) for r, row in zip(sums, drawn)],
        "group bigint, capacity array<bigint>",
    )

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        rng = np.random.default_rng([seed, int(rows["group"].iloc[0])])
        matrix = draw_rows(list(rows["n"]), np.asarray(rows["capacity"].iloc[0]), rng)
        return pd.DataFrame({"block": rows["block"], "upto": list(np.cumsum(matrix, axis=1))})

    # At most GROUPS rows of one number per shard.
    joined = grouped.join(F.broadcast(shares), "group")
    return joined.groupBy("group").applyInPandas(draw, "block bigint, upto array<bigint>")


def random_key(seed: int, row: Column) -> Column:
    return F.xxhash64(F.lit(seed), row)


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows of ``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in it)."""
    placed = stage(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot")]).alias(
                "row"
            ),
            F.monotonically_increasing_id().alias("place"),
        ),
        "shard-input",
    ).withColumn("block", F.shiftright("place", BLOCK_BITS))
    blocks = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    matrix = communication_matrix(blocks, shards, seed)
    local = Window.partitionBy("block").orderBy(random_key(seed, F.col("place")), "place")
    sent = (
        placed.withColumn("rank", F.row_number().over(local) - 1)
        .join(matrix, "block")
        .withColumn("shard", F.size(F.filter("upto", lambda n: n <= F.col("rank"))))
        .select("row", "place", "shard", random_key(seed + 1, F.col("place")).alias("key"))
    )
    rows = placed.count()
    bits = max(0, int(np.ceil(np.log2(max(1, rows / shards / SLOT_BUCKET)))))
    level = F.shiftright("key", 64 - bits) if bits else F.lit(0).cast("bigint")
    indexed = global_index(
        sent, order=[F.col("key"), F.col("place")], levels=[level], within=["shard"], name="slot"
    )
    return indexed.select("row.*", F.col("shard").cast("int").alias("shard"), "slot")


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder for each shard, its files in slot order."""
    (
        assigned.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
