"""Chat files to records: train and, if there is one, validation, read strictly or tolerantly.

What cannot become a record is set aside in a table of its own, with the place it comes from and the
reason, so that a load neither stops at it nor loses it silently.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnspool.functions.template import is_usable
from turnspool.sources.conversations import TRAIN, VALIDATION
from turnspool.sources.files import (
    PLACE,
    add_row_ids,
    read_chat_jsonl,
    read_until,
    scan_files,
)
from turnspool.sources.splits import cap_records
from turnspool.sources.tolerant import TolerantScan, read_tolerant

NO_MESSAGES = "no usable messages"
REJECTS = ("split", *PLACE, "text", "reason")

Paths = str | Sequence[str]


@dataclass(frozen=True)
class ChatFiles:
    """``records`` is ``(row_id, split, messages)``, ids in file order, all of them usable.

    ``rejects`` is ``(split, file, block, line, text, reason)``.
    """

    records: DataFrame
    rejects: DataFrame


def read_chat_files(
    spark: SparkSession,
    train: Paths,
    validation: Paths | None = None,
    tolerant: bool = False,
    cap: int | None = None,
) -> ChatFiles:
    """Read one or two splits.

    Strictly, each line is an object and a line that is none stops the job; tolerantly, it is set
    aside. Either way objects without usable messages are set aside. With ``cap``, the first so many
    objects of each split count, usable or not, and files behind them are not opened.
    """
    read = _tolerant if tolerant else _strict
    paths = {TRAIN: train} | ({} if validation is None else {VALIDATION: validation})
    parts = [read(spark, path, split, cap) for split, path in paths.items()]
    objects, rejects = (functools.reduce(DataFrame.unionByName, side) for side in zip(*parts))
    objects = cap_records(objects, cap)
    usable = is_usable(F.col("messages"))
    unusable = objects.filter(~usable).withColumn("reason", F.lit(NO_MESSAGES))
    return ChatFiles(
        objects.filter(usable).select("row_id", "split", "messages"),
        rejects.select(*REJECTS).unionByName(unusable.select(*REJECTS)),
    )


def _placed(objects: DataFrame, files: Sequence[str], split: str) -> DataFrame:
    """Row ids beside the places, and the split."""
    return add_row_ids(objects, files, keep_place=True).withColumn("split", F.lit(split))


def _strict(
    spark: SparkSession, path: Paths, split: str, cap: int | None
) -> tuple[DataFrame, DataFrame]:
    def read(names: Paths) -> DataFrame:
        return read_chat_jsonl(spark, names).withColumn("text", F.to_json(F.struct("messages")))

    objects = read(path) if cap is None else read_until(spark, path, cap, read)
    nothing = spark.createDataFrame(
        [], "split string, file string, block bigint, line bigint, text string, reason string"
    )
    return _placed(objects, scan_files(spark, path), split), nothing


def _tolerant(
    spark: SparkSession, path: Paths, split: str, cap: int | None
) -> tuple[DataFrame, DataFrame]:
    scans: list[TolerantScan] = []

    def read(names: Paths) -> DataFrame:
        scans.append(read_tolerant(spark, names))
        return scans[-1].parsed()

    objects = read(path) if cap is None else read_until(spark, path, cap, read)
    rejects = functools.reduce(DataFrame.unionByName, [scan.rejects() for scan in scans])
    files = [name for scan in scans for name in scan.files]
    return _placed(objects, files, split), rejects.withColumn("split", F.lit(split))
