"""Chat files: strict JSONL, prompt files, line counts, and row ids in file order."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnspool.staging import stage

MESSAGES = "array<struct<role:string,content:string>>"
CHAT_SCHEMA = f"messages {MESSAGES}"

# The parser's own limit is 20 MB; a string is as long as it is.
WHOLE_STRINGS = {"maxStringLen": str((1 << 31) - 1)}

# A scan cuts a file in blocks; a row's place is (file, block, line).
PLACE = ("file", "block", "line")
LINE_BITS = 33
# A row id is the rank of its file and, in these bits, its place: first byte of the block plus line.
FILE_BITS = 42
# So many file names with their ranks are broadcast at once.
BROADCAST_FILES = 100_000
# Packs several blocks of a file in one scan task, where lines would be counted on.
PACKED_BLOCKS = "spark.sql.files.maxPartitionNum"


def scan_place() -> list[Column]:
    """Where a scanned row stands. To be taken on the scan itself, before any shuffle."""
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().bitwiseAND((1 << LINE_BITS) - 1).alias("line"),
    ]


def read_chat_jsonl(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(messages, file, block, line)``; one object per line, a broken line stops the job.

    The schema is fixed: there is no inference pass, and other fields are not parsed.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(CHAT_SCHEMA).option("mode", "FAILFAST").options(**WHOLE_STRINGS)
    rows = reader.json(paths)
    return rows.select("messages", *scan_place())


def plain_uri(path: Column) -> Column:
    """A path as a scan's rows and its listing both spell it, but for their slashes in front."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def scan_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files of a scan in order, from its own listing."""
    return sorted(spark.read.text([path] if isinstance(path, str) else list(path)).inputFiles())


def add_row_ids(
    rows: DataFrame, files: Sequence[str] | None = None, keep_place: bool = False
) -> DataFrame:
    """Add ``row_id``, unique and in file order, for ``(file, block, line)``, which may be kept.

    ``files`` are all files of the scan (``scan_files``); without them their names are looked up in
    ``rows``, which is then read once more. The id is arithmetic on the row: a line has at least one
    byte, so first byte of the block plus line number grows along a file, and the rank of the file
    stands above it. Only file names are broadcast, so many at a time; rows of more files than that
    are taken file range by file range. Rows are neither sorted nor shuffled.
    """
    spark = rows.sparkSession
    if spark.conf.get(PACKED_BLOCKS, None):
        raise ValueError(f"unset {PACKED_BLOCKS}: line numbers must start anew in each block")
    if files is None:
        files = [r["file"] for r in rows.select("file").distinct().toLocalIterator()]
    files = sorted(files)
    if len(files) >= 1 << (63 - FILE_BITS):
        raise ValueError(f"{len(files)} files")
    row_id = F.shiftleft(F.col("_rank"), FILE_BITS) + F.col("block") + F.col("line")

    def numbered(low: int) -> DataFrame:
        some = files[low : low + BROADCAST_FILES]
        ranks = spark.createDataFrame(
            [(name, low + i) for i, name in enumerate(some)], "_name string, _rank bigint"
        ).select(plain_uri(F.col("_name")).alias("_name"), "_rank")
        return (
            rows.join(F.broadcast(ranks), plain_uri(F.col("file")) == F.col("_name"))
            .withColumn("row_id", row_id)
            .drop("_name", "_rank", *([] if keep_place else PLACE))
        )

    out = numbered(0)
    for low in range(BROADCAST_FILES, len(files), BROADCAST_FILES):
        out = out.unionByName(numbered(low))
    return out


def read_until(
    spark: SparkSession,
    path: str | Sequence[str],
    enough: int,
    read: Callable[[list[str]], DataFrame],
) -> DataFrame:
    """What ``read`` makes of the first files that hold ``enough`` rows, in file order.

    Files are read one, two, four and so on at a time, until they do: each once, what it gives is
    staged. The files behind them are never opened.
    """
    files, found, at, batch = scan_files(spark, path), [], 0, 1
    n_found = 0
    while at < len(files) and (n_found < enough or not found):
        names = [unquote(name) for name in files[at : at + batch]]
        found.append(stage(read(names), "first-files"))
        n_found += found[-1].count()
        at, batch = at + batch, batch * 2
    if not found:
        return read([path] if isinstance(path, str) else list(path))
    return functools.reduce(DataFrame.unionByName, found)


def read_prompt_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file_name, messages)`` and any folder columns: every file is one JSON array of messages.

    Read as whole texts: a JSON scan would make a row of every message and lose their order.
    """
    paths = [path] if isinstance(path, str) else list(path)
    texts = spark.read.text(paths, wholetext=True)
    return texts.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.from_json("value", MESSAGES, {"mode": "FAILFAST", **WHOLE_STRINGS}).alias("messages"),
        *[c for c in texts.columns if c != "value"],
    )


def choose_prompts(prompts: DataFrame, file_messages: DataFrame) -> DataFrame:
    """``(prompt_id, messages)``: messages from a file win over messages built from text."""
    filed = file_messages.select("prompt_id", F.col("messages").alias("_filed"))
    return prompts.join(filed, "prompt_id", "left").select(
        "prompt_id", F.coalesce("_filed", "messages").alias("messages")
    )


def count_lines(spark: SparkSession, root: str, expected: Sequence[str]) -> DataFrame:
    """``(name, found, n_lines)`` for every expected file, or folder of files, under ``root``.

    An empty file yields no row to count and a missing one none to list; both report 0 lines.
    """
    inside = re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", root).rstrip("/") + "/"
    lines = spark.read.option("recursiveFileLookup", True).text(root)
    # The scan's own listing, which unlike its rows also knows empty files. Both give URIs.
    present = {unquote(path).split(inside, 1)[-1].split("/")[0] for path in lines.inputFiles()}
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    behind = F.substr(path, F.locate(inside, path) + F.lit(len(inside)))
    name = F.split(behind, "/")[0].alias("name")
    counts = lines.groupBy(name).agg(F.count(F.lit(1)).alias("n_lines"))
    entries = [
        F.struct(F.lit(n).alias("name"), F.lit(n in present).alias("found")) for n in expected
    ]
    wanted = spark.range(1, numPartitions=1).select(F.inline(F.array(*entries)))
    return wanted.join(counts, "name", "left").select(
        "name", "found", F.coalesce("n_lines", F.lit(0)).alias("n_lines")
    )
