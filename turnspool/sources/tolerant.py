"""Tolerant JSON scan: one-line and pretty-printed objects mixed, broken text set aside.

Reading is defined line by line. A blank line, or a line that is JSON by itself, ends whatever
object was open before it. Any other line adds to the open object, which is complete at the
first line where all text since its start is JSON. Broken text swallows what follows it, up to
the next such end.

That is made parallel in two steps. Each block of a file is scanned on its own, in one pass, and
settles everything between its first and its last end. What is left, lines before the first end
and an object still open at the last line, are fragments, which carry their bracket depth.
Running sums of depth over the blocks of a file then tell where objects start and end across
blocks, and the lines of each are gathered by object. Lines of a file thus never pass through one
task, even where a whole file holds no end at all.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from turnspool.sources.files import CHAT_SCHEMA, PLACE, WHOLE_STRINGS
from turnspool.staging import fresh_path, stage

NOT_JSON, NOT_OBJECT = "not JSON", "not an object"

# A gathered object is one string of a Spark row, which ends at 2 GB.
MAX_OBJECT_BYTES = 1 << 30

SCAN_SCHEMA = (
    "kind string, file string, block bigint, line bigint, tail boolean, text string, "
    "reason string, depth bigint, dead boolean"
)
RECORD, REJECT, FRAGMENT, BLOCK = "record", "reject", "fragment", "block"

# No JSON text starts or stops with one of these; most lines inside a pretty object do.
NO_START, NO_STOP = tuple("}],:"), tuple("{[,:")
STRING = re.compile(r'"(?:[^"\\]|\\.)*"')


def judge(text: str) -> str | None:
    """None for a JSON object, otherwise what it is instead."""
    if text.startswith(NO_START) or text.endswith(NO_STOP):
        return NOT_JSON
    try:
        return None if isinstance(json.loads(text), dict) else NOT_OBJECT
    except (ValueError, RecursionError):
        return NOT_JSON


def depth_change(line: str) -> int:
    """Brackets opened less brackets closed. A JSON string never goes over a line end."""
    bare = STRING.sub("", line)
    return bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")


class BlockScan:
    """The pass over the lines of one block; ``rows`` collects output in ``SCAN_SCHEMA`` order."""

    def __init__(self, file: str, block: int, rows: list[tuple]):
        self.file, self.block, self.rows = file, block, rows
        self.line = -1
        # A file starts as if an object had just ended.
        self.ended = block == 0
        self.head_depth = 0
        self.clear()

    def clear(self) -> None:
        self.open: list[tuple[int, int, str]] = []
        self.depth = 0
        self.dead = False

    def put(self, kind, line, text=None, reason=None, depth=0, tail=False, dead=False):
        self.rows.append((kind, self.file, self.block, line, tail, text, reason, depth, dead))

    def settle(self, line: int, text: str, verdict: str | None) -> None:
        self.put(REJECT if verdict else RECORD, line, text, verdict)

    def end(self) -> None:
        for line, _, text in self.open:
            self.put(REJECT, line, text, NOT_JSON)
        self.clear()
        self.ended = True

    def feed(self, text: str) -> None:
        self.line += 1
        bare = text.strip()
        if not bare:
            self.end()
            return
        verdict = judge(bare)
        if verdict != NOT_JSON:
            self.end()
            self.settle(self.line, bare, verdict)
            return
        if self.dead:
            self.put(REJECT, self.line, text, NOT_JSON)
            return
        change = depth_change(text)
        if not self.ended:
            self.head_depth += change
            self.put(FRAGMENT, self.line, text, depth=self.head_depth)
            return
        self.depth += change
        self.open.append((self.line, self.depth, text))
        if self.depth <= 0:
            whole = "\n".join(part for _, _, part in self.open)
            verdict = judge(whole)
            if verdict == NOT_JSON:
                self.end()
                self.dead = True
            else:
                self.settle(self.open[0][0], whole, verdict)
                self.clear()

    def finish(self) -> None:
        for line, depth, text in self.open:
            self.put(FRAGMENT, line, text, depth=depth, tail=True)
        if self.ended:
            self.put(BLOCK, 0, depth=self.depth, tail=True, dead=self.dead)
        self.put(BLOCK, 0, depth=self.head_depth)


def scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan lines as they come: in file order within a block, block after block."""
    current: BlockScan | None = None
    rows: list[tuple] = []
    for batch in batches:
        texts, names, blocks = (batch.column(i).to_pylist() for i in range(3))
        for text, file, block in zip(texts, names, blocks):
            if current is None or (file, block) != (current.file, current.block):
                if current is not None:
                    current.finish()
                current = BlockScan(file, block, rows)
            current.feed(text)
        if rows:
            yield to_batch(rows)
            rows.clear()
    if current is not None:
        current.finish()
        yield to_batch(rows)


SCAN_TYPES = pa.schema(
    [
        ("kind", pa.string()),
        ("file", pa.string()),
        ("block", pa.int64()),
        ("line", pa.int64()),
        ("tail", pa.bool_()),
        ("text", pa.string()),
        ("reason", pa.string()),
        ("depth", pa.int64()),
        ("dead", pa.bool_()),
    ]
)


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), SCAN_TYPES.types)]
    return pa.RecordBatch.from_arrays(columns, schema=SCAN_TYPES)


@F.arrow_udf(StringType())
def verdict_of(texts: pa.Array) -> pa.Array:
    return pa.array([judge(t) for t in texts.to_pylist()], pa.string())


@dataclass(frozen=True)
class TolerantScan:
    """Both sides of a scan, as ``(file, block, line, text)`` and, for rejects, ``reason``."""

    kept: DataFrame
    left_out: DataFrame
    files: tuple[str, ...] = ()

    def records(self) -> DataFrame:
        return self.kept

    def messages(self) -> DataFrame:
        """``(messages, file, block, line)``; null messages where an object has none."""
        return self.parsed().drop("text")

    def parsed(self) -> DataFrame:
        """The same with the text of each object."""
        parsed = F.from_json("text", CHAT_SCHEMA, WHOLE_STRINGS)
        return self.kept.select(parsed["messages"].alias("messages"), *PLACE, "text")

    def rejects(self) -> DataFrame:
        return self.left_out


def read_tolerant(
    spark: SparkSession, path: str | Sequence[str], max_object_bytes: int = MAX_OBJECT_BYTES
) -> TolerantScan:
    """Scan text files. The rows of the scan are staged by their kind, and objects that are put
    together after it are too, so that either is done once, however often the result is read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )
    files = tuple(sorted(lines.inputFiles()))
    staged = fresh_path(spark, "tolerant-scan")
    lines.mapInArrow(scan_blocks, SCAN_SCHEMA).write.partitionBy("kind").parquet(staged)
    scan = spark.read.schema(SCAN_SCHEMA).parquet(staged)
    kept = scan.filter(F.col("kind") == RECORD).select(*PLACE, "text")
    left_out = scan.filter(F.col("kind") == REJECT).select(*PLACE, "text", "reason")
    fragments = scan.filter(F.col("kind") == FRAGMENT).select(*PLACE, "tail", "text", "depth")
    if fragments.isEmpty():
        return TolerantScan(kept, left_out, files)
    blocks = scan.filter(F.col("kind") == BLOCK).select(
        "file", "block", "tail", "depth", "dead"
    )
    joined = join_fragments(fragments, blocks, max_object_bytes)
    complete = F.col("reason").isNull()
    return TolerantScan(
        kept.unionByName(joined.filter(complete).drop("reason")),
        left_out.unionByName(joined.filter(~complete)),
        files,
    )


ZONE = ("file", "block", "tail")


def runs_of_zones(blocks: DataFrame) -> DataFrame:
    """``(file, block, tail, run, entry, dead)``: one row per zone, the two ends of a block.

    A run is what lies between two ends: the tail zone of one block, the head zones of those
    behind it, up to and with that of the next block with an end in it. ``entry`` is the bracket
    depth where the zone starts. Windows here are over short rows, at most two per block.
    """
    before = Window.partitionBy("file").orderBy("block", "tail").rowsBetween(
        Window.unboundedPreceding, -1
    )
    last_end = F.last(F.when(F.col("tail"), F.col("block")), ignorenulls=True).over(before)
    run = F.when(F.col("tail"), F.col("block")).otherwise(F.coalesce(last_end, F.lit(-1)))
    inside = Window.partitionBy("file", "run").orderBy("block", "tail").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return blocks.withColumn("run", run).select(
        *ZONE,
        "run",
        F.coalesce(F.sum("depth").over(inside), F.lit(0)).alias("entry"),
        F.coalesce(F.max("dead").over(inside), F.lit(False)).alias("dead"),
    )


def objects_over_zones(marked: DataFrame, max_object_bytes: int) -> DataFrame:
    """``(file, block, tail, entering, entering_fits, leaving, leaving_fits)`` per zone.

    The object open where a zone starts and the one open where it stops are numbered within the
    run. One that is never closed cannot be JSON, and one above the size limit cannot be a row:
    neither is gathered.
    """
    size = F.octet_length("text") + 1
    zones = marked.groupBy(*ZONE, "run").agg(
        F.max("closed").alias("closed"),
        F.sum(F.when(F.col("at") == 0, size).otherwise(0)).alias("first_bytes"),
        F.sum(F.when(F.col("at") == F.col("closed"), size).otherwise(0)).alias("last_bytes"),
    )
    before = Window.partitionBy("file", "run").orderBy("block", "tail").rowsBetween(
        Window.unboundedPreceding, -1
    )
    closes = F.col("closed") > 0
    entering = F.coalesce(F.count_if(closes).over(before), F.lit(0))
    zones = zones.withColumn("entering", entering).withColumn(
        "leaving", F.col("entering") + closes.cast("int")
    )
    shares = zones.select(
        "file",
        "run",
        F.inline(
            F.array(
                F.struct(
                    F.col("entering").alias("object"),
                    F.col("first_bytes").alias("bytes"),
                    closes.alias("complete"),
                ),
                F.struct(
                    F.col("leaving").alias("object"),
                    F.when(closes, F.col("last_bytes")).otherwise(0).alias("bytes"),
                    F.lit(False).alias("complete"),
                ),
            )
        ),
    )
    fits = shares.groupBy("file", "run", "object").agg(
        (F.max("complete") & (F.sum("bytes") <= max_object_bytes)).alias("fits")
    )
    for side in ("entering", "leaving"):
        named = fits.withColumnsRenamed({"object": side, "fits": f"{side}_fits"})
        zones = zones.join(named, ["file", "run", side], "left")
    return zones.select(*ZONE, "entering", "entering_fits", "leaving", "leaving_fits")


def join_fragments(
    fragments: DataFrame, blocks: DataFrame, max_object_bytes: int
) -> DataFrame:
    """Put together the objects that go over block borders; what is none gets a ``reason``."""
    zones = runs_of_zones(blocks)
    in_zone = Window.partitionBy(*ZONE)
    closing = F.col("entry") + F.col("depth") <= 0
    earlier = in_zone.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    marked = (
        fragments.join(zones, list(ZONE))
        # How many objects of the zone close before this line, and in all.
        .withColumn("at", F.coalesce(F.count_if(closing).over(earlier), F.lit(0)))
        .withColumn("closed", F.count_if(closing).over(in_zone))
    )
    spans = objects_over_zones(marked, max_object_bytes)
    first, last = F.col("at") == 0, F.col("at") == F.col("closed")
    owner = (
        F.when(first, F.struct(F.lit(-1).cast("bigint").alias("block"), F.col("entering").alias("n")))
        .when(last, F.struct(F.lit(-1).cast("bigint").alias("block"), F.col("leaving").alias("n")))
        .otherwise(F.struct(F.col("block"), F.col("at").alias("n")))
    )
    fits = (
        F.when(first, F.col("entering_fits"))
        .when(last, F.col("leaving_fits"))
        .otherwise(F.lit(True))
    )
    owned = marked.join(spans, list(ZONE)).select(
        *PLACE,
        "tail",
        "run",
        "text",
        owner.alias("owner"),
        (fits & ~F.col("dead")).alias("fits"),
    )
    owned = stage(owned, "tolerant-lines")
    whole = (
        owned.filter("fits")
        .groupBy("file", "run", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "tail", "text"))).alias("parts"))
        .select(
            "file",
            "run",
            *[F.col("parts")[0][c].alias(c) for c in ("block", "tail", "line")],
            F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
        )
        .withColumn("reason", verdict_of("text"))
    )
    whole = stage(whole, "tolerant-objects")
    unfit = owned.filter(~F.col("fits"))
    # The first failure of a run spoils what follows it there. It is looked up by zone, so that
    # the objects of a long run are not brought together.
    place = F.struct("block", "line")
    failures = (
        whole.filter(F.col("reason") == NOT_JSON)
        .select("file", "run", place.alias("place"))
        .unionByName(unfit.select("file", "run", place.alias("place")))
        .groupBy("file", "run")
        .agg(F.min("place").alias("failure"))
    )
    spoiled = zones.join(failures, ["file", "run"]).select(*ZONE, "failure")
    judged = whole.join(spoiled, list(ZONE), "left").withColumn(
        "reason",
        F.when(place >= F.col("failure"), F.lit(NOT_JSON)).otherwise(F.col("reason")),
    )
    return judged.select(*PLACE, "text", "reason").unionByName(
        unfit.select(*PLACE, "text", F.lit(NOT_JSON).alias("reason"))
    )
