"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ten consecutive words of a benchmark item (or a whole shorter item).
Patterns of one length are searched together: a shift table over blocks of two words tells how far
the next possible end of a match is, blocks that allow no shift select the patterns with that
suffix and the same words before it by hash, and their words are compared with the text, first by
code, then byte by byte. So a suffix that many patterns share costs no comparison with each of them.

Texts with null have no words. Items without words give no pattern; an item whose id is null is
called "null"; items with one id are one item. Repeated rows, extra columns and empty tables need
no care; the result column replaces one of its name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.llm.words import ALNUM, WordReader, mix, slices
from turnspool.staging import stage

WINDOW = 10
# Item text searched for in one pass over the documents.
PASS_BYTES = 16 << 20
STRETCH = 128

HIT = "n_words bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"


class Patterns(NamedTuple):
    """Patterns of one length and their tables."""

    codes: np.ndarray  # pattern by word
    words: list[tuple[bytes, ...]]
    items: list[list[int]]  # of each pattern
    shift: np.ndarray
    key: np.ndarray  # pattern_key, in order
    bits: int


def block_hash(before: np.ndarray, last: np.ndarray, bits: int) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + last) >> np.uint64(64 - bits)


def pattern_key(codes: Iterable[np.ndarray], blocks: np.ndarray, bits: int) -> np.ndarray:
    """Block hash of the suffix, and behind it a hash of all words, given one after the other."""
    whole = np.zeros(len(blocks), np.uint64)
    for code in codes:
        whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + code)
    return (blocks << np.uint64(64 - bits)) | (whole >> np.uint64(bits))


def prepare(patterns: dict[tuple[bytes, ...], list[int]], codes: dict[bytes, int]) -> Patterns:
    """Shift table and suffix buckets of patterns of one length."""
    words = list(patterns)
    table = np.array([[codes[w] for w in p] for p in words], np.uint64)
    length = table.shape[1]
    bits = min(22, max(16, int(np.ceil(np.log2(8 * table.size)))))
    block = min(2, length)

    def hashes(end: int) -> np.ndarray:
        before = table[:, end - 1] if block == 2 else np.zeros(len(words), np.uint64)
        return block_hash(before, table[:, end], bits)

    shift = np.full(1 << bits, length - block + 1, np.int64)
    for end in range(block - 1, length):
        np.minimum.at(shift, hashes(end), length - 1 - end)
    key = pattern_key(table.T, hashes(length - 1), bits)
    order = np.argsort(key, kind="stable")
    return Patterns(
        table[order],
        [words[i] for i in order],
        [patterns[words[i]] for i in order],
        shift,
        key[order],
        bits,
    )


def search(p: Patterns, code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(end, pattern)`` of the places where the codes of a pattern stand.

    Every stretch of a text has a cursor; all cursors move at once, each by its own shift.
    """
    length = p.codes.shape[1]
    low, high = first[:-1] + length - 1, first[1:]
    counts = np.maximum(-(-(high - low) // STRETCH), 0)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(low, counts) + nth * STRETCH
    stop = np.minimum(at + STRETCH, np.repeat(high, counts))
    found = []
    while len(at):
        before = code[at - 1] if length > 1 else np.zeros(len(at), np.uint64)
        blocks = block_hash(before, code[at], p.bits)
        step = p.shift[blocks]
        met = step == 0
        if met.any():
            found.append((at[met], blocks[met]))
        at = at + np.maximum(step, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end, blocks = (np.concatenate(x) for x in zip(*found))
    key = pattern_key((code[end - back] for back in reversed(range(length))), blocks, p.bits)
    begin = np.searchsorted(p.key, key, "left")
    size = np.searchsorted(p.key, key, "right") - begin
    end = np.repeat(end, size)
    which = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    for back in range(length):
        same = code[end - back] == p.codes[which, length - 1 - back]
        end, which = end[same], which[same]
    return end, which


def item_windows(items: list[tuple[str, str]], window: int) -> tuple[list[str], dict]:
    """``(names, patterns by length)``; a pattern knows the items that it is in."""
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    by_length: dict = defaultdict(lambda: defaultdict(list))
    reader = WordReader(ALNUM, lower=True)
    codes: dict[bytes, int] = {}
    for name, text in items:
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        found = reader.read(data, np.array([0, len(data)]))
        words = [raw[a:b].lower() for a, b in zip(found.start, found.end)]
        codes.update(zip(words, found.code))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            owners = by_length[min(window, len(words))][tuple(words[i : i + window])]
            if not owners or owners[-1] != number[name]:
                owners.append(number[name])
    return names, {n: prepare(p, codes) for n, p in by_length.items()}


def _marked(
    hits: np.ndarray, first: np.ndarray, earlier: list | None, row: int
) -> list[dict[str, int]]:
    """Runs of hit words of a row, with those that an earlier pass has found."""
    own = hits[first[row] : first[row + 1]].copy()
    for span in earlier or []:
        own[span["start"] : span["end"]] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
    return [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


def _searcher(sent, schema: str):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        names, tables = sent.value
        tables = [Patterns(*t) for t in tables]
        reader = WordReader(ALNUM, lower=True)
        for text, before in batches:
            earlier = before.to_pylist()
            out = []
            for low, high, data, bounds in slices(text):
                words = reader.read(data, bounds)
                hits = np.zeros(len(words.start), bool)
                items: dict[int, set[str]] = defaultdict(set)
                for p in tables:
                    length = p.codes.shape[1]
                    for end, which in zip(*search(p, words.code, words.first)):
                        at = slice(end - length + 1, end + 1)
                        same = all(
                            data[a:b].tobytes().lower() == word
                            for a, b, word in zip(words.start[at], words.end[at], p.words[which])
                        )
                        if same:
                            hits[at] = True
                            row = int(np.searchsorted(words.first, end, "right")) - 1
                            items[row].update(names[i] for i in p.items[which])
                touched = set(items)
                for row in range(high - low):
                    old = earlier[low + row] or {"items": [], "spans": []}
                    fresh = row in touched
                    out.append(
                        {
                            "n_words": int(words.first[row + 1] - words.first[row]),
                            "items": sorted(items[row] | set(old["items"]))
                            if fresh
                            else old["items"],
                            "spans": _marked(hits, words.first, old["spans"], row)
                            if fresh
                            else old["spans"],
                        }
                    )
            yield pa.array(out, HIT_TYPE)

    return F.arrow_udf(run, schema)


HIT_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def find_benchmark(
    df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text"
) -> DataFrame:
    """``df`` with ``hits``: number of words, ids of the items found, runs of hit words.

    The items are taken in blocks of about PASS_BYTES of text; each block is one pass over the
    documents that adds to what earlier passes have found.
    """
    spark = df.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text"
    ).filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // PASS_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    names = [c for c in df.columns if c != "hits"]
    found = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.lit(None).cast(f"struct<{HIT_FIELDS}>").alias("hits"),
    )
    for k in range(passes):
        block = [tuple(r) for r in items.filter(part == k).orderBy("item_id", "text").collect()]
        ids, tables = item_windows(block, window)
        sent = spark.sparkContext.broadcast((ids, [tuple(t) for t in tables.values()]))
        found = found.withColumn("hits", _searcher(sent, HIT)(F.col("text"), F.col("hits")))
        if k + 1 < passes:  # one pass's tables in a worker at a time
            found = stage(found, "decontamination")
    return found.select("row.*", "hits")


HIT_FIELDS = (
    "n_words: bigint, items: array<string>, spans: array<struct<start:bigint,end:bigint>>"
)


def n_hit(hits: str = "hits"):
    """How many words are hit."""
    return F.aggregate(
        F.col(f"{hits}.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )
