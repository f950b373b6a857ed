"""Substring deduplication by seed and extend.

A word is removed when it lies in a run of ``least`` words whose sequence also starts in a document
with a smaller id. Every such run holds an anchor: of its five-word grams the one with the smallest
hash (the rightmost of equals). So documents are joined on anchors first. Anchors of one document
only, most of a corpus, are done. The others are extended both ways to all runs that they are the
anchor of, with two hashes of the whole run; equal runs are brought together, and the smallest id of
each decides. Removed runs that overlap form the maximal repeats.

Common passages do not pile up: in each slice of a task all holders of an anchor or a run but the
one with the smallest id are settled on the spot and moved to places of their own. A text that
equals one with a smaller id needs no extension, all its runs are copies.

A null text has no words. A null id comes after all others and is smaller than none. Rows of one id
are one document to each other: nothing is removed for a run that only rows of the same id share.
Extra columns stay, and the result columns replace columns of their names. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnspool.llm.words import NOT_SPACE, Words, WordReader, grams, mix, slices, windows_of
from turnspool.staging import stage

LEAST = 13
GRAM = 5
LAST = (1 << 63) - 1

OPEN, FIRST_OF_MANY, SETTLED = 0, 1, 2


def anchored_runs(words: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, row, anchor)`` of every run of ``least`` words inside a row."""
    start = windows_of(words.first, least)
    counts = np.maximum(np.diff(words.first) - least + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(start):
        return start, row, np.zeros(0, np.uint64)
    gram = grams(words.code, GRAM, seed=GRAM)
    anchor = gram[start]
    for k in range(1, least - GRAM + 1):
        np.minimum(anchor, gram[start + k], out=anchor)
    return start, row, anchor


def run_hashes(code: np.ndarray, start: np.ndarray, least: int) -> list[np.ndarray]:
    out = []
    for seed in (101, 102):
        factor = np.random.default_rng(seed).integers(0, 2**64, least, dtype=np.uint64)
        total = np.zeros(len(start), np.uint64)
        for k in range(least):
            total += code[start + k] * (factor[k] | np.uint64(1))
        out.append(mix(total))
    return out


def settle(keys: list[np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, state)``: rows sorted by keys and id. FIRST_OF_MANY has the smallest of several
    ids of its key, SETTLED a larger one; OPEN rows must look further."""
    order = np.lexsort((at, *keys))
    keys, at = [k[order] for k in keys], at[order]
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    size = np.diff(np.append(heads, len(at)))
    low, high = at[heads], at[heads + size - 1] if len(at) else at
    state = np.where(at > low[group], SETTLED, np.where(high > low, FIRST_OF_MANY, OPEN)[group])
    return order, state.astype(np.int8)


ANCHORS = "anchor bigint, at bigint, doc bigint, state tinyint"


def emit_anchors(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(NOT_SPACE, lower=False)
        for batch in batches:
            doc, at = (batch.column(k).to_numpy() for k in (0, 1))
            for low, _, data, bounds in slices(batch.column(2)):
                _, row, anchor = anchored_runs(reader.read(data, bounds), least)
                if not len(row):
                    continue
                same = np.zeros(len(row), bool)  # neighbouring runs mostly share their anchor
                same[1:] = (anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1])
                row, anchor = row[~same] + low, anchor[~same]
                order = np.lexsort((row, anchor))
                row, anchor = row[order], anchor[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                row, anchor = row[new], anchor[new]
                order, state = settle([anchor], at[row])
                row = row[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[order].view(np.int64)),
                        pa.array(at[row]),
                        pa.array(doc[row]),
                        pa.array(state),
                    ],
                    names=["anchor", "at", "doc", "state"],
                )

    return run


RUNS = (
    "h1 bigint, h2 bigint, at bigint, doc bigint, key int, start int, n int, state tinyint"
)


def emit_runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(NOT_SPACE, lower=False)
        for batch in batches:
            doc, at, key = (batch.column(name).to_numpy() for name in ("doc", "at", "key"))
            for low, high, data, bounds in slices(batch.column("text")):
                words = reader.read(data, bounds)
                start, row, anchor = anchored_runs(words, least)
                lists = batch.column("anchors").slice(low, high - low)
                owner = np.repeat(np.arange(high - low), lists.value_lengths().to_numpy())
                shared = lists.flatten().to_numpy().view(np.uint64)
                salt = mix(np.arange(high - low, dtype=np.uint64))
                use = np.isin(anchor ^ salt[row], shared ^ salt[owner])
                start, row = start[use], row[use]
                if not len(row):
                    continue
                hashes = run_hashes(words.code, start, least)
                place = start - words.first[row]
                row = row + low
                order, state = settle(hashes, at[row])
                state_of = np.empty(len(row), np.int8)
                state_of[order] = state
                # Settled neighbours travel as one row.
                joins = np.zeros(len(row), bool)
                joins[1:] = (
                    (state_of[1:] == SETTLED)
                    & (state_of[:-1] == SETTLED)
                    & (row[1:] == row[:-1])
                    & (place[1:] == place[:-1] + 1)
                )
                heads = np.flatnonzero(~joins)
                n = np.diff(np.append(heads, len(row)))
                row, place = row[heads], place[heads]
                columns = [h[heads].view(np.int64) for h in hashes]
                columns += [at[row], doc[row], key[row]]
                columns += [place.astype(np.int32), n.astype(np.int32), state_of[heads]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns],
                    names=["h1", "h2", "at", "doc", "key", "start", "n", "state"],
                )

    return run


def keep_words(least: int):
    """Text, its key, whether it is a copy, and runs to remove, to what is left."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        reader = WordReader(NOT_SPACE, lower=False)
        for text, key, copy, runs in batches:
            key, copy = key.to_numpy(), copy.to_numpy(zero_copy_only=False).astype(bool)
            n_words, n_removed, kept = [], [], []
            for low, high, data, bounds in slices(text):
                words = reader.read(data, bounds)
                first, size = words.first, np.diff(words.first)
                lists = runs.slice(low, high - low)
                lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(high - low), lengths)
                found = lists.flatten()
                own = found.field("key").to_numpy(zero_copy_only=False) == key[low + owner]
                owner = owner[own]
                start = first[owner] + found.field("start").to_numpy(zero_copy_only=False)[own]
                end = start + found.field("n").to_numpy(zero_copy_only=False)[own] + least - 1
                whole = np.flatnonzero(copy[low:high] & (size >= least))
                start = np.concatenate([start, first[whole]])
                end = np.concatenate([end, first[whole + 1]])
                total = len(words.start)
                depth = np.bincount(start, minlength=total + 1).astype(np.int64)
                depth -= np.bincount(end, minlength=total + 1)
                gone = np.cumsum(depth)[:total] > 0
                left = np.append(0, np.cumsum(~gone))
                n_left = left[first[1:]] - left[first[:-1]]
                n_words.append(size)
                n_removed.append(size - n_left)
                kept.append(_joined(data, words.start[~gone], words.end[~gone], n_left))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(0, np.int64), *n_words])),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *n_removed])),
                    pa.concat_arrays([pa.array([], pa.string()), *kept]),
                ],
                names=["n_words", "n_removed", "kept_text"],
            )

    return F.arrow_udf(run, "n_words bigint, n_removed bigint, kept_text string")


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """The words of each row, joined by one space."""
    size = end - start + 1
    ends = np.cumsum(size)
    source = np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    out = data[np.minimum(source, max(0, len(data) - 1))].copy()
    out[ends - 1] = 0x20
    last = np.cumsum(per_row)[per_row > 0] - 1  # the last word of a row has no space behind it
    keep = np.ones(len(out), bool)
    keep[ends[last] - 1] = False
    bounds = np.append(0, np.append(0, ends)[np.cumsum(per_row)])
    bounds -= np.append(0, np.cumsum(per_row > 0))
    return pa.StringArray.from_buffers(
        len(per_row), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out[keep])
    )


def shared_anchors(anchors: DataFrame) -> DataFrame:
    """``(doc, anchors)``: the anchors that a document shares with another."""
    group = F.when(F.col("state") == SETTLED, F.xxhash64("at", "anchor")).otherwise(F.col("anchor"))
    together = Window.partitionBy("group")
    return (
        anchors.withColumn("group", group)
        .withColumn("many", F.min("at").over(together) != F.max("at").over(together))
        .filter((F.col("state") != OPEN) | F.col("many"))
        .groupBy("doc")
        .agg(F.collect_set("anchor").alias("anchors"))
    )


def removed_runs(runs: DataFrame) -> DataFrame:
    """``(doc, runs)``: the runs that start in a document with a smaller id too."""
    settled = F.col("state") == SETTLED
    h1 = F.when(settled, F.xxhash64("at", "start", "h1")).otherwise(F.col("h1"))
    together = Window.partitionBy("group", "h2")
    return (
        runs.withColumn("group", h1)
        .withColumn("least_at", F.min("at").over(together))
        .filter(settled | (F.col("at") > F.col("least_at")))
        .groupBy("doc")
        .agg(F.collect_set(F.struct("key", "start", "n")).alias("runs"))
    )


def copies(docs: DataFrame) -> DataFrame:
    """``(doc, copies)``: the texts, by key, that equal one with a smaller id, and that id."""
    whole = [F.xxhash64("text"), F.xxhash64(F.lit(1), "text"), F.octet_length("text")]
    lean = docs.select("doc", "at", "key", *[c.alias(f"c{i}") for i, c in enumerate(whole)])
    names = ["c0", "c1", "c2"]
    first = lean.groupBy(*names).agg(F.min("at").alias("least_at"))
    return (
        lean.join(first, names)
        .filter(F.col("at") > F.col("least_at"))
        .groupBy("doc")
        .agg(F.collect_set(F.struct("key", "least_at")).alias("copies"))
    )


def dedup_substrings(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept_text``."""
    results = ("n_words", "n_removed", "kept_text")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    number = F.col(f"`{id_col}`").cast("bigint")
    carried = [F.col(f"`{c}`") for c in df.columns if c not in (*results, text_col)]
    docs = df.select(
        F.struct(*carried).alias("row"),
        F.coalesce(number, F.xxhash64(text)).alias("doc"),
        F.coalesce(number, F.lit(LAST)).alias("at"),
        F.hash(text).alias("key"),
        text.alias("text"),
    )
    anchors = docs.select("doc", "at", "text").mapInArrow(emit_anchors(least), ANCHORS)
    info = stage(shared_anchors(anchors).join(copies(docs), "doc", "full"), "shared-anchors")
    copied = F.exists(
        "copies", lambda c: (c["key"] == F.col("key")) & (c["least_at"] < F.col("at"))
    )
    # The texts are brought to their documents' anchors, and later to the runs to remove. Both
    # times all columns are read, so that both are one exchange.
    dealt = (
        docs.repartition("doc")
        .join(info, "doc", "left")
        .withColumn("copy", F.coalesce(copied, F.lit(False)))
    )
    runs = (
        dealt.filter(~F.col("copy") & F.col("anchors").isNotNull())
        .select("row", "doc", "at", "key", "text", "anchors")
        .mapInArrow(emit_runs(least), RUNS)
    )
    left = dealt.join(removed_runs(runs), "doc", "left").select(
        "row", keep_words(least)("text", "key", "copy", "runs").alias("left")
    )
    return left.select("row.*", "left.*")
