"""Line deduplication by the suffixes of all texts' line sequences.

A run of lines is a later copy if the same lines also start at an earlier place (order column, then
line). Every line goes that lies in a later copy of at least ``min_lines`` lines with at least
``min_chars`` characters; that is, for every suffix, the longest run at its start that is a later
copy decides. Runs from different sources that happen to touch are not one run.

Prefix doubling ranks a suffix by its first lines: the rank by 2h lines is made of the rank by h lines
and that of the suffix h lines on. Ranks are hashes here, so a text doubles its own without a
shuffle. Suffixes that share their first l lines are an interval of the suffix array whose longest
common prefix is l or more. The intervals are refined from long steps to short ones, as in a binary
search for the common prefix: suffixes of an interval that also share the next h lines are an
interval of their own. All its members but the earliest have an earlier one beside them, so they
leave the old interval and stand in the new one; the earliest stays in the old one for all of them,
and is also put into the new one. So after the step h = 1 every suffix stands in the interval of its
longest later copy, and no step has more than two rows for a suffix.

Which interval continues is found by counts and minima that are combined before they are shuffled;
rows go back to their texts by a join that is split where a key is hot. A text that equals an earlier
one is a later copy as a whole and needs no suffixes, so groups of copies weigh one text.

Lines are compared by two hashes, blank lines too. Null and empty texts have no lines. A null id comes
after all others. Rows are told apart by id and text, so repeated rows are one text and stay
together; which of them to keep is the business of document deduplication. Rows of one id with other
texts are ordered by a hash of the text. A text that loses all lines is empty. A text of any length is
one row of a task; its lines take some hundred bytes each. Extra columns stay; the result columns
replace columns of their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.llm.words import mix
from turnspool.staging import stage

MIN_LINES = 2
MIN_CHARS = 40
LAST = (1 << 63) - 1
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

# One list per text: the suffix's line, the lines it shares, its interval, and whether it has an
# earlier one there or stands for others only.
MEMBERS = (
    "line array<int>, shared array<int>, n1 array<bigint>, n2 array<bigint>, copy array<boolean>"
)
STATE = f"at bigint, key bigint, n int, a array<bigint>, b array<bigint>, {MEMBERS}"
CANDIDATES = "k1 bigint, k2 bigint, at bigint, key bigint, line int, member int, digit int"
# Each round settles one digit of the shared lines to this base.
BASE = 4


def prefix_ranks(lines: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash of ``length`` lines for each start at which so many follow, by doubling."""
    rank, size = lines, 1
    for bit in bin(length)[3:]:
        n = max(0, len(rank) - size)
        rank = mix(rank[:n] * factor + mix(rank[size : size + n]))
        size *= 2
        if bit == "1":
            n = max(0, len(lines) - size)
            rank = mix(rank[:n] * factor + mix(lines[size : size + n]))
            size += 1
    return rank


class Lists:
    """List columns of one shape as flat arrays."""

    def __init__(self, *columns: pa.Array):
        sizes = columns[0].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        self.first = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.flat = [c.flatten() for c in columns]

    def numpy(self) -> list[np.ndarray]:
        return [x.to_numpy(zero_copy_only=False) for x in self.flat]


def emit_candidates(unit: int | None, least: int):
    """Each suffix with the intervals that it would be in by 1, 2 or 3 ``unit`` lines more; first of
    all, with that of its first ``least`` lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Lists(batch.column("a"), batch.column("b"))
            lines = [x.view(np.uint64) for x in texts.numpy()]
            place = [batch.column(c).to_numpy() for c in ("at", "key")]
            if unit is None:
                member = np.arange(len(texts.row)) - texts.first[texts.row]
                whole = np.flatnonzero(member + least <= np.diff(texts.first)[texts.row])
                keys = [prefix_ranks(x, least, f)[whole] for x, f in zip(lines, FACTORS)]
                row, member = texts.row[whole], member[whole]
                yield candidates(keys, place, row, member, member, 1)
                continue
            members = Lists(*[batch.column(c) for c in ("line", "shared", "n1", "n2")])
            line, shared, *node = members.numpy()
            behind = line.astype(np.int64) + shared
            for digit in range(1, BASE):
                fits = np.diff(texts.first)[members.row] - behind >= digit * unit
                own = np.flatnonzero(fits)
                row = members.row[own]
                at = texts.first[row] + behind[own]
                keys = [
                    mix(n[own].view(np.uint64) * f + mix(prefix_ranks(x, digit * unit, f)[at]))
                    for n, x, f in zip(node, lines, FACTORS)
                ]
                yield candidates(keys, place, row, line[own], own - members.first[row], digit)

    def candidates(keys, place, row, line, member, digit) -> pa.RecordBatch:
        arrays = [pa.array(k.view(np.int64)) for k in keys] + [pa.array(p[row]) for p in place]
        arrays += [pa.array(x, pa.int32()) for x in (line, member, np.full(len(row), digit))]
        return pa.RecordBatch.from_arrays(
            arrays, names=[c.split()[0] for c in CANDIDATES.split(", ")]
        )

    return run


def emit_state(unit: int | None, least: int):
    """Texts with their suffixes after a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moves = Lists(batch.column("moves"))
            found = [
                moves.flat[0].field(c).to_numpy(zero_copy_only=False)
                for c in ("member", "digit", "size", "k1", "k2", "holds")
            ]
            if unit is None:
                member, _, _, k1, k2, holds = found
                row = moves.row
                new = [member, np.full(len(member), least), k1, k2, ~holds]
            else:
                row, new = moved(batch, moves.row, *found)
            order = np.argsort(row, kind="stable")
            offsets = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows)))
            columns = [batch.column(c) for c in ("at", "key", "n", "a", "b")]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            for values, kind in zip(new, types):
                flat = pa.array(values[order], kind)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat))
            names = [c.split()[0] for c in STATE.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def moved(batch, row, member, digit, size, k1, k2, holds) -> tuple[np.ndarray, list[np.ndarray]]:
        members = Lists(*[batch.column(c) for c in ("line", "shared", "n1", "n2", "copy")])
        line, shared, n1, n2, copy = (x.copy() for x in members.numpy())
        own = members.first[row] + member
        # The longest prefix that an earlier suffix shares.
        best = np.zeros(len(line), np.int64)
        np.maximum.at(best, own[~holds], digit[~holds])
        # The earliest of an interval is put into it, unless all of it goes on together.
        sizes = np.ones((len(line), BASE + 1), np.int64)
        sizes[own, digit] = size
        stays = np.flatnonzero(holds & (size > sizes[own, digit + 1]))
        held = own[stays]
        more = [line[held], shared[held] + digit[stays] * unit, k1[stays], k2[stays]]
        more.append(np.zeros(len(held), bool))
        goes = np.flatnonzero(~holds & (digit == best[own]))
        gone = own[goes]
        shared[gone] += (digit[goes] * unit).astype(shared.dtype)
        n1[gone], n2[gone], copy[gone] = k1[goes], k2[goes], True
        new = [np.concatenate(x) for x in zip((line, shared, n1, n2, copy), more)]
        return np.concatenate([members.row, members.row[held]]), new

    return run


def refined(state: DataFrame, unit: int | None, least: int) -> DataFrame:
    """One round for all intervals. First, texts without suffixes of an interval drop out."""
    candidates = state.mapInArrow(emit_candidates(unit, least), CANDIDATES)
    place = F.struct("at", "key", "line")
    intervals = (
        candidates.groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("size"), F.min(place).alias("first"))
        .filter(F.col("size") > 1)
    )
    move = F.struct("member", "digit", "size", "k1", "k2", (place == F.col("first")).alias("holds"))
    moves = (
        candidates.join(intervals, ["k1", "k2"])
        .groupBy("at", "key")
        .agg(F.collect_list(move).alias("moves"))
    )
    joined = state.join(moves, ["at", "key"], "inner" if unit is None else "left")
    return stage(joined.mapInArrow(emit_state(unit, least), STATE), "line-suffixes")


def later_copies(docs: DataFrame, least: int) -> DataFrame:
    """``(at, key, line, shared)``: suffixes of texts and how many lines of them are a later copy."""
    longest = docs.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    first = refined(docs, None, least)
    live, unit = first.filter("false"), 1
    while unit * BASE <= longest - least:
        unit *= BASE
    while unit:
        # A text takes part from the first round on that fits behind the lines a suffix shares.
        room = F.col("n") - least
        entering = first.filter((room >= unit) & (room < unit * BASE))
        live = refined(live.unionByName(entering), unit, least)
        unit //= BASE
    members = first.filter(F.col("n") == least).unionByName(live)
    each = members.select(
        "at", "key", F.explode(F.arrays_zip("line", "shared", "copy")).alias("m")
    )
    return each.filter("m.copy").select("at", "key", "m.line", "m.shared")


FOUND = (
    "clean_text string, n_lines bigint, n_deleted_lines bigint, "
    "deleted array<struct<start: int, end: int>>"
)


def clean_udf(least: int, chars: int):
    """What is left of texts without their later copies: linear in lines and copies."""

    def cleaned(text: str, whole: bool, line: np.ndarray, shared: np.ndarray) -> tuple:
        lines = text.split("\n") if text else []
        n = len(lines)
        upto = np.append(0, np.cumsum([len(x) for x in lines])).astype(np.int64)
        if whole:
            line, shared = np.zeros(1, np.int64), np.full(1, n)
        long = (shared >= least) & (upto[line + shared] - upto[line] >= chars)
        depth = np.bincount(line[long], minlength=n + 1).astype(np.int64)
        depth -= np.bincount((line + shared)[long], minlength=n + 1)
        gone = np.cumsum(depth)[:n] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        if not len(edges):
            return text, n, 0, []
        left = "\n".join(x for x, g in zip(lines, gone) if not g)
        runs = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
        return left, n, int(gone.sum()), runs

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, whole, line, shared in columns:
            rows = []
            lists = Lists(line, shared)
            starts, sizes = (x.astype(np.int64) for x in lists.numpy())
            copied = whole.to_pylist()
            for r, text in enumerate(texts.to_pylist()):
                own = slice(lists.first[r], lists.first[r + 1])
                found = cleaned(text or "", copied[r], starts[own], sizes[own])
                rows.append((text if not found[3] else found[0], *found[1:]))
            names = ("clean_text", "n_lines", "n_deleted_lines", "deleted")
            yield pa.array([dict(zip(names, r)) for r in rows], TYPE)

    return F.arrow_udf(run, FOUND)


RUN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
TYPE = pa.struct(
    [
        ("clean_text", pa.string()),
        ("n_lines", pa.int64()),
        ("n_deleted_lines", pa.int64()),
        ("deleted", pa.list_(RUN)),
    ]
)


def originals(texts: DataFrame) -> DataFrame:
    """``(at, key, whole)`` of all texts, once; ``whole`` where an earlier text is equal."""
    length = F.octet_length("text").alias("length")
    lean = texts.select("at", "key", F.xxhash64(F.lit(1), "text").alias("key2"), length).distinct()
    same = ["key", "key2", "length"]
    first = lean.groupBy(*same).agg(F.min("at").alias("first"))
    return lean.join(first, same).select("at", "key", (F.col("at") > F.col("first")).alias("whole"))


def dedup_lines(
    df: DataFrame,
    order_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = MIN_LINES,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``df`` with ``clean_text``, ``n_lines``, ``n_deleted_lines`` and ``deleted`` runs of lines."""
    results = ("clean_text", "n_lines", "n_deleted_lines", "deleted")
    text = F.col(f"`{text_col}`")
    texts = df.select(
        F.struct(
            F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in df.columns if c not in results]
        ).alias("row"),
        F.coalesce(F.col(f"`{order_col}`").cast("bigint"), F.lit(LAST)).alias("at"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"),
        text.alias("text"),
    )
    filled = texts.filter(F.length("text") > 0)
    known = stage(originals(filled), "line-texts")
    split = F.split("text", "\n")
    docs = (
        filled.withColumn("n", F.size(split))
        .filter(F.col("n") >= min_lines)
        .join(known.filter(~F.col("whole")), ["at", "key"])
        .select(
            "at",
            "key",
            "n",
            F.transform(split, lambda x: F.xxhash64(x)).alias("a"),
            F.transform(split, lambda x: F.xxhash64(F.lit(1), x)).alias("b"),
        )
        .dropDuplicates(["at", "key"])
    )
    copies = later_copies(stage(docs, "line-hashes"), min_lines)
    listed = copies.groupBy("at", "key").agg(
        F.collect_list(F.struct("line", "shared")).alias("copies")
    )
    found = known.join(listed, ["at", "key"], "left")
    joined = texts.join(found, ["at", "key"], "left")
    whole = F.coalesce("whole", F.lit(False))
    left = clean_udf(min_lines, min_chars)(
        "text", whole, F.col("copies.line"), F.col("copies.shared")
    )
    return joined.select("row", left.alias("left")).select("row.*", "left.*").drop("_")
