"""Packing of tokenized documents into sequences: Martello-Toth reduction, then best fit.

Documents are tokenized, closed by an end id, and cut to pieces no longer than a sequence. Which
pieces go together depends on their lengths only, so the bins are planned on the histogram of
lengths, which has no more rows than a sequence has tokens. The reduction fixes small sets of pieces
for good where no other choice for the longest piece can be better:

- the piece alone, when nothing fits beside it;
- the piece and one that fills the rest exactly, or, when no two fit, the longest that fits;
- the piece and the two longest that fit, when no three fit and they dominate every other pair.

What remains is packed by best fit, longest first. The plan is a short list of runs: the pieces of
one length with ranks from ``low`` to ``high`` go to consecutive bins at one offset. Ranks within a
length are counted in blocks of rows, so a length that most pieces have is no hot spot.

A null text is an empty one and gives one piece, the end id. A text of any length and kind is
tokenized whole, also where it is one run of blanks, letters or signs. Rows are told apart by their
place, so repeated rows and ids, nulls and ties need no care; extra columns are carried, unless they
are named like a result column. An empty table gives no pieces.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.llm.words import WordReader, slices
from turnspool.operators.order import global_index
from turnspool.staging import stage

# Fixed values of the public vocabulary.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}
# What the pattern takes for a blank (the Unicode property White_Space).
BLANKS = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
LONG_BLANKS = re.compile(f"[{BLANKS}]{{1000,}}")

# Chunks that a task remembers; beyond that it starts over.
MAX_KNOWN = 1 << 20
# Bytes of text that are tokenized at a time.
SLICE = 2 << 20
PLACE_BITS = 16


class ChunkTokenizer:
    """Ids of many texts, each distinct chunk of text being tokenized once.

    A space before a byte that surely starts no white space always starts a token, so a text can be
    cut there without changing its ids.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
        self.size = np.zeros(max(*ranks.values(), *SPECIAL.values()) + 1, np.int64)
        for token, rank in [*ranks.items(), *((s.encode(), i) for s, i in SPECIAL.items())]:
            self.size[rank] = len(token)
        self.solid = np.zeros(256, bool)
        self.solid[0x21:0x7F] = self.solid[0xC3:0xE0] = self.solid[0xE4:0xF5] = True
        self.reader = WordReader(np.ones(256, bool), lower=False)
        self._forget()

    def _forget(self) -> None:
        self.codes = np.zeros(0, np.uint64)  # of known chunks, in order
        self.low, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, raw: bytes, start: np.ndarray, end: np.ndarray, code: np.ndarray) -> None:
        chunks = [raw[a:b] for a, b in zip(start, end)]
        spaced = np.array([len(c) > 1 and c[0] == 0x20 and self.solid[c[1]] for c in chunks], bool)
        joined = [i for i in np.flatnonzero(spaced)]
        ids: list[np.ndarray] = []
        counts = np.zeros(len(chunks), np.int64)
        order = []
        if joined:
            found = self._encode(b"".join(chunks[i] for i in joined))
            ends = np.cumsum([len(chunks[i]) for i in joined])
            upto = np.searchsorted(np.cumsum(self.size[found]), ends, "left") + 1
            counts[joined] = np.diff(upto, prepend=0)
            ids.append(found)
            order += joined
        for i in np.flatnonzero(~spaced):
            ids.append(self._encode(chunks[i]))
            counts[i] = len(ids[-1])
            order.append(i)
        order = np.array(order, np.int64)
        low = np.empty(len(chunks), np.int64)
        low[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.ids = np.concatenate([self.ids, *ids])
        codes = np.concatenate([self.codes, code])
        by_code = np.argsort(codes, kind="stable")
        self.codes = codes[by_code]
        self.low = np.concatenate([self.low, low])[by_code]
        self.count = np.concatenate([self.count, counts])[by_code]

    def _encode(self, raw: bytes) -> np.ndarray:
        """Ids of a text. A long run of blanks is a piece of its own, but for its last one where
        text follows; it is not left to the pattern, which would try it blank by blank."""
        text, parts, at = raw.decode(), [], 0
        for run in LONG_BLANKS.finditer(text):
            ends = run.end() == len(text) or text.startswith(tuple(SPECIAL), run.end())
            stop = run.end() - (not ends)
            parts.append(self.encoding.encode(text[at : run.start()], allowed_special="all"))
            parts.append(self.encoding._encode_single_piece(text[run.start() : stop]))
            at = stop
        parts.append(self.encoding.encode(text[at:], allowed_special="all"))
        return np.concatenate([np.array(p, np.int32) for p in parts])

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds of the rows in them)``."""
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] = (data[:-1] == 0x20) & self.solid[data[1:]] if len(data) else False
        cut[bounds[:-1]] = True
        start = np.flatnonzero(cut[: len(data)])
        end = np.append(start[1:], len(data))
        code = self.reader._codes(data, start, end)
        distinct, at, place = np.unique(code, return_index=True, return_inverse=True)
        if len(self.codes) > MAX_KNOWN:
            self._forget()
        known = np.searchsorted(self.codes, distinct)
        new = np.ones(len(distinct), bool)
        inside = known < len(self.codes)
        new[inside] = self.codes[known[inside]] != distinct[inside]
        if new.any():
            self._learn(data.tobytes(), start[at[new]], end[at[new]], distinct[new])
        slot = np.searchsorted(self.codes, distinct)[place]
        count = self.count[slot]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(self.low[slot] - (ends - count), count) + np.arange(count.sum())]
        of_row = np.searchsorted(start, bounds)
        return ids, np.append(0, ends)[of_row]


def pieces_udf(path: str, length: int, end_id: int, with_ids: bool):
    """Text to its pieces: ``array<struct<start, length, ids_crc32[, ids]>>``."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = ChunkTokenizer(path)
        for column in columns:
            per_row, start, size, crc, parts = [], [], [], [], []
            for low, high, data, bounds in slices(column, SLICE):
                ids, ends = tokenizer.encode(data, bounds)
                for row in range(high - low):
                    own = np.append(ids[ends[row] : ends[row + 1]], np.int32(end_id))
                    cuts = [0, *range(len(own) % length or length, len(own) + 1, length)]
                    per_row.append(len(cuts) - 1)
                    for a, b in zip(cuts, cuts[1:]):
                        start.append(a)
                        size.append(b - a)
                        crc.append(zlib.crc32(own[a:b].astype("<u4").tobytes()))
                        if with_ids:
                            parts.append(own[a:b])
            arrays = [pa.array(x, pa.int64()) for x in (start, size, crc)]
            names = ["start", "length", "ids_crc32"]
            if with_ids:
                offsets = np.append(0, np.cumsum(size)).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *parts])
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            yield pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(per_row)).astype(np.int32)),
                pa.StructArray.from_arrays(arrays, names=names),
            )

    fields = "start: bigint, length: bigint, ids_crc32: bigint"
    return F.arrow_udf(run, f"array<struct<{fields}{', ids: array<int>' * with_ids}>>")


Bins = list[tuple[tuple[tuple[int, int], ...], int]]  # (length, how many) in a bin; so many bins


def reduce_bins(counts: dict[int, int], capacity: int) -> Bins:
    """Take the sets that dominate all others out of ``counts``."""
    fixed: Bins = []

    def without(*taken: int) -> list[int]:
        own = Counter(taken)
        return [x for x in sorted(counts) if counts[x] > own[x]]

    def smallest(n: int, w: int) -> list[int]:
        found: list[int] = []
        for x in without(w):
            found += [x] * min(n, counts[x] - (x == w))
            if len(found) >= n:
                break
        return found[:n]

    def chosen(w: int) -> tuple[int, ...] | None:
        room, least = capacity - w, smallest(3, w)
        if not least or least[0] > room:
            return (w,)
        best = max(x for x in without(w) if x <= room)
        if best == room or len(least) < 2 or least[0] + least[1] > room:
            return (w, best)
        if len(least) == 3 and sum(least) <= room:
            return None
        second = [x for x in without(w, best) if x <= room - best]
        if not second:
            return None
        others = without(w)
        lesser = [
            y
            for i, y in enumerate(others)
            if (counts[y] - (y == w) > 1 and 2 * y <= room)
            or (i + 1 < len(others) and y + others[i + 1] <= room)
        ]
        return (w, best, second[-1]) if max(lesser) <= second[-1] else None

    changed = True
    while changed:
        changed = False
        for w in sorted(counts, reverse=True):
            while counts.get(w) and (group := chosen(w)):
                need = Counter(group)
                times = min(counts[x] // n for x, n in need.items())
                fixed.append((tuple(need.items()), times))
                for x, n in need.items():
                    counts[x] -= n * times
                    if not counts[x]:
                        del counts[x]
                changed = True
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Best fit, longest first; bins with equal content are handled together."""
    open_bins: dict[int, Bins] = {}
    for w in sorted(counts, reverse=True):
        left = counts[w]
        while left:
            rooms = [r for r, bins in open_bins.items() if r >= w and bins]
            room = min(rooms, default=capacity)
            each = room // w
            content, n = open_bins[room].pop() if rooms else ((), -(-left // each))
            full, rest = min(n, left // each), left % each
            if full:
                open_bins.setdefault(room - each * w, []).append(((*content, (w, each)), full))
            left -= full * each
            if full < n and left:
                open_bins.setdefault(room - rest * w, []).append(((*content, (w, rest)), 1))
                full, left = full + 1, 0
            if rooms and full < n:
                open_bins[room].append((content, n - full))
    return [group for bins in open_bins.values() for group in bins]


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, low, high, bin, in_bin, offset)``."""
    counts = {int(k): int(n) for k, n in counts.items() if n}
    bins = reduce_bins(counts, capacity)
    bins += best_fit(counts, capacity)
    runs, used, number = [], Counter(), 0
    for content, n in bins:
        offset = 0
        for length, each in content:
            low = used[length]
            used[length] += each * n
            runs.append((length, low, used[length], number, each, offset))
            offset += length * each
        number += n
    return runs


RESULTS = ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


def pack_documents(
    df: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    end_id: int = 2,
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """A row for each piece: the columns of ``df`` and those named in RESULTS.

    The text itself is carried only if it is asked for by ``with_ids``, which adds the ids.
    """
    skip = RESULTS if with_ids else (*RESULTS, text_col)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    cut = pieces_udf(vocabulary, capacity, end_id, with_ids)(text)
    pieces = (
        df.select(
            F.struct(
                F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in df.columns if c not in skip]
            ).alias("row"),
            cut.alias("pieces"),
        )
        .select("row", F.posexplode("pieces").alias("piece", "cut"))
        .select(
            "row",
            "piece",
            "cut.*",
            F.monotonically_increasing_id().alias("place"),
        )
    )
    pieces = stage(pieces, "pieces")
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    runs = plan_bins({r["length"]: r["n"] for r in counted}, capacity)
    plan = df.sparkSession.createDataFrame(
        runs,
        "length bigint, low bigint, high bigint, bin bigint, in_bin bigint, at bigint",
    )
    lean = pieces.select("place", "length")
    ranked = global_index(
        lean,
        order=[F.col("place")],
        levels=[F.shiftright("place", PLACE_BITS)],
        within=["length"],
        name="rank",
    )
    nth = F.col("rank") - F.col("low")
    # A few runs for each length, however many pieces there are.
    seated = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "size")),
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("low"))
        & (F.col("rank") < F.col("high")),
    ).select(
        "place",
        (F.col("bin") + F.floor(nth / F.col("in_bin"))).alias("sequence_id"),
        (F.col("at") + (nth % F.col("in_bin")) * F.col("length")).alias("offset"),
    )
    return pieces.join(seated, "place").select(
        "row.*", *[c for c in RESULTS if c in pieces.columns or c in seated.columns]
    ).drop("_")


def assemble(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` from pieces with ids; a sequence is no longer than the capacity."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(in_order["ids"]).alias("ids"))
