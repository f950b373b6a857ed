"""Periodic runs of words, found by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2q)`` long,
that no neighbouring word extends with period q. On the diagonal of lag q, where a word is compared
with the one q places earlier, a run is a match of at least ``max(least - q, q)`` words. So the DP
walks the words, lets each earlier occurrence of a word prolong the match on its lag, and emits a run
where a match that is long enough ends. Two things keep the lags sparse, and none is left out:

- Lags below ``least`` are few and are walked word by word. A lag of g to 2g, for g = least, 2 least,
  4 least and so on, must match g words in a row at least, so there an "occurrence" is one of the
  word together with the g - 1 words behind it.
- Such a gram that has a period of at most g/2 lies inside a run that a smaller lag has emitted, and
  can occur at every place of it. Two such places of one run only lead to multiples of its period,
  which are no smallest periods; they are skipped. A match that goes through a skipped place is
  closed over it by comparing grams. A match that holds skipped places only lies across two runs of
  one period that touch, and its lag and ends follow from theirs.

All other grams occur at most four times within 2g words, so work is about n log n words for any
text, also for one word repeated a million times. Words are compared by 64-bit hashes, grams by
hashes that are mixed anew at each doubling.

A null or empty text has no words and no runs. Every row is on its own: ids, ties, repeated rows and
nulls in other columns make no difference. A long text is one row of one task; memory is some
hundred bytes a word. Extra columns stay, and the result columns replace columns of their names. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnspool.llm.substring_dedup import _joined as joined_words
from turnspool.llm.words import NOT_SPACE, Words, WordReader, mix, slices

LEAST = 12
# A skipped stretch inside a run of lag below 2g is shorter than this many g.
REACH = 4
FACTOR = np.uint64(0xD6E8FEB86659FD93)


class Runs(NamedTuple):
    """Places are those of all rows' words, one row after the other."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray

    def picked(self, which: np.ndarray) -> Runs:
        return Runs(*(column[which] for column in self))

    def smallest_periods(self) -> Runs:
        """A stretch with several periods is a run of the smallest one only."""
        order = np.lexsort((self.period, self.end, self.start))
        ordered = self.picked(order)
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(ordered.start) != 0) | (np.diff(ordered.end) != 0)
        return ordered.picked(new)


def no_runs() -> Runs:
    return Runs(*(np.zeros(0, np.int64) for _ in range(3)))


def joined(parts: list[Runs]) -> Runs:
    return Runs(*(np.concatenate(columns) for columns in zip(no_runs(), *parts)))


def near_diagonals(code: np.ndarray, row: np.ndarray, least: int) -> list[Runs]:
    """Runs of lags below ``least``, each diagonal walked from end to end."""
    found = []
    for lag in range(1, min(least, len(code))):
        match = np.zeros(len(code) - lag + 2, bool)
        match[1:-1] = (code[lag:] == code[:-lag]) & (row[lag:] == row[:-lag])
        edges = np.flatnonzero(match[1:] != match[:-1])
        begin, end = edges[::2], edges[1::2]
        long = end - begin >= max(least - lag, lag)
        begin, end = begin[long], end[long]
        found.append(Runs(begin, end + lag, np.full(len(begin), lag)))
    return found


class Grams:
    """Hashes of all runs of g words by their first word, for g = 1, 3, 6, 12 or so, doubled on."""

    def __init__(self, code: np.ndarray, least: int):
        self.levels = [(1, code)]
        size, odd = least, []
        while size > 1:
            odd.append(size % 2)
            size //= 2
        for one_more in reversed(odd):
            self.double(one_more)

    def double(self, one_more: int = 0) -> None:
        size, gram = self.levels[-1]
        twice = self._after(gram, gram, size)
        if one_more:
            twice = self._after(twice, self.levels[0][1], 2 * size)
        self.levels.append((2 * size + one_more, twice))

    @staticmethod
    def _after(gram: np.ndarray, other: np.ndarray, by: int) -> np.ndarray:
        n = max(0, len(other) - by)
        return mix(gram[:n] * FACTOR + mix(other[by : by + n]))

    def matches(
        self, at: np.ndarray, lag: np.ndarray, room: np.ndarray, step: int
    ) -> np.ndarray:
        """How many words from ``at`` on (step 1) or before ``at`` (step -1) equal those ``lag``
        words later, at most ``room``."""
        length = np.zeros(len(at), np.int64)
        for size, gram in reversed(self.levels):
            live = np.arange(len(at))
            while len(live):
                live = live[length[live] + size <= room[live]]
                x = at[live] + (length[live] if step > 0 else -length[live] - size)
                live = live[gram[x] == gram[x + lag[live]]]
                length[live] += size
        return length


def far_diagonals(
    grams: Grams, code: np.ndarray, row: np.ndarray, first: np.ndarray, known: list[Runs], least: int
) -> Iterator[Runs]:
    """Runs of lags from ``least`` on, scale by scale; ``known`` are those of smaller lags."""
    known = list(known)
    # Only a place whose gram comes again in its row can start a match.
    live = np.arange(len(code))
    ends = first[1:]
    while True:
        g, gram = grams.levels[-1]
        live = live[live + g <= ends[row[live]]]
        live = live[np.diff(first)[row[live]] >= 2 * g]
        key = mix(gram[live] ^ mix(row[live].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        live, key = live[order], key[order]
        again = np.zeros(len(live), bool)
        again[1:] = key[1:] == key[:-1]
        again[:-1] |= again[1:]
        live, key = live[again], key[again]
        if not len(live):
            return
        runs = joined(known).smallest_periods()
        inside = runs.picked((2 * runs.period <= g) & (runs.end - runs.start >= g))
        matches = matches_of(live, key, gram, g, inside, len(code))
        matches += matches_across(code, row, inside, g)
        found = maximal(grams, matches, row, first, g, least)
        known.append(found)
        yield found
        live = np.sort(live)
        grams.double()


Match = tuple[np.ndarray, np.ndarray, np.ndarray]  # lag, first word, word behind the last


def matches_of(
    place: np.ndarray, key: np.ndarray, gram: np.ndarray, g: int, inside: Runs, n: int
) -> list[Match]:
    """Matches of at least g words: occurrences that follow each other on a diagonal."""
    if len(inside.start):
        depth = np.bincount(inside.start, minlength=n + 1).astype(np.int64)
        depth -= np.bincount(inside.end - g + 1, minlength=n + 1)
        free = np.cumsum(depth)[place] == 0
        place, key = place[free], key[free]
    pairs: list[Match] = []
    for k in range(1, REACH):
        if len(place) <= k:
            break
        lag = place[k:] - place[:-k]
        near = np.flatnonzero((key[k:] == key[:-k]) & (lag >= g) & (lag < 2 * g))
        lag, at = lag[near], place[near]
        order = np.lexsort((at, lag))
        lag, at = lag[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(lag) != 0) | (np.diff(at) != 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(at)) - 1
        if len(heads):
            pairs.append((lag[heads], at[heads], at[tails] + g))
    return pairs


def matches_across(code: np.ndarray, row: np.ndarray, inside: Runs, g: int) -> list[Match]:
    """Matches that lie across two runs of one period that touch.

    Both repeat the same words, so all lags are one number apart; which, tells the place of the
    second run's first period in the first run.
    """
    order = np.lexsort((inside.start, inside.period))
    start, end, period = inside.picked(order)
    touching = np.flatnonzero(
        (period[1:] == period[:-1]) & (start[1:] <= end[:-1]) & (row[start[1:]] == row[start[:-1]])
    )
    found: list[Match] = []
    for i in touching:
        s1, e1, s2, e2, d = start[i], end[i], start[i + 1], end[i + 1], period[i]
        root = code[s2 : s2 + d]
        for p in s1 + np.flatnonzero(code[s1 : s1 + d] == root[0]):
            if np.array_equal(code[p : p + d], root):
                shift = int(s2 - p) % d
                lag = np.arange(g + (shift - g) % d, 2 * g, d)
                low, high = np.maximum(s1, s2 - lag), np.minimum(e2, e1 + lag) - lag
                long = high - low >= lag
                found.append((lag[long], low[long], high[long]))
                break
    return found


def maximal(
    grams: Grams, matches: list[Match], row: np.ndarray, first: np.ndarray, g: int, least: int
) -> Runs:
    """Matches to where they end, and of those the runs."""
    if not matches:
        return no_runs()
    lag, low, high = (np.concatenate(c).astype(np.int64) for c in zip(*matches))
    of = row[low]
    reach = np.int64(REACH * g)
    low = low - grams.matches(low, lag, np.minimum(low - first[of], reach), -1)
    high = high + grams.matches(high, lag, np.minimum(first[of + 1] - lag - high, reach), 1)
    order = np.lexsort((high, low, lag))
    lag, low, high = lag[order], low[order], high[order]
    # Matches of one lag that overlap or touch are one.
    new = np.ones(len(lag), bool)
    if len(lag):
        span = np.int64(first[-1] + 1)
        upto = np.maximum.accumulate(high + lag * span) - lag * span
        new[1:] = (np.diff(lag) != 0) | (low[1:] > upto[:-1])
    heads = np.flatnonzero(new)
    if not len(heads):
        return no_runs()
    lag, low, high = lag[heads], low[heads], np.maximum.reduceat(high, heads)
    long = high - low >= np.maximum(least - lag, lag)
    return Runs(low[long], high[long] + lag[long], lag[long])


def runs_of(code: np.ndarray, first: np.ndarray, least: int = LEAST) -> Runs:
    """All runs of all rows, by start and period."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    near = near_diagonals(code, row, least)
    far: list[Runs] = []
    if len(code) > least:
        far = list(far_diagonals(Grams(code, least), code, row, first, near, least))
    found = joined([*near, *far]).smallest_periods()
    return found.picked(np.lexsort((found.period, found.start)))


FIELDS = (
    "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
    "collapsed_text string"
)


def runs_udf(least: int):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = WordReader(NOT_SPACE, lower=False)
        for column in columns:
            parts = [pa.array([], TYPE)]
            for _, _, data, bounds in slices(column):
                parts.append(described(reader.read(data, bounds), data, least))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(run, FIELDS)


RUN = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
TYPE = pa.struct([("n_words", pa.int64()), ("runs", RUN), ("collapsed_text", pa.string())])


def described(words: Words, data: np.ndarray, least: int) -> pa.Array:
    """The result fields of each row."""
    first, total = words.first, len(words.start)
    runs = runs_of(words.code, first, least)
    of = np.searchsorted(first, runs.start, "right") - 1
    fields = [runs.start - first[of], runs.end - runs.start, runs.period]
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of, np.arange(len(first))).astype(np.int32)),
        pa.StructArray.from_arrays(
            [pa.array(f, pa.int64()) for f in fields], fields=list(RUN.value_type)
        ),
    )
    depth = np.bincount(runs.start + runs.period, minlength=total + 1).astype(np.int64)
    depth -= np.bincount(runs.end, minlength=total + 1)
    kept = np.cumsum(depth)[:total] == 0
    left = np.diff(np.append(0, np.cumsum(kept))[first])
    text = joined_words(data, words.start[kept], words.end[kept], left)
    return pa.StructArray.from_arrays(
        [pa.array(np.diff(first), pa.int64()), lists.cast(RUN), text], fields=list(TYPE)
    )


def find_periodic_runs(df: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` and ``collapsed_text``: what is left, joined by one space,
    when of every run only the first period stays. A map over the rows, without a shuffle."""
    results = ("n_words", "runs", "collapsed_text")
    carried = [F.col(f"`{c}`") for c in df.columns if c not in results]
    found = df.select(
        F.struct(F.lit(0).alias("_"), *carried).alias("row"),
        runs_udf(least)(F.col(f"`{text_col}`")).alias("found"),
    )
    return found.select("row.*", "found.*").drop("_")
