"""Hard negatives by a multiway hyperplane tree with range tables (GNAT) and exact leaves.

An anchor's positives are the rows of its label with the greatest inner products; a positive's
negatives are the rows of other labels whose score is within a window below that of the positive,
greatest first. Components are scaled and floored, so scores are exact integers.

Equal vectors of one label are one point. It keeps its first ids only, as many as any result can
name: all of them score alike, so ids beyond can't be among the first. Anchors that are one point are
one query. That takes the weight out of groups of copies before anything is shuffled.

The tree (``hyperplane_tree``) is fitted on a sample of at most ``2 * SAMPLE`` points, chosen by their
hash; all points narrow its distance ranges, and all are put in its leaves. A part is a run of small
leaves or an even share of a large one, PART points at most. A query goes to the parts with leaves
that its annulus can reach, from its best possible score down to the last positive, or to the last
negative, that is known so far, and in a part it only meets those leaves. A part's points come first,
and all queries sent to it pass by; scores are matrix products, taken whole, and each part sends on
no more rows than the result can hold. So the search is exact, no group grows beyond a part, and a
pair is compared at most once.

Known at first are the rows of the sample. As a part can't know what others hold, all parts together
would send on far more than is kept. So points are searched in waves, chosen by hash: each reaches
about WAVE times the points of those before and starts from the last rows that they left. What a wave
sends on is about WAVE times the result, whatever the number of points and parts.

Rows with a null label, a null vector, or a null or non-finite component take no part. Rows equal in
id, label and vector are one row; a null id comes after all others. Ties go to the smaller id. Vectors
of different lengths are compared as if the shorter ended in zeros. Scores beyond 53 bits stop the
job. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnspool.llm.hyperplane_tree import HyperplaneTree
from turnspool.llm.words import mix
from turnspool.staging import stage

LAST = (1 << 63) - 1
NONE = -(1 << 62)  # below every score

FANOUT = 16
LEVELS = 3
LEAF = 4096  # points that a leaf should have
SAMPLE = 8192
PART = 1 << 18
PART_BYTES = 1 << 26  # as they are multiplied
BLOCK = 1024  # points of the smallest part worth a task
QUERIES = 1024  # queries of a packed row
WAVE = 8
WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)
MASK = (1 << 30) - 1  # bits of a point's hash that deal points to the sample and to waves
DEPTH = 256  # scores of the sample that are sorted
TILE, STRIP = 256, 8192  # queries and points of a matrix product
WAITING = 1 << 19  # rows found before the best are sorted out

POINT = "id bigint, label bigint, k1 bigint, k2 bigint, norm bigint, q binary"


def quantized(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, matrix)``: which rows are whole, and their scaled floors, ended in zeros."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())
    good = np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    bad = np.append(0, np.cumsum(~good))
    rows = np.flatnonzero(bad[ends] == bad[ends - sizes])
    width = int(sizes.max(initial=0))
    matrix = np.zeros((len(sizes), width))
    matrix[np.arange(width) < sizes[:, None]] = np.where(
        good, flat.fill_null(0).to_numpy(zero_copy_only=False), 0
    )
    matrix = np.floor(matrix[rows] * scale)
    if (matrix * matrix).sum(1).max(initial=0) >= 2.0**53:
        raise ValueError("scores are beyond 53 bits")
    return rows, matrix.astype(np.int64)


def point_keys(matrix: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Two hashes of vector and label; zeros at the end make no difference."""
    keys = []
    for seed in (11, 12):
        factor = np.random.default_rng(seed).integers(0, 2**64, matrix.shape[1], dtype=np.uint64)
        total = np.zeros(len(matrix), np.uint64)
        for k in range(matrix.shape[1]):
            total += mix(matrix[:, k].astype(np.uint64) * (factor[k] | np.uint64(1))) * (
                matrix[:, k] != 0
            )
        keys.append(mix(total ^ mix(label.astype(np.uint64) + np.uint64(seed))))
    return keys


def emit_points(scale: float, keep: int | None):
    """Rows to points. With ``keep``, no more than so many ids of a point leave a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = quantized(batch.column(2), scale)
            ids = batch.column(0).to_numpy()[rows]
            label = batch.column(1).to_numpy()[rows]
            k1, k2 = point_keys(matrix, label)
            order = np.lexsort((ids, k2, k1))
            if keep is not None and len(order):
                a, b, i = k1[order], k2[order], ids[order]
                other = np.ones(len(order), bool)
                other[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                new = other.copy()
                new[1:] |= i[1:] != i[:-1]
                nth = np.cumsum(new)
                head = np.maximum.accumulate(np.where(other, nth, 0))
                order = order[new & (nth - head < keep)]
            matrix = matrix[order]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[order]),
                    pa.array(label[order]),
                    pa.array(k1[order].view(np.int64)),
                    pa.array(k2[order].view(np.int64)),
                    pa.array((matrix * matrix).sum(1)),
                    stored(matrix),
                ],
                names=["id", "label", "k1", "k2", "norm", "q"],
            )

    return run


def stored(matrix: np.ndarray) -> pa.Array:
    """Vectors as int16, or as int32 and one more byte where a component needs it.

    Zeros at the end are left out, so that equal points are equal bytes.
    """
    width = matrix.shape[1]
    size = np.where(matrix != 0, np.arange(1, width + 1), 0).max(1, initial=0)
    wide = np.abs(matrix).max(1, initial=0) > 32767
    if wide.any():
        raw = [
            r[:n].astype("<i4").tobytes() + b"\0" if w else r[:n].astype("<i2").tobytes()
            for r, n, w in zip(matrix, size, wide)
        ]
        return pa.array(raw, pa.binary())
    flat = matrix.astype("<i2")[np.arange(width) < size[:, None]]
    ends = np.append(0, np.cumsum(2 * size)).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(flat)]
    )


def width_of(q: Column) -> Column:
    n = F.octet_length(q)
    return F.when(n % 2 == 0, n / 2).otherwise((n - 1) / 4).cast("int")


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as stored, as rows of ``width``, int16 unless one needs int32."""
    n = len(column)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    if not n or not width or data is None:
        return np.zeros((n, width), np.int16)
    ends = np.frombuffer(ends, kind)[column.offset : column.offset + n + 1]
    size = np.diff(ends)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    if (size % 2).any():
        out = np.zeros((n, width), np.int32)
        for r, (a, m) in enumerate(zip(ends - ends[0], size)):
            v = data[a : a + m // 2 * 2].view("<i4" if m % 2 else "<i2")
            out[r, : len(v)] = v
        return out
    flat = data.view("<i2")
    if (size == 2 * width).all():
        return flat.reshape(n, width)
    out = np.zeros((n, width), np.int16)
    out[np.arange(width) < (size // 2)[:, None]] = flat
    return out


class Space:
    """What tasks need to know: the tree, the sample, and how to multiply without rounding."""

    def __init__(self, width: int, square: int):
        self.width, self.square = width, square
        # A product's partial sums are no greater than the largest squared norm.
        self.exact = np.float32 if square < 1 << 24 else np.float64
        self.whole = np.int16 if square < 1 << 30 else np.int32

    def fit(self, sample: pa.Table, n_points: int) -> None:
        levels = math.ceil(math.log(max(2, n_points / LEAF), FANOUT))
        self.sample = self.matrix(sample["q"].combine_chunks())
        self.sample_label = sample["label"].to_numpy()
        self.sample_ids = sample["n_ids"].to_numpy()
        self.tree = HyperplaneTree.fit(
            self.sample, float(self.square), FANOUT, min(max(levels, 1), LEVELS)
        )

    def matrix(self, column: pa.Array) -> np.ndarray:
        return matrix_of(column, self.width).astype(self.whole, copy=False)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(self.exact, copy=False) @ b.astype(self.exact, copy=False).T


class Parts:
    """Leaves to parts: ``base`` and ``shares`` of each leaf, and the leaves of each part."""

    def __init__(self, sizes: np.ndarray, most: int):
        self.base = np.zeros(len(sizes), np.int64)
        self.shares = np.ones(len(sizes), np.int64)
        self.leaves: list[tuple[int, int]] = []
        room = -1
        for leaf, n in enumerate(sizes):
            if n > most:
                self.shares[leaf] = -(-n // most)
                self.base[leaf] = len(self.leaves)
                self.leaves += [(leaf, leaf + 1)] * int(self.shares[leaf])
                room = -1
                continue
            if n > room:
                self.leaves.append((leaf, leaf + 1))
                room = most
            self.leaves[-1] = (self.leaves[-1][0], leaf + 1)
            self.base[leaf] = len(self.leaves) - 1
            room -= n


RANGES = "node int, i int, j int, low double, high double, n bigint"


def emit_ranges(space):
    """The distance ranges of a task's points, and as node -1 how many each leaf has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space.value
        tree = own.tree
        low, high = tree.empty_ranges()
        sizes = np.zeros(tree.n_leaves, np.int64)
        for batch in batches:
            leaf = tree.leaves(own.matrix(batch.column("q")), low, high)
            sizes += np.bincount(leaf, minlength=tree.n_leaves)
        found = [np.nonzero(np.isfinite(a)) for a in low]
        leaf = np.flatnonzero(sizes)
        none = np.zeros(len(leaf))
        columns = [
            [*(np.full(len(i), k) for k, (i, _) in enumerate(found)), np.full(len(leaf), -1)],
            [*(i for i, _ in found), leaf],
            [*(j for _, j in found), np.zeros(len(leaf))],
            [*(a[at] for a, at in zip(low, found)), none],
            [*(a[at] for a, at in zip(high, found)), none],
            [*(np.zeros(len(i)) for i, _ in found), sizes[leaf]],
        ]
        kinds = [np.int32] * 3 + [np.float64] * 2 + [np.int64]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(k)) for c, k in zip(columns, kinds)],
            names=[field.split()[0] for field in RANGES.split(", ")],
        )

    return run


SENT = (
    "part int, kind int, leaf int, label bigint, q binary, ids array<bigint>, "
    "keys binary, vectors binary, own binary, entries binary, alive binary"
)
POINTS, ASKED = 0, 1  # kinds: the points of a part come first


def sent(part: np.ndarray, kind: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch of SENT; what is not given is null."""
    n = len(part)
    columns |= {"part": pa.array(part, pa.int32()), "kind": pa.array(np.full(n, kind, np.int32))}
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    names, arrays = [], []
    for field in SENT.split(", "):
        name, kind_ = field.split()
        names.append(name)
        arrays.append(columns.get(name, pa.nulls(n, types.get(kind_, pa.list_(pa.int64())))))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def emit_points_of_parts(space, parts: Parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space.value
        for batch in batches:
            leaf = own.tree.leaves(own.matrix(batch.column("q")))
            part = parts.base[leaf] + batch.column("k2").to_numpy() % parts.shares[leaf]
            yield sent(
                part,
                POINTS,
                leaf=pa.array(leaf, pa.int32()),
                **{c: batch.column(c) for c in ("label", "q", "ids")},
            )

    return run


def greatest(scores: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` greatest of each line, greatest first, and how many rows they are up to each."""
    n = min(n, scores.shape[1])
    if n < scores.shape[1]:
        at = np.argpartition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n :]
    else:
        at = np.broadcast_to(np.arange(n), scores.shape)
    best = np.take_along_axis(scores, at, 1)
    order = np.argsort(-best, axis=1)
    return (
        np.take_along_axis(best, order, 1),
        np.cumsum(rows[np.take_along_axis(at, order, 1)], axis=1),
    )


def kth_below(best: np.ndarray, total: np.ndarray, most: np.ndarray, k: int):
    """The score of the k-th row at or below ``most``, and where ``best`` ends before it.

    NONE where it ends, or where no more rows take part.
    """
    if not best.shape[1]:
        return np.full(len(best), NONE), np.zeros(len(best), bool)
    line = np.arange(len(best))
    above = (best > most[:, None]).sum(1)
    before = np.where(above > 0, total[line, above - 1], 0)
    enough = total >= (before + k)[:, None]
    last = best[line, enough.argmax(1)].astype(np.float64)
    there = enough.any(1) & np.isfinite(last)
    ends = ~enough.any(1) & np.isfinite(best[:, -1])
    return np.where(there, np.where(there, last, 0).astype(np.int64), NONE), ends


def emit_routes(space, parts: Parts, k: int, window: tuple[int, int] | None, first: bool):
    """Queries to the parts they must see, packed.

    An entry is the score of a positive and the least score asked for. Without ``window`` there is
    one entry a query: the greatest scores of the own label. ``first``: nothing was searched before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space.value
        for batch in batches:
            # By label, as in a search of the own label a tile only meets the labels it has.
            batch = batch.take(pc.sort_indices(batch.column("label")))
            for at in range(0, batch.num_rows, QUERIES):
                yield from routes(own, batch.slice(at, QUERIES))

    def known(own: Space, vectors, label, lo, hi) -> None:
        """Raise ``lo`` to the k-th best row that the sample has in the window."""
        rows = np.minimum(own.sample_ids, k)
        for at in range(0, len(vectors), TILE):
            some = slice(at, at + TILE)
            scores = own.scores(vectors[some], own.sample)
            same = label[some, None] == own.sample_label[None, :]
            scores = np.where(same == (window is None), scores, -np.inf)
            best, total = greatest(scores, rows, DEPTH)
            for nth in range(lo.shape[1]):
                least, most = lo[some, nth], hi[some, nth]
                last, deeper = kth_below(best, total, most, k)
                # Few windows begin below the greatest; for those all are looked at.
                deeper = np.flatnonzero(deeper & (best.shape[1] < scores.shape[1]))
                if len(deeper):
                    all_ = greatest(scores[deeper], rows, scores.shape[1])
                    last[deeper] = kth_below(*all_, most[deeper], k)[0]
                lo[some, nth] = np.maximum(least, last)

    def routes(own: Space, some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = own.matrix(some.column("q"))
        label = some.column("label").to_numpy()
        keys = np.stack([some.column(c).to_numpy() for c in ("k1", "k2")], 1)
        size = some.column("scores").value_lengths().to_numpy(zero_copy_only=False)
        there = np.arange(size.max(initial=0)) < size[:, None]
        score, lo = np.zeros(there.shape, np.int64), np.full(there.shape, NONE)
        score[there] = some.column("scores").flatten().to_numpy(zero_copy_only=False)
        lo[there] = some.column("bounds").flatten().to_numpy(zero_copy_only=False)
        lo, hi = windows_of(score, lo, window)
        if first:
            known(own, vectors, label, lo, hi)
        lo[~there | (lo > hi)] = -NONE
        alive = own.tree.surviving(vectors, *bounds_of(lo, hi))
        entries = np.stack([score, lo], 2)
        for part, (a, b) in enumerate(parts.leaves):
            rows = np.flatnonzero(alive[:, a:b].any(1))
            if len(rows):
                arrays = {
                    "keys": keys[rows],
                    "vectors": vectors[rows],
                    "own": label[rows],
                    "entries": entries[rows],
                    "alive": np.packbits(alive[rows, a:b], axis=1),
                }
                raw = {c: pa.array([v.tobytes()], pa.binary()) for c, v in arrays.items()}
                yield sent(np.array([part]), ASKED, **raw)

    return run


def windows_of(score: np.ndarray, lo: np.ndarray, window: tuple[int, int] | None):
    """Least and greatest score that entries ask for; ``-NONE`` is the least of one that has none."""
    if window is None:
        return lo, np.full(lo.shape, -NONE)
    low, high = window
    return np.maximum(lo, -(-low * score // 100)), high * score // 100


def bounds_of(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all entries of a query."""
    return lo.min(1, initial=-NONE), np.where(lo <= hi, hi, NONE).max(1, initial=NONE)


FOUND = "k1 bigint, k2 bigint, positive_score bigint, score bigint, id bigint"


def best_of(entry: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k rows of each entry."""
    order = np.lexsort((ids, -score, entry))
    entry = entry[order]
    head = np.searchsorted(entry, entry)
    return order[np.arange(len(order)) - head < k]


def places(ok: np.ndarray) -> np.ndarray:
    """``np.flatnonzero``, eight at a time, as few are set."""
    ok = ok.ravel()
    if len(ok) % 8:
        return np.flatnonzero(ok)
    at = (8 * np.flatnonzero(ok.view(np.uint64))[:, None] + np.arange(8)).ravel()
    return at[ok[at]]


class Part:
    """The points of a part, by leaf and label."""

    def __init__(self, own: Space, batches: list[pa.RecordBatch]):
        self.x = np.empty((sum(b.num_rows for b in batches), own.width), own.exact)
        at = 0
        for b in batches:
            self.x[at : at + b.num_rows] = own.matrix(b.column("q"))
            at += b.num_rows
        self.label = np.concatenate([b.column("label").to_numpy() for b in batches])
        self.ids = np.concatenate(
            [b.column("ids").flatten().to_numpy(zero_copy_only=False) for b in batches]
        )
        self.n_ids = np.concatenate(
            [b.column("ids").value_lengths().to_numpy(zero_copy_only=False) for b in batches]
        ).astype(np.int64)
        self.begin = np.cumsum(self.n_ids) - self.n_ids
        self.first = self.ids[self.begin]
        leaf = np.concatenate([b.column("leaf").to_numpy() for b in batches])
        cuts = np.flatnonzero(np.diff(leaf, prepend=-1, append=-1))
        self.leaves = [(int(leaf[a]), int(a), int(b)) for a, b in zip(cuts, cuts[1:])]


class Asked:
    """Some queries in a part: their entries, and the best rows of each that were found so far."""

    def __init__(self, own: Space, row: dict, k: int, window: tuple[int, int] | None):
        self.own, self.k, self.same_label = own, k, window is None
        self.keys = np.frombuffer(row["keys"], np.int64).reshape(-1, 2)
        n = len(self.keys)
        self.vectors = np.frombuffer(row["vectors"], own.whole).reshape(n, own.width)
        self.label = np.frombuffer(row["own"], np.int64)
        entries = np.frombuffer(row["entries"], np.int64).reshape(n, -1, 2)
        self.score = entries[:, :, 0]
        self.lo, self.hi = windows_of(self.score, entries[:, :, 1].copy(), window)
        self.least, self.most = bounds_of(self.lo, self.hi)
        self.alive = np.unpackbits(
            np.frombuffer(row["alive"], np.uint8).reshape(n, -1), axis=1
        ).astype(bool)
        self.found: list[tuple] = []
        self.waiting = 0

    def meet(self, part: Part, first_leaf: int) -> None:
        for at in range(0, len(self.keys), TILE):
            tile = np.arange(at, min(at + TILE, len(self.keys)))
            vectors = self.vectors[tile].astype(self.own.exact)
            for a, b, rows in self.spans(part, tile, first_leaf):
                for low in range(a, b, STRIP):
                    strip = slice(low, min(b, low + STRIP))
                    if rows is None:
                        self.compare(part, tile, self.own.scores(vectors, part.x[strip]), low)
                    else:
                        scores = self.own.scores(vectors[rows], part.x[strip])
                        self.compare(part, tile[rows], scores, low)
        self.sort_out(part)

    def spans(self, part: Part, tile: np.ndarray, first_leaf: int) -> Iterator[tuple]:
        """Runs of points, and the rows of the tile that must see them, None for all of it.

        A tile meets a leaf as a whole if half of it must.
        """
        alive = self.alive[tile]
        counts = alive.sum(0)
        start = end = 0
        for leaf, a, b in part.leaves:
            nth = leaf - first_leaf
            if not counts[nth]:
                continue
            if self.same_label:
                labels = part.label[a:b]
                b = a + int(np.searchsorted(labels, self.label[tile[-1]], "right"))
                a += int(np.searchsorted(labels, self.label[tile[0]]))
            if 2 * counts[nth] < len(tile):
                yield a, b, np.flatnonzero(alive[:, nth])
            elif a == end:
                end = b
            else:
                yield start, end, None
                start, end = a, b
        yield start, end, None

    def compare(self, part: Part, rows: np.ndarray, scores: np.ndarray, low: int) -> None:
        least, most = (c[rows].astype(self.own.exact)[:, None] for c in (self.least, self.most))
        ok = scores >= least
        at = places(ok)
        if len(at) > ok.size // 64:
            ok &= scores <= most
            at = places(ok)
        if not len(at):
            return
        score = scores.ravel()[at]
        q, p = np.divmod(at, scores.shape[1])
        q, p = rows[q], p + low
        fits = (self.label[q] == part.label[p]) == self.same_label
        q, p, score = q[fits], p[fits], score[fits].astype(np.int64)
        n = self.lo.shape[1]
        for nth in range(n):
            inside = np.flatnonzero((score >= self.lo[q, nth]) & (score <= self.hi[q, nth]))
            if len(inside):
                self.found.append((q[inside] * n + nth, score[inside], p[inside]))
                self.waiting += len(inside)
                if self.waiting > WAITING:
                    self.sort_out(part)

    def sort_out(self, part: Part) -> None:
        """Keep the best points of each entry; the last of them is the least from now on."""
        if not self.found:
            return
        entry, score, point = (np.concatenate(c) for c in zip(*self.found))
        # No row that is kept is of a point behind k others.
        order = best_of(entry, score, part.first[point], self.k)
        entry, score, point = entry[order], score[order], point[order]
        self.found, self.waiting = [(entry, score, point)], 0
        last = np.flatnonzero(np.diff(entry, append=-1))
        full = last[np.diff(last, prepend=-1) == self.k]
        self.lo.flat[entry[full]] = np.maximum(self.lo.flat[entry[full]], score[full])
        self.least, self.most = bounds_of(self.lo, self.hi)

    def rows(self, part: Part) -> pa.RecordBatch | None:
        if not self.found:
            return None
        entry, score, point = self.found[0]
        size = np.minimum(part.n_ids, self.k)[point]
        nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        ids = part.ids[np.repeat(part.begin[point], size) + nth]
        entry, score = np.repeat(entry, size), np.repeat(score, size)
        order = best_of(entry, score, ids, self.k)
        entry = entry[order]
        keys = self.keys[entry // self.lo.shape[1]]
        columns = [*keys.T, self.score.ravel()[entry], score[order], ids[order]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in columns],
            names=["k1", "k2", "positive_score", "score", "id"],
        )


def emit_found(space, parts: Parts, k: int, window: tuple[int, int] | None):
    """The points of a part, then its queries, to the first k rows of each entry in the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = space.value
        now, pieces, points = None, [], None
        for batch in batches:
            part, kind = (batch.column(c).to_numpy() for c in ("part", "kind"))
            mark = 2 * part.astype(np.int64) + kind
            cuts = np.flatnonzero(np.diff(mark, prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                if part[a] != now:
                    now, pieces, points = part[a], [], None
                some = batch.slice(a, b - a)
                if kind[a] == POINTS:
                    pieces.append(some.select(["leaf", "label", "q", "ids"]))
                    continue
                if points is None and pieces:
                    points, pieces = Part(own, pieces), []
                if points is None:
                    continue
                for r in range(some.num_rows):
                    names = ("keys", "vectors", "own", "entries", "alive")
                    raw = {c: some.column(c)[r].as_buffer() for c in names}
                    asked = Asked(own, raw, k, window)
                    asked.meet(points, parts.leaves[now][0])
                    if (found := asked.rows(points)) is not None:
                        yield found

    return run


RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
    "negative_score bigint"
)


def mine_hard_negatives(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on the columns of ``df``. For each anchor and each of its first
    ``positives``: the first ``negatives`` whose score is ``low`` to ``high`` percent of that of the
    positive.
    """
    spark = df.sparkSession
    rows = df.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LAST)).alias("id"),
        F.col(f"`{label_col}`").cast("bigint").alias("label"),
        numbers(df, vector_col).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).filter(F.col("label").isNotNull() & F.col("vector").isNotNull())
    lean = rows.select("id", "label", "vector")
    keep = max(positives + 1, negatives)
    points = stage(distinct_points(lean.mapInArrow(emit_points(scale, keep), POINT), keep), "points")
    asked = rows.filter("anchor").select("id", "label", "vector")
    asked = stage(asked.mapInArrow(emit_points(scale, None), POINT).distinct(), "anchors")
    queries = stage(
        asked.groupBy("k1", "k2").agg(
            *[F.first(c).alias(c) for c in ("label", "norm", "q")], F.count(F.lit(1)).alias("n")
        ),
        "queries",
    )

    facts = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(width_of(F.col("q"))), F.lit(0)).alias("width"),
        F.coalesce(F.max("norm"), F.lit(0)).alias("square"),
    ).first()
    if not facts["n"]:
        return spark.createDataFrame([], RESULT)
    space = Space(facts["width"], facts["square"])
    space.fit(sample_of(points, facts["n"]), facts["n"])
    sizes = learn_ranges(space, points, spark.sparkContext.broadcast(space))
    shared = spark.sparkContext.broadcast(space)
    n_queries = queries.count()

    def search(some: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
        """The first k rows of each entry of some queries, with their ``rank``."""
        best = None
        limits = waves(facts["n"])
        for begin, end in zip([0, *limits], limits):
            parts = parts_of(spark, space, sizes * ((end - begin) / (MASK + 1)))
            hash_ = F.col("k1").bitwiseAND(MASK)
            wave = points.filter((hash_ >= begin) & (hash_ < end)).select("k2", "label", "q", "ids")
            asked = some if best is None else with_bounds(some, best, k)
            asked = asked.repartition(query_tasks(spark, n_queries), "k1", "k2")
            route = emit_routes(shared, parts, k, window, best is None)
            found = (
                wave.mapInArrow(emit_points_of_parts(shared, parts), SENT)
                .unionAll(asked.mapInArrow(route, SENT))
                .repartitionById(len(parts.leaves), "part")
                .sortWithinPartitions("part", "kind", "leaf", "label")
                .mapInArrow(emit_found(shared, parts, k, window), FOUND)
            )
            found = found if best is None else found.unionAll(best.drop("rank"))
            entry = Window.partitionBy("k1", "k2", "positive_score").orderBy(F.desc("score"), "id")
            best = found.withColumn("rank", F.row_number().over(entry)).filter(F.col("rank") <= k)
            # Written after each wave, so that no broadcast of what follows waits behind a search.
            best = stage(best, "best")
        return best

    in_order = F.array_sort(F.collect_list(F.struct("rank", "score", "id")))
    asked_for = queries.select(
        "k1", "k2", "label", "q",
        F.array(F.lit(0).cast("bigint")).alias("scores"),
        F.array(F.lit(NONE)).alias("bounds"),
    )
    near = search(asked_for, positives + 1, None)
    near = stage(near.groupBy("k1", "k2").agg(in_order.alias("near")), "positives")
    scores = F.array_distinct("near.score")
    windows = queries.join(near, ["k1", "k2"]).select(
        "k1", "k2", "label", "q",
        scores.alias("scores"),
        F.transform(scores, lambda _: F.lit(NONE)).alias("bounds"),
    )
    far = search(windows, negatives, (low, high))
    far = far.groupBy("k1", "k2", "positive_score").agg(in_order.alias("far"))
    results = far.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("positive_score", "far")).alias("windows")
    )
    return expanded(asked, queries, near.join(results, ["k1", "k2"]), positives)


def numbers(df: DataFrame, vector_col: str) -> Column:
    """The vector as floats or doubles. A cast of arrays makes an object of every component."""
    vector = F.col(f"`{vector_col}`")
    kind = df.select(vector).dtypes[0][1]
    return vector if kind in ("array<float>", "array<double>") else vector.cast("array<double>")


def distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """``(k1, k2, label, norm, q, ids)``: each point once, with its first ``keep`` ids.

    Tasks have dropped what is repeated in a batch, and sort out all but the first ids of their own
    before the shuffle.
    """
    in_order = Window.partitionBy("k1", "k2").orderBy("id")
    ids = F.sort_array(F.collect_set("id").over(in_order.rowsBetween(*WHOLE)))
    return (
        rows.withColumn("nth", F.dense_rank().over(in_order))
        .filter(F.col("nth") <= keep)
        .select(
            *["k1", "k2", "label", "norm", "q"],
            ids.alias("ids"),
            F.row_number().over(in_order).alias("row"),
        )
        .filter("row = 1")
        .drop("row")
    )


def share_of_sample(n_points: int) -> float:
    return min(1.0, SAMPLE / max(1, n_points))


def sample_of(points: DataFrame, n_points: int) -> pa.Table:
    """About SAMPLE points, chosen by their hash; ``2 * SAMPLE`` is never exceeded."""
    chosen = F.col("k1").bitwiseAND(MASK) < int(share_of_sample(n_points) * (MASK + 1))
    lean = points.filter(chosen).select("k1", "k2", "label", "q", F.size("ids").alias("n_ids"))
    some = lean.limit(2 * SAMPLE).toArrow()
    return some.take(pc.sort_indices(some, [("k1", "ascending"), ("k2", "ascending")]))


def waves(n_points: int) -> list[int]:
    """Where the waves end, as bounds of the hash; the first has the sample in it."""
    share = share_of_sample(n_points)
    n = max(1, round(math.log(1 / share, WAVE)))
    return [math.ceil(share ** ((n - i) / n) * (MASK + 1)) for i in range(1, n + 1)]


def parts_of(spark: SparkSession, space: Space, sizes: np.ndarray) -> Parts:
    """Parts that a worker can hold, and enough of them for all cores."""
    most = min(PART, PART_BYTES // (max(1, space.width) * space.exact().itemsize))
    even = sizes.sum() / (2 * spark.sparkContext.defaultParallelism)
    return Parts(np.ceil(sizes).astype(np.int64), max(1, min(most, max(BLOCK, math.ceil(even)))))


def query_tasks(spark: SparkSession, n_queries: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-n_queries // (8 * QUERIES)))


def with_bounds(queries: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """The queries, where entries that have k rows ask for no score below the last of them."""
    last = best.filter(F.col("rank") == k).groupBy("k1", "k2").agg(
        F.map_from_entries(F.collect_list(F.struct("positive_score", "score"))).alias("last")
    )
    bounds = F.transform("scores", lambda s: F.coalesce(F.col("last")[s], F.lit(NONE)))
    return queries.join(last, ["k1", "k2"], "left").withColumn("bounds", bounds).drop("last")


def learn_ranges(space: Space, points: DataFrame, shared) -> np.ndarray:
    """Give the tree its ranges; the points of each leaf. All are as few as the tree."""
    tree = space.tree
    ranges = (
        points.select("q")
        .mapInArrow(emit_ranges(shared), RANGES)
        .groupBy("node", "i", "j")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .toArrow()
    )
    tree.low, tree.high = tree.empty_ranges()
    sizes = np.zeros(tree.n_leaves, np.int64)
    at = [ranges[c].to_numpy() for c in ("node", "i", "j", "low", "high", "n")]
    for node, i, j, low, high, n in zip(*at):
        if node < 0:
            sizes[i] = n
        else:
            tree.low[node][i, j], tree.high[node][i, j] = low, high
    return sizes


def expanded(
    asked: DataFrame, queries: DataFrame, results: DataFrame, positives: int
) -> DataFrame:
    """Results of points to rows of anchors.

    Points with very many anchors, at most a thousand of them, have their results copied and their
    anchors dealt among the copies.
    """
    total = queries.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(10_000, total // 1000)
    hot = F.broadcast(
        queries.filter(F.col("n") > limit).select(
            "k1", "k2", F.ceil(F.col("n") / limit).cast("int").alias("salts")
        )
    )
    salts = F.coalesce("salts", F.lit(1))
    spread = (
        results.join(hot, ["k1", "k2"], "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("salts")
    )
    dealt = (
        asked.select(F.col("id").alias("anchor_id"), "k1", "k2", "norm")
        .join(hot, ["k1", "k2"], "left")
        .withColumn("salt", F.pmod(F.hash("anchor_id"), salts))
        .drop("salts")
    )
    others = F.filter(
        "near", lambda p: (p["id"] != F.col("anchor_id")) | (p["score"] != F.col("norm"))
    )
    each = dealt.join(spread, ["k1", "k2", "salt"]).select(
        "anchor_id", "windows", F.explode(F.slice(others, 1, positives)).alias("p")
    )
    window = F.filter("windows", lambda w: w["positive_score"] == F.col("p.score"))
    found = each.select("anchor_id", "p", F.explode(F.get(window, F.lit(0))["far"]).alias("n"))

    def named(column: Column) -> Column:
        return F.when(column != LAST, column)

    return found.select(
        named(F.col("anchor_id")).alias("anchor_id"),
        named(F.col("p.id")).alias("positive_id"),
        F.col("n.rank").alias("rank"),
        named(F.col("n.id")).alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
