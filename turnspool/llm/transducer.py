"""A byte-pair tokenizer compiled to a deterministic transducer that counts tokens.

The tokenizer starts from single characters and always joins the two neighbours that make the piece
of the highest score, the leftmost of equals. A sequence of pieces is what it makes of their text
exactly if it leaves every two neighbours of the sequence as they are. So the last piece of a text is
the one suffix that is a piece and stays apart from the last piece of what is before it. A state is a
node of the pieces' trie, the longest suffix that a piece can still continue, and for each of the
places that a piece can start at, the last piece before it and the count up to it. Reading a
character leads to the next state and emits by how many pieces the text up to there has more, or
fewer. A character that no piece holds is emitted as its bytes and leads back to the first state.

The trie with its suffix links is compiled beforehand, which pieces stay apart as pairs come up. There
are more states than one would list, so a state is kept as its parts, as many states side by side as
there are chunks of text.

A text is cut in chunks. Where a chunk starts at a word border, or behind a character that no piece
holds, its state is known. Any other chunk is a map from states to states and counts. It is found for
the states that the chunk before it can end in, all chunks side by side; then the maps are composed
by a parallel prefix scan.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from turnspool.llm.words import mix, powers

SPACE = "▁"
CHUNK = 128
# Letters whose transitions are a table; those of the others are searched for.
TABLED = 128
PAIR_BITS = 18
MAX_PAIR_BITS = 23
HASH = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Pairs of pieces that stay apart or not, in an open hash table of bounded size."""

    def __init__(self, bits: int = PAIR_BITS):
        self._clear(bits)

    def _clear(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, bool)

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key, and whether it is there; a key is never 0."""
        slot = ((keys * HASH) >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[slot]
        there = held == keys
        waiting = np.flatnonzero(~there & (held != 0))
        while len(waiting):
            slot[waiting] = (slot[waiting] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[waiting]]
            there[waiting] = held == keys[waiting]
            waiting = waiting[~there[waiting] & (held != 0)]
        return slot, there

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(known, value)``."""
        slot, there = self._slots(keys)
        return there, self.values[slot]

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct new keys."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = np.flatnonzero(self.keys)
            held = self.keys[old], self.values[old]
            full = self.bits == MAX_PAIR_BITS
            self._clear(self.bits if full else self.bits + 1)
            if not full:
                self.put(*held)
            self.put(keys, values)
            return
        self.used += len(keys)
        while len(keys):
            slot, _ = self._slots(keys)
            slot, first = np.unique(slot, return_index=True)
            self.keys[slot], self.values[slot] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values = keys[left], values[left]


class States(NamedTuple):
    """Many states; entry k of a row of ``last`` and ``count`` is for the place k characters back.
    Counts are relative to the one now."""

    node: np.ndarray
    last: np.ndarray
    count: np.ndarray

    def picked(self, which) -> States:
        return States(*(part[which] for part in self))


class Transducer:
    def __init__(self, scores: dict[str, float], space: str = SPACE):
        """``scores`` of all pieces that can be made by joining; ``space`` stands for blanks."""
        self.scores = scores
        letters = sorted({c for piece in scores for c in piece} | {space})
        nodes = {p[:i] for p in scores for i in range(len(p) + 1)} | set(letters) | {""}
        self.names = sorted(nodes, key=lambda n: (len(n), n))
        self._compile_nodes(letters)
        self.letter = np.zeros(1 << 21, np.int16)  # all that four bytes can say
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.space = int(self.letter[ord(space)])
        self.letter[0x20] = self.space
        # A blank after anything but a blank starts a new word.
        self.breaks = not any(
            p[i] == space and p[i - 1] != space for p in scores for i in range(1, len(p))
        )
        self.pairs = PairTable()

    def _compile_nodes(self, letters: list[str]) -> None:
        names, scores = self.names, self.scores
        number = {name: i for i, name in enumerate(names)}
        n = len(names)
        self.width = max(len(names[-1]), 1)
        self.depth = np.array([len(name) for name in names])
        suffix = np.zeros(n, np.int32)
        for i, name in enumerate(names):
            k = 1
            while k < len(name) and name[k:] not in number:
                k += 1
            suffix[i] = number[name[k:]]
        self.suffix = suffix
        # A single character is a piece too, of its bytes if it is not in the vocabulary.
        self.size = np.array(
            [1 if s in scores else len(s.encode()) if len(s) == 1 else 0 for s in names], np.int32
        )
        # The longest piece that a node ends in, and the next shorter one of a piece.
        self.piece, self.shorter = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.places = np.zeros((n, self.width), bool)
        for i in range(n):
            if i:
                self.shorter[i] = self.piece[suffix[i]]
                self.piece[i] = i if self.size[i] else self.shorter[i]
                self.places[i] = self.places[suffix[i]]
            if self.depth[i] < self.width:
                self.places[i, self.depth[i]] = True
        code = {c: i + 1 for i, c in enumerate(letters)}
        parent = np.array([number[name[:-1]] for name in names[1:]], np.int64)
        letter = np.array([code[name[-1]] for name in names[1:]], np.int64)
        often = np.argsort(-np.bincount(letter, minlength=len(letters) + 1), kind="stable")[:TABLED]
        self.column = np.full(len(letters) + 1, -1, np.int16)
        self.column[often] = np.arange(len(often))
        child = np.arange(1, n, dtype=np.int32)
        tabled = self.column[letter] >= 0
        self.table = np.zeros((n, TABLED), np.int32)
        for depth in range(self.width + 1):
            level = np.flatnonzero(self.depth == depth)
            if depth:
                self.table[level] = self.table[suffix[level]]
            below = tabled & (self.depth[parent] == depth)
            self.table[parent[below], self.column[letter[below]]] = child[below]
        rest = np.flatnonzero(~tabled)
        key = (parent[rest] << 16) | letter[rest]
        order = np.argsort(key)
        self.edge, self.edge_to = key[order], child[rest][order]

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The longest suffix that is a node, behind one letter more; 0 behind an unknown one."""
        column = self.column[letter].astype(np.int64)
        out = self.table.ravel().take(node * TABLED + np.maximum(column, 0))
        out[letter == 0] = 0
        rest = np.flatnonzero((column < 0) & (letter > 0))
        at = node[rest].astype(np.int64)
        while len(rest):
            key = (at << 16) | letter[rest]
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            found = self.edge[place] == key
            out[rest[found]] = self.edge_to[place[found]]
            rest, at = rest[~found], self.suffix[at[~found]].astype(np.int64)
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the tokenizer leaves pieces ``left`` and ``right`` as they are."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        known, value = self.pairs.get(keys)
        if not known.all():
            new = np.unique(keys[~known])
            names = self.names
            found = [
                self.stays(names[int(k) >> 32], names[int(k) & 0xFFFFFFFF]) for k in new
            ]
            value[~known] = np.array(found)[np.searchsorted(new, keys[~known])]
            self.pairs.put(new, np.array(found))
        return value

    def stays(self, left: str, right: str) -> bool:
        parts, border = [*left, *right], len(left)
        scores = self.scores
        joint = [scores.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, score in enumerate(joint):
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return True
            if at == border - 1:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joint[at]
            if at:
                joint[at - 1] = scores.get(parts[at - 1] + parts[at])
            if at < len(joint):
                joint[at] = scores.get(parts[at] + parts[at + 1])
            border -= at < border

    def first_states(self, n: int) -> States:
        shape = (n, self.width)
        return States(np.zeros(n, np.int32), np.zeros(shape, np.int32), np.zeros(shape, np.int32))

    def run(
        self, letters: np.ndarray, sizes: np.ndarray, begin: np.ndarray, end: np.ndarray, states: States
    ) -> tuple[States, np.ndarray]:
        """Read ``letters[begin:end]`` from many states side by side: the states that they end in,
        and what is emitted. ``sizes`` are the bytes of characters."""
        width = self.width
        order = np.argsort(begin - end, kind="stable")
        at, steps = begin[order], (end - begin)[order]
        # Place p of a chunk is in column p modulo the width; the chunk starts at place 0.
        turn = -np.arange(width) % width
        node, last, count = states.picked(order)
        node = node.astype(np.int64)
        last, count = (np.ascontiguousarray(x[:, turn]) for x in (last, count))
        flat_last, flat_count = last.ravel(), count.ravel()
        for step in range(int(steps[0]) if len(steps) else 0):
            n = int(np.searchsorted(-steps, -step, "left"))
            read = letters[at[:n] + step]
            node[:n] = self.step(node[:n], read)
            piece = self.piece[node[:n]]
            here = np.arange(n) * width
            new = np.zeros(n, np.int32)
            total = flat_count[here + step % width] + sizes[at[:n] + step]
            open_ = np.flatnonzero(read)
            tried = piece[open_]
            while len(open_):
                back = here[open_] + (step + 1 - self.depth[tried]) % width
                left = flat_last[back]
                ok = left == 0
                asked = np.flatnonzero(~ok)
                ok[asked] = self.apart(left[asked], tried[asked])
                done = open_[ok]
                new[done] = tried[ok]
                total[done] = flat_count[back[ok]] + self.size[tried[ok]]
                open_, tried = open_[~ok], self.shorter[tried[~ok]]
                if len(tried) and not tried.all():
                    raise ValueError("a text without a last piece: joins depend on more than scores")
            flat_last[here + (step + 1) % width] = new
            flat_count[here + (step + 1) % width] = total
        back = (steps[:, None] - np.arange(width)) % width
        count = np.take_along_axis(count, back, 1)
        emitted = count[:, 0].astype(np.int64)
        needed = self.places[node]
        last = np.where(needed, np.take_along_axis(last, back, 1), 0)
        count = np.where(needed, count - count[:, :1], 0)
        undo = np.argsort(order, kind="stable")
        return States(node.astype(np.int32), last, count).picked(undo), emitted[undo]

    def count(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Pieces of each row of UTF-8; row r is ``data[bounds[r]:bounds[r + 1]]``. A row that is
        not empty is read behind one blank more."""
        points, sizes, bounds = code_points(data, bounds)
        letters = self.letter[points]
        begin, known = self._chunks(letters, bounds)
        end = np.append(begin[1:], bounds[-1])
        states = self.first_states(len(begin))
        # The blank that is read first.
        opens = np.searchsorted(begin, bounds[:-1][np.diff(bounds) > 0])
        opening = int(self.step(np.zeros(1, np.int64), np.array([self.space]))[0])
        states.node[opens], states.last[opens, 0] = opening, opening
        if self.width > 1:
            states.count[opens, 1] = -1
        ends, total = self.run(letters, sizes, begin, end, states)
        if not known.all():
            total = self._composed(letters, sizes, begin, end, known, ends, total)
        # Chunks with a known state stand for all chunks up to the next of them.
        total = np.where(known, total, 0)
        total[opens] += 1
        sums = np.append(0, np.cumsum(total))
        return np.diff(sums[np.searchsorted(begin, bounds)])

    def _composed(self, letters, sizes, begin, end, known, ends: States, total) -> np.ndarray:
        """What is emitted from each chunk to the next with a known state."""
        goes_on = np.append(~known[1:], False)
        # Pairs of a chunk and a state to start it in. All chunks were first run from one state.
        chunk = np.arange(len(begin))
        start = self.first_states(1)
        marks = np.where(known, -1 - chunk, self._marks(start)[0])
        pairs = {(int(c), int(m)): i for i, (c, m) in enumerate(zip(chunk, marks)) if not known[c]}
        totals, follows, n_pairs = [total], [], len(chunk)
        first, pair_chunk = 0, chunk
        while True:
            on = np.flatnonzero(goes_on[pair_chunk])
            mark = self._marks(ends.picked(on))
            new, at = [], []
            for i, m in zip(on, mark):
                pair = (int(pair_chunk[i]) + 1, int(m))
                if pair not in pairs:
                    pairs[pair] = n_pairs + len(new)
                    new.append(pair[0])
                    at.append(i)
                follows.append((first + int(i), pairs[pair]))
            if not new:
                break
            first, n_pairs, pair_chunk = n_pairs, n_pairs + len(new), np.array(new)
            ends, total = self.run(
                letters, sizes, begin[pair_chunk], end[pair_chunk], ends.picked(at)
            )
            totals.append(total)
        follow = np.full(n_pairs + 1, n_pairs)
        come, go = np.array(follows).T
        follow[come] = go
        return scanned(follow, np.append(np.concatenate(totals), 0))[: len(begin)]

    def _marks(self, states: States) -> np.ndarray:
        """A hash of each state; no two of a text's states are taken for one but by its chance."""
        rows = np.hstack([states.node[:, None], states.last, states.count]).astype(np.uint64)
        factor = powers(int(HASH), rows.shape[1])
        return (mix((mix(rows) * factor).sum(1, dtype=np.uint64)) >> np.uint64(1)).astype(np.int64)

    def _chunks(self, letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(begin, known)``: chunks of about CHUNK characters, and whether their state is known."""
        border = np.zeros(len(letters) + 1, bool)
        if len(letters) > 1:
            border[1:-1] = letters[:-1] == 0
            if self.breaks:
                border[1:-1] |= (letters[1:] == self.space) & (letters[:-1] != self.space)
        filled = np.flatnonzero(np.diff(bounds))
        first, last = bounds[filled], bounds[filled + 1]
        blocks = -(-(last - first) // CHUNK)
        nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(first, blocks) + nth * CHUNK
        stop = np.minimum(begin + CHUNK, np.repeat(last, blocks))
        places = np.flatnonzero(border)
        next_ = np.append(places, len(letters) + 1)[np.searchsorted(places, begin)]
        at_border = (next_ < stop) & (nth > 0)
        return np.where(at_border, next_, begin), at_border | (nth == 0)


def scanned(follow: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The sum of ``total`` along the way from each place, by doubling; the last place is the end."""
    end = len(follow) - 1
    while (follow != end).any():
        total = total + total[follow]
        follow = follow[follow]
    return total


def code_points(
    data: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(code points, their bytes, row bounds in them)`` of UTF-8."""
    leads = (data & 0xC0) != 0x80
    if leads.all():
        if not (data >= 0x80).any():
            return data, np.ones(len(data), np.int32), bounds
    start = np.flatnonzero(leads)
    size = np.diff(np.append(start, len(data))).astype(np.int32)
    point = data[start].astype(np.int32)
    for n, bits in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        own = np.flatnonzero(size == n)
        value = point[own] & bits
        for k in range(1, n):
            value = (value << 6) | (data[start[own] + k] & 0x3F)
        point[own] = value
    return point, size, np.append(0, np.cumsum(leads))[bounds]
