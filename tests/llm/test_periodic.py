"""Periodic runs against a search of every lag, on words that repeat in all ways."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SF_DIR
from turnspool.llm import queries
from turnspool.llm.periodic import find_periodic_runs, runs_of

CODES = np.random.default_rng(7).integers(0, 2**64, 16, dtype=np.uint64)


def plain_runs(words, least: int = 12) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` by start and period."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(least, 2 * q) and not any(
                all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q)
            ):
                found.append((start, end - start, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequence(rng: random.Random) -> list[int]:
    n, k = rng.randrange(160), rng.choice([1, 2, 2, 3, 5])
    kind = rng.randrange(7)
    if kind == 0:
        return [rng.randrange(k) for _ in range(n)]
    if kind == 1:  # Fibonacci words: grams come again at two distances
        a, b = [0], [0, 1]
        while len(b) < n + 2:
            a, b = b, b + a
        return b[:n]
    if kind == 2:
        out = []
        while len(out) < n:
            part = [rng.randrange(k + 1) for _ in range(rng.randrange(1, 30))]
            out += (part * rng.randrange(1, 8))[: rng.randrange(1, 200)]
        return out
    if kind == 3:  # long runs inside a longer period
        u, v = ([0] * rng.randrange(5, 40) + [x] for x in (1, 2))
        return [x for _ in range(rng.randrange(1, 6)) for x in rng.choice([u, v, u[1:], u + u])]
    if kind == 4:  # two runs of one period that touch
        root = [rng.randrange(3) for _ in range(rng.randrange(1, 6))] * 20
        cut = root[rng.randrange(len(root)) :]
        return root[: rng.randrange(10, 100)] + cut[: rng.randrange(10, 100)]
    if kind == 5:
        return (sequence(rng) * rng.randrange(1, 5))[:300]
    return [bin(i).count("1") % 2 for i in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_every_lag(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = [sequence(rng) for _ in range(rng.randrange(1, 6))]
        first = np.cumsum([0, *map(len, rows)])
        found = runs_of(CODES[np.array(sum(rows, []), int)], first)
        for at, row in zip(first, rows):
            own = found.picked((found.start >= at) & (found.end <= at + len(row)))
            got = zip((own.start - at).tolist(), (own.end - own.start).tolist(), own.period.tolist())
            assert list(got) == plain_runs(row), row


def test_a_word_repeated_half_a_million_times_is_one_run():
    n = 1 << 19
    found = runs_of(np.full(n, CODES[0]), np.array([0, n]))
    assert [c.tolist() for c in found] == [[0], [n], [1]]


def plain_digest(doc_id, text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    spelled = "".join("%d,%d,%d\n" % r for r in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (spelled, kept)]
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *numbers, *digests)


def test_the_query_gives_what_a_plain_search_gives(spark, monkeypatch):
    rows = [
        (r["doc_id"], r["text"])
        for r in queries.documents(spark, SF_DIR).select("doc_id", "text").collect()
        if len(r["text"] or "") < 2500
    ]
    rng = random.Random(3)
    rows += [(1000 + i, " \n".join(map(str, sequence(rng)))) for i in range(200)]
    rows += [(2000, None), (None, None), (None, "a " * 40), (2001, ""), (2002, " \t"), (2003, "ä " * 13)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(queries, "documents", lambda *_: table)
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, "").collect()), key=str)
    assert got == sorted(((i, *plain_digest(i, t)) for i, t in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and plain_digest(i, t)[0] for i, t in rows)


def test_extra_columns_clashing_names_and_empty_tables(spark):
    table = spark.createDataFrame(
        [("r", "x " * 30, 1, "k", "_"), (None, None, None, None, None)],
        "row string, text string, runs int, found string, `a.b` string",
    )
    got = find_periodic_runs(table)
    assert got.columns == ["row", "text", "found", "a.b", "n_words", "runs", "collapsed_text"]
    first, second = sorted(got.collect(), key=lambda r: -r["n_words"])
    assert first["runs"][0].asDict() == {"start": 0, "length": 30, "period": 1}
    assert first["collapsed_text"] == "x" and second["runs"] == [] and second["row"] is None
    assert find_periodic_runs(table.filter("false")).count() == 0
