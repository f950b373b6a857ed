import random
import re

import numpy as np
import pyarrow as pa

from turnspool.llm.words import ALNUM, NOT_SPACE, WordReader, grams, slices, utf8, windows_of

PATTERNS = {
    "space": (NOT_SPACE, r"[^\x20\x09-\x0D]+"),
    "item": (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
}

LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def random_text(rng: random.Random) -> str:
    return "".join(rng.choice("aAbB01 \t\n\x0b|-é世\U0001f600\x00") for _ in range(rng.randrange(40)))


def test_words_are_those_of_the_patterns():
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(300)] + [None, "", "x" * 70, "two\xa0words"]
    for rule, (table, pattern) in PATTERNS.items():
        # The pattern of items is for lowered text; the table takes both cases.
        if rule == "item":
            texts = [t and t.translate(LOWER) for t in texts]
        data, bounds = utf8(pa.array(texts))
        found = WordReader(table, lower=False).read(data, bounds)
        got = [
            [bytes(data[a:b]).decode() for a, b in zip(found.start[i:j], found.end[i:j])]
            for i, j in zip(found.first, found.first[1:])
        ]
        assert got == [re.findall(pattern, t or "") for t in texts]


def test_codes_tell_words_apart_and_may_ignore_case():
    words = ["ab", "ba", "Ab", "AB", "abc", "a", "é", "É", "z" * 9]
    data, bounds = utf8(pa.array(words))
    exact = WordReader(NOT_SPACE, lower=False).read(data, bounds).code
    assert len(set(exact.tolist())) == len(words)
    lower = WordReader(NOT_SPACE, lower=True).read(data, bounds).code
    assert lower[0] == lower[2] == lower[3] and lower[6] != lower[7]


def test_a_word_longer_than_a_segment_and_codes_across_segments(monkeypatch):
    monkeypatch.setattr("turnspool.llm.words.SEGMENT", 16)
    text = "ab " * 30 + "x" * 50 + " ab"
    data, bounds = utf8(pa.array([text]))
    code = WordReader(NOT_SPACE, lower=False).read(data, bounds).code
    assert len(code) == 32 and len(set(code[:30].tolist())) == 1 and code[31] == code[0]


def test_windows_stay_in_rows_and_grams_follow_order():
    assert windows_of(np.array([0, 3, 3, 4, 8]), 3).tolist() == [0, 4, 5]
    code = np.arange(1, 7, dtype=np.uint64)
    assert grams(code, 7, 1).tolist() == []
    assert len(set(grams(np.array([1, 2, 1, 2, 1], np.uint64), 2, 1).tolist())) == 2


def test_slices_cover_all_rows():
    column = pa.array(["aaaa", None, "", "bbbbbbbbbbbb", "c"])
    rows = [(a, b) for a, b, _, _ in slices(column, 5)]
    assert rows[0][0] == 0 and rows[-1][1] == 5
    assert all(x[1] == y[0] for x, y in zip(rows, rows[1:]))
    assert list(slices(pa.array([], pa.string()))) == []
