"""Plain versions of the operators for small tables: lists of (doc_id, text) in, dicts out."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return SPACE_WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text: str | None) -> dict:
    t = text or ""
    w = words(t)
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {
        k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)
    }
    worded = [line for line in t.split("\n") if words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_dup_lines": len(worded) - len(set(worded)),
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w),
    }


def spans(text: str | None, rules) -> list[tuple[int, int, int]]:
    found = []
    for number, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def hits(text: str | None, items: list[tuple[str, str]], window: int = 10) -> dict:
    w = ITEM_WORD.findall((text or "").translate(UPPER))
    hit, found = set(), set()
    for item, item_text in items:
        p = ITEM_WORD.findall((item_text or "").translate(UPPER))
        n = min(window, len(p))
        wanted = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in wanted:
                hit.update(range(i, i + n))
                found.add(item)
    return {"n_words": len(w), "n_hit": len(hit), "items": sorted(found)}


def shingles(text: str | None) -> set[tuple[str, ...]]:
    w = words((text or "").translate(UPPER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    """doc_id to component_id."""
    sets = [(d, shingles(t)) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in root}


def substrings(docs: list[tuple[int, str | None]], n: int = 13) -> dict[int, dict]:
    texts = {d: words(t) for d, t in docs}
    first: dict = {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - n + 1):
            first.setdefault(tuple(texts[d][i : i + n]), d)
    out = {}
    for d, w in texts.items():
        gone = {
            k
            for i in range(len(w) - n + 1)
            if first[tuple(w[i : i + n])] < d
            for k in range(i, i + n)
        }
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = {"n_words": len(w), "n_removed": len(gone), "kept_text": kept}
    return out


def lines(docs: list[tuple[int, str | None]], least: int = 2, chars: int = 40) -> dict[int, str]:
    """doc_id to clean text: every run of lines is looked up among all earlier ones."""
    split = {d: t.split("\n") if t else [] for d, t in docs}
    seen: set = set()
    gone = defaultdict(set)
    for d in sorted(split):
        own = split[d]
        for i in range(len(own)):
            for j in range(i + least, len(own) + 1):
                run = tuple(own[i:j])
                if run in seen and sum(map(len, run)) >= chars:
                    gone[d].update(range(i, j))
            # Runs that start at a later line may equal one that starts here.
            seen.update(tuple(own[i:j]) for j in range(i + least, len(own) + 1))
    return {
        d: "\n".join(x for i, x in enumerate(split[d]) if i not in gone[d]) if gone[d] else text
        for d, text in docs
    }
