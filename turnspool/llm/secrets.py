"""Secret scan with a trigram index.

Every rule is a regular expression. From it a Boolean query over trigrams is derived that any match
must satisfy: an OR of ANDs of trigrams of its mandatory literals. The index holds a posting for
each trigram that a query asks for and each text it is in; postings are intersected per query, and
only the texts left are searched with the expression. A rule without mandatory trigrams searches
every text.

A null text counts as empty and has no spans. The work on a text grows with its length, however many
matches it holds. Nulls in other columns, ties, repeated rows and an empty table need no care; extra columns stay, unless they are named like a result column. Positions are
code points, ends exclusive. Every expression is a built-in function.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnspool.staging import stage

MAX_STRINGS = 64
# Trigrams of a conjunction that are intersected; leaving some out only adds candidates.
MAX_BITS = 62
# Matches of one text that are put together at a time.
FOLDED = 512

SPANS = "array<struct<start:int,number:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """``group``: the part that must have ``least`` characters for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Fixed values. The first three are the base; the others are formats of well-known services.
RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE = 3

# A conjunction of trigrams, and alternatives of them; None stands for "any text".
Conjunction = frozenset


def _least(options: set[Conjunction]) -> set[Conjunction]:
    """Without the alternatives that another one implies."""
    return {a for a in options if not any(b < a for b in options)}


def _both(a: set[Conjunction] | None, b: set[Conjunction] | None) -> set[Conjunction] | None:
    if a is None or b is None:
        return a if b is None else b
    joined = _least({x | y for x, y in itertools.product(a, b)})
    return joined if len(joined) <= MAX_STRINGS else min(a, b, key=len)


def _of_strings(strings: set[str]) -> set[Conjunction] | None:
    """What a text that holds one of the strings must have."""
    found = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return None if frozenset() in found else _least(found)


def _walk(items) -> tuple[set[str] | None, set[Conjunction] | None]:
    """``(all strings matched, if they are few; the query)`` of a parsed expression."""
    strings, query, exact = {""}, None, True
    for op, value in items:
        own, inner = _one(str(op), value)
        if own is not None and len(strings) * len(own) <= MAX_STRINGS:
            strings = {a + b for a, b in itertools.product(strings, own)}
            continue
        query = _both(_both(query, _of_strings(strings)), inner)
        strings, exact = {""}, False
    if exact:
        return strings, _of_strings(strings)
    return None, _both(query, _of_strings(strings))


def _one(op: str, value) -> tuple[set[str] | None, set[Conjunction] | None]:
    if op == "LITERAL":
        return {chr(value).lower()}, None
    if op == "IN":
        if all(str(kind) == "LITERAL" for kind, _ in value):
            return {chr(c).lower() for _, c in value}, None
    elif op == "SUBPATTERN":
        return _walk(value[-1])
    elif op == "BRANCH":
        parts = [_walk(branch) for branch in value[1]]
        if all(s is not None for s, _ in parts):
            strings = set().union(*(s for s, _ in parts))
            return strings, _of_strings(strings)
        if all(q is not None for _, q in parts):
            return None, _least(set().union(*(q for _, q in parts)))
    elif op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = value
        strings, query = _walk(inner)
        if low == 0 and high == 1 and strings is not None:
            return strings | {""}, None
        if low >= 1:
            return None, query
    return None, None


def trigram_query(pattern: str) -> set[Conjunction] | None:
    """Alternatives of trigrams in lower case, one of which every match holds; None: no such."""
    return _walk(re._parser.parse(pattern))[1]


def build_index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``(trigram, key)`` from ``(key, text)``, for the trigrams asked for."""
    low = F.lower("text")
    present = F.filter(
        F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(F.col("_low"), t)
    )
    return texts.select("key", low.alias("_low")).select(F.explode(present).alias("trigram"), "key")


def candidates(index: DataFrame, queries: dict[str, set[Conjunction]]) -> DataFrame:
    """``(key, kinds)``: the texts whose postings satisfy the query of each kind.

    The postings of a text are made by one task, so they are joined to bit sets before they move.
    """
    rows = [
        (kind, number, trigram, 1 << bit, (1 << min(len(conjunction), MAX_BITS)) - 1)
        for kind, options in queries.items()
        for number, conjunction in enumerate(sorted(options, key=sorted))
        for bit, trigram in enumerate(sorted(conjunction)[:MAX_BITS])
    ]
    wanted = index.sparkSession.createDataFrame(
        rows, "kind string, number int, trigram string, bit bigint, needed bigint"
    )
    # One row for each trigram of a rule: as short as the list of rules.
    met = (
        index.join(F.broadcast(wanted), "trigram")
        .groupBy("key", "kind", "number", "needed")
        .agg(F.bit_or("bit").alias("found"))
        .filter(F.col("found") == F.col("needed"))
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Leftmost non-overlapping matches that count, as (start, number, end).

    What lies between the matches tells where they are.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
        gaps.alias("gap"),
    )
    empty = F.lit(None).cast(SPANS)
    none = F.coalesce(empty, F.array().cast(SPANS))

    def add(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        end = start + F.coalesce(F.length(m["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"))
        counts = F.length(m["part"]) >= rule.least  # null behind the last match
        found = F.when(counts, F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def append(acc: Column, block: Column) -> Column:
        moved = F.transform(
            block["found"],
            lambda s: F.struct(
                (s["start"] + acc["at"]).alias("start"),
                s["number"].alias("number"),
                (s["end"] + acc["at"]).alias("end"),
            ),
        )
        return F.struct(
            (acc["at"] + block["at"]).alias("at"),
            F.concat(acc["found"], F.array(moved)).alias("found"),
        )

    def in_blocks(pairs: Column) -> Column:
        # A fold copies what it has found at each match, so it only runs over a block of matches.
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / FOLDED).cast("int")),
            lambda k: F.aggregate(
                F.slice(pairs, k * FOLDED + 1, F.lit(FOLDED)),
                F.struct(F.lit(0).alias("at"), none.alias("found")),
                add,
            ),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("found"))
        return F.aggregate(blocks, start, append, lambda acc: F.flatten(acc["found"]))

    # As the variable of a function the pairs are made once, not for each block.
    found = F.get(F.transform(F.array(pairs), in_blocks), F.lit(0))
    return F.when(text.rlike(rule.pattern), found).otherwise(none)


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["number"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def scan_secrets(
    df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``df`` with ``spans``: array of (start, number of the rule, end), in that order."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {kind: q for kind, q in queries.items() if q is not None}
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "spans"])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Texts that share a key share candidates too, which the search then settles. Empty texts have
    # no posting, so any key will do that lets them lie apart.
    key = F.when(text == "", F.monotonically_increasing_id()).otherwise(F.xxhash64(text))
    texts = df.select(row.alias("row"), text.alias("text"), key.alias("key"))
    trigrams = sorted(set().union(*itertools.chain(*asked.values())))
    index = stage(build_index(texts, trigrams), "trigram-index")
    marked = texts.join(candidates(index, asked), "key", "left")
    found = [
        spans_of(F.col("text"), rule, number)
        if queries[rule.kind] is None
        else F.when(
            F.array_contains("kinds", rule.kind), spans_of(F.col("text"), rule, number)
        )
        for number, rule in enumerate(rules)
    ]
    every = F.filter(F.flatten(F.filter(F.array(*found), lambda a: a.isNotNull())), F.isnotnull)
    return marked.select("row.*", F.sort_array(every).alias("spans"))
