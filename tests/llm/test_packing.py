import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_DIR
from turnspool.llm import packing, queries
from turnspool.llm.queries import vocabulary_path
from turnspool.llm.words import utf8

TEXTS = [
    None,
    "",
    " ",
    "Hello  world,\n  it's\t\tfine \n",
    "a b  c 　d   e  é ü 世界 \U0001f600 x",
    "x<|endoftext|> y <|endoftext|>",
    "word " * 700 + "\n\n" + "z" * 300,
    " lead and trail ",
    "café naïve  Ünder  \u0085 next   q",
    "12 345  6 'll 's it'S don't",
]


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def ids_of(texts) -> list[list[int]]:
    tokenizer = packing.ChunkTokenizer(vocabulary_path())
    ids, ends = tokenizer.encode(*utf8(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


@pytest.mark.parametrize(
    "text",
    [
        " " * 1_500_000 + "x",
        "\n" * 1_000_000 + "  a",
        " 　" * 500_000 + "é",
        "a" * 1_500_000,
        "=" * 1_500_000,
        "x" + " " * 1_200_000,
    ],
    ids=lambda t: f"{t[:2]!r}",
)
def test_runs_of_a_million_characters(text):
    assert ids_of([text]) == reference_ids([text])


def test_long_runs_of_blanks_amid_other_text():
    rng = random.Random(1)
    parts = ["a", "x1", "　", "!", "é", "<|endoftext|>", "'s", " ", "\n" * 1100]
    parts += [c * n for c in (" ", "\x1c", "\u200b", "\x85") for n in (999, 1000, 1001)]
    texts = ["".join(rng.choices(parts, k=rng.randrange(8))) for _ in range(300)]
    assert ids_of(texts) == reference_ids(texts)


def test_ids_are_those_of_the_tokenizer_library():
    rng = random.Random(7)
    alphabet = list("ab é世 \n\t'sX1.,- 　\U0001f600") + ["  ", " the", "<|endoftext|>"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(500)]
    tokenizer = packing.ChunkTokenizer(vocabulary_path())
    for part in (texts, list(reversed(texts))):  # the second time from memory
        ids, ends = tokenizer.encode(*utf8(pa.array(part, pa.string())))
        got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        assert got == reference_ids(part)


def filled(runs, capacity):
    """Contents of every bin, checking offsets."""
    bins = Counter()
    for length, low, high, number, each, offset in runs:
        for rank in range(low, high):
            which = number + (rank - low) // each
            assert bins[which] == offset + (rank - low) % each * length
            bins[which] += length
    assert max(bins.values(), default=0) <= capacity
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 101): rng.randrange(1, 40) for _ in range(60)}
    runs = packing.plan_bins(counts, 100)
    for length, n in counts.items():
        ranges = sorted((a, b) for x, a, b, *_ in runs if x == length)
        assert [r for a, b in ranges for r in range(a, b)] == list(range(n))
    bins = filled(runs, 100)
    total = sum(x * n for x, n in counts.items())
    assert len(bins) <= -(-total // 100) * 1.15 + 2


def fewest(items: tuple[int, ...], capacity: int) -> int:
    """By trying everything."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += items[i]
                place(i + 1, bins)
                bins[k] -= items[i]
        place(i + 1, bins + [items[i]])

    place(0, [])
    return best[0] if items else 0


@pytest.mark.parametrize("seed", range(60))
def test_reduction_loses_no_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 15, 20])
    items = tuple(rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10)))
    counts = Counter(items)
    fixed = packing.reduce_bins(counts, capacity)
    rest = tuple(itertools.chain(*([x] * n for x, n in counts.items())))
    assert sum(n for _, n in fixed) + fewest(rest, capacity) == fewest(items, capacity)


def test_pieces_and_sequences(spark):
    rows = [(i % 6, t, "extra") for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, offset string")
    got = packing.pack_documents(df, vocabulary_path(), 64, 2, with_ids=True).cache()
    want = Counter()
    for (doc_id, text, _), ids in zip(rows, reference_ids([r[1] for r in rows])):
        ids = [*ids, 2]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want[(doc_id, text, piece, a, b - a, crc, tuple(ids[a:b]))] += 1
    pieces = got.collect()
    keys = ["doc_id", "text", "piece", "start", "length", "ids_crc32"]
    assert Counter((*(r[k] for k in keys), tuple(r["ids"])) for r in pieces) == want
    sequences = {r["sequence_id"]: list(r["ids"]) for r in packing.assemble(got).collect()}
    assert all(len(s) <= 64 for s in sequences.values())
    for r in pieces:
        assert sequences[r["sequence_id"]][r["offset"] :][: r["length"]] == list(r["ids"])
    assert sum(map(len, sequences.values())) == sum(r["length"] for r in pieces)


def test_no_documents_no_pieces(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(df, vocabulary_path()).count() == 0


def test_the_query_packs_what_the_library_gives(spark):
    """Every piece of every document, by the ids of the tokenizer's library."""
    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF_DIR).collect()}
    rows = queries.op7_best_fit_packing(spark, SF_DIR).collect()
    by_doc, used = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(docs)
    for (doc_id, text), ids in zip(docs.items(), reference_ids(docs.values())):
        ids, at = np.array([*ids, 2], "<u4"), 0
        for n, piece in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            own = ids[at : at + piece["length"]]
            assert (piece["piece"], piece["start"]) == (n, at)
            assert piece["ids_crc32"] == zlib.crc32(own.tobytes())
            at += piece["length"]
        assert at == len(ids)
        assert len(by_doc[doc_id]) == -(-len(ids) // 1024)
    for places in used.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
    total = sum(r["length"] for r in rows)
    assert len(used) <= 1.02 * -(-total // 1024) + 1
