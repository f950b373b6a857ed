"""The compiled transducer against the tokenizer's own library."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tests.conftest import SF_DIR
from turnspool.llm import queries, transducer
from turnspool.llm.token_counts import count_tokens, load_transducer
from turnspool.llm.words import utf8

MODEL = queries.tokenizer_path("piece_bpe_32k.model")
ODD = "aab ▁ \n\tethoinsr<>/0x ▁é世日本😀\x00Ⅷßé.,ﬁ　"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def compiled():
    return load_transducer(MODEL)


def counts(compiled, texts) -> list[int]:
    return compiled.count(*utf8(pa.array(texts, pa.string()))).tolist()


def text(rng: random.Random, library) -> str:
    kind = rng.randrange(5)
    if kind == 0:
        return "".join(rng.choice(ODD) for _ in range(rng.randrange(60)))
    if kind == 1:
        pieces = (library.id_to_piece(rng.randrange(259, 32000)) for _ in range(rng.randrange(20)))
        return "".join(pieces).replace("▁", " ")
    if kind == 2:
        ranges = [(32, 127), (32, 0xD7FF), (0x1F300, 0x1F6FF)]
        return "".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(150)))
    if kind == 3:
        return rng.choice("ax =-") * rng.randrange(1, 700) + "b" * rng.randrange(5)
    pieces = [library.id_to_piece(rng.randrange(259, 3000)) for _ in range(rng.randrange(1, 5))]
    return "".join(pieces).replace("▁", "") * rng.randrange(1, 120)


@pytest.mark.parametrize("chunk", [128, 16, 5])
def test_counts_are_those_of_the_library(compiled, library, monkeypatch, chunk):
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    rng = random.Random(chunk)
    texts = [text(rng, library) for _ in range(250)]
    assert counts(compiled, texts) == [len(ids) for ids in library.encode(texts, num_threads=1)]


def test_a_long_text_without_borders(compiled, library):
    texts = ["=" * 100_003, "ab" * 50_000, "日本語" * 20_000, " " * 30_001 + "x"]
    assert counts(compiled, texts) == [len(ids) for ids in library.encode(texts, num_threads=1)]


def test_a_small_vocabulary_of_overlapping_pieces():
    """Joins by score, leftmost of equals, against doing just that."""
    scores = {"a": 0, "b": 0, "▁": 0}
    scores |= {"aa": -1, "ab": -2, "ba": -2, "aab": -3, "abab": -4, "bab": -1.5}

    def plain(text: str) -> int:
        parts = ["▁", *text.replace(" ", "▁")] if text else []
        while True:
            best = max(
                (
                    (scores[p + q], -i)
                    for i, (p, q) in enumerate(zip(parts, parts[1:]))
                    if p + q in scores
                ),
                default=None,
            )
            if best is None:
                return sum(1 if p in scores else len(p.encode()) for p in parts)
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(1)
    texts = [
        "".join(rng.choice("aab é"[: rng.randrange(2, 6)]) for _ in range(rng.randrange(40)))
        for _ in range(400)
    ]
    assert counts(transducer.Transducer(scores), texts) == [plain(t) for t in texts]


def test_pairs_are_kept_and_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(transducer, "MAX_PAIR_BITS", 6)
    table = transducer.PairTable(4)
    keys = np.arange(1, 25, dtype=np.uint64) * np.uint64(1 << 32)
    table.put(keys, keys % np.uint64(3) == 0)
    known, value = table.get(keys)
    assert known.all() and (value == (keys % np.uint64(3) == 0)).all()
    table.put(keys + np.uint64(1), np.ones(24, bool))
    known, _ = table.get(np.concatenate([keys, keys + np.uint64(1)]))
    assert known[24:].all() and not known[:24].any()


def test_the_query_counts_as_the_library_does(spark, library):
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF_DIR).collect()}
    got = queries.op12_token_counts(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for row in got:
        whole = texts[row["doc_id"]] or ""
        n = len(library.encode(whole))
        assert row[1:] == (len(whole.encode()), n, n > 4096)


def test_odd_rows_and_clashing_names(spark):
    table = spark.createDataFrame(
        [("r", "a b", 1, "f", 0), (None, None, None, None, None), ("s", "", 2, "g", 1)],
        "row string, text string, n_tokens int, found string, `a.b` int",
    )
    got = count_tokens(table, MODEL)
    assert got.columns == ["row", "text", "found", "a.b", "n_bytes", "n_tokens"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("r", "a b", "f", 0, 3, 2), ("s", "", "g", 1, 0, 0), (None, None, None, None, 0, 0)
    ]
    assert count_tokens(table.filter("false"), MODEL).count() == 0


def test_other_models_are_refused(monkeypatch):
    monkeypatch.setattr("turnspool.llm.token_counts.PROBES", ["a"])
    monkeypatch.setattr(transducer.Transducer, "count", lambda *_: np.array([7]))
    with pytest.raises(ValueError, match="no plain"):
        load_transducer(MODEL)
