"""The pipeline against plain versions of its stages, and its own words kept."""

import pathlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from check_oracle import compare, oracle
from tests.llm import brute
from turnspool.llm import oracles, quality

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage gets and gives."""
    from turnspool.staging import stage

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage_of in corpus_pipeline.STAGES:
        docs = stage(stage_of(spark, docs, SF_DIR), name)
        out.append(docs)
    return out


def texts(df) -> dict:
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_counted_characters(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
        assert df.filter("n_chars <> length(text)").count() == 0


def test_quality_stage(spark, steps):
    given, kept = texts(steps[0]), texts(steps[1])
    assert not any(brute.quality(given[d])["base_failed"] for d in kept)
    passes = quality.line_passes
    from pyspark.sql import functions as F

    all_lines = sorted({line for t in given.values() for line in t.split("\n")})
    table = spark.createDataFrame([(x,) for x in all_lines], "l string")
    good = {r["l"] for r in table.filter(passes(F.col("l"))).collect()}
    for d, text in given.items():
        clean = "\n".join(x for x in text.split("\n") if x in good)
        enough = 100 * sum(map(len, brute.words(clean))) >= 50 * sum(map(len, brute.words(text)))
        if enough and not brute.quality(text)["base_failed"]:
            assert kept[d] == clean
        else:
            assert d not in kept


def test_line_stage(steps):
    given, kept = texts(steps[1]), texts(steps[2])
    want = brute.lines(list(given.items()))
    assert kept == {d: t for d, t in want.items() if t == given[d] or brute.words(t)}


def test_near_duplicate_stage(steps):
    given, kept = texts(steps[2]), texts(steps[3])
    want = brute.near(list(given.items()))
    assert kept == {d: t for d, t in given.items() if want[d] == d}


def test_decontamination_stage(spark, steps):
    given, kept = texts(steps[3]), texts(steps[4])
    rows = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    items = [(str(r["item_id"]), r["text"]) for r in rows]
    assert kept == {d: t for d, t in given.items() if not brute.hits(t, items)["n_hit"]}
    assert len(kept) < len(given)


def test_packing_stage(steps):
    given, pieces = texts(steps[4]), steps[5].collect()
    assert {r["doc_id"] for r in pieces} == set(given)
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in pieces)
    assert len(by_sequence) <= 1.05 * total / 1024 + 1
    assert Counter(r["piece"] for r in pieces)[0] == len(given)


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, oracle(SF_DIR), name, SF_DIR) is None


def test_all_are_registered():
    names = set(registry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    root = pathlib.Path(corpus_pipeline.__file__).parent / "turnspool"
    for path in root.rglob("*.py"):
        if path.parent.name != "llm":
            assert "turnspool.llm" not in path.read_text()
