"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from turnspool.llm import (
    decontamination,
    language,
    line_dedup,
    minhash,
    packing,
    quality,
    secrets,
    sharding,
    substring_dedup,
    toxicity,
)
from turnspool.llm.queries import vocabulary_path

NAMES = (
    "row node root key at doc place bucket hits spans deleted copy runs n _n line rank "
    "clean_text kept shard slot piece lang_pred score predicted length found text_hash"
).split()
LONG = "long text with words that come again and again " * 3000
ROWS = [
    (None, None),
    (None, "a null id with some text of its own, and more of it"),
    (3, LONG),
    (3, LONG),
    (3, "same id, other text: nothing in common with it at all"),
    (4, ""),
    (5, LONG + "x"),
    (6, "tie"),
    (6, "tie"),
]


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in NAMES)
    return spark.createDataFrame([(*r, *NAMES) for r in ROWS], schema).cache()


def operators(spark):
    items = spark.createDataFrame([("1", LONG[:200]), (None, "tie")], "item_id string, text string")
    model = (["aa"], np.zeros((language.BINS, 1), np.float32))
    scores = toxicity.Model(np.ones(1 << toxicity.FEATURE_BITS), -5.0)
    return {
        "sharding": lambda df: sharding.shuffle_to_shards(df, 4),
        "decontamination": lambda df: decontamination.find_benchmark(df, items),
        "near": minhash.near_duplicates,
        "language": lambda df: language.identify_languages(df, *model),
        "quality": quality.line_first_cleaning,
        "secrets": secrets.scan_secrets,
        "packing": lambda df: packing.pack_documents(df, vocabulary_path()),
        "substrings": substring_dedup.dedup_substrings,
        "lines": line_dedup.dedup_lines,
        "toxicity": lambda df: toxicity.score_toxicity(df, scores),
    }


OPERATORS = (
    "sharding decontamination near language quality secrets packing substrings lines toxicity"
).split()


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_and_empty_tables(spark, odd, name):
    operator = operators(spark)[name]
    got = operator(odd).collect()
    ids = sorted(str(r["doc_id"]) for r in got if name != "packing" or r["piece"] == 0)
    assert ids == sorted(str(r[0]) for r in ROWS)
    assert operator(odd.filter("false")).count() == 0


def test_near_duplicates_of_odd_rows(odd):
    got = sorted(
        (str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["keeper"])
        for r in minhash.near_duplicates(odd).collect()
    )
    n = len(brute.shingles(LONG))
    assert [g for g in got if g[0] == "5"] == [("5", n + 1, "3", False)]
    assert sorted(g[3] for g in got if g[0] == "3" and g[1] == n) == [False, True]
    assert [g[2] for g in got if g[0] == "4"] == ["4"]
    assert all(g[2] == "None" and g[3] for g in got if g[0] == "None")


def test_substrings_of_odd_rows(odd):
    got = substring_dedup.dedup_substrings(odd).collect()
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] != 5)
    (five,) = [r for r in got if r["doc_id"] == 5]
    assert five["n_removed"] == five["n_words"] - 1 and five["kept_text"] == "x"
    assert all(r["row"] == "row" and r["copy"] == "copy" for r in got)


def test_pipeline_stages_on_odd_rows(spark, odd):
    """Columns named like results, helpers and with a dot keep their values in every stage."""
    names = [*NAMES, "n_words", "n_lines", "n_deleted_lines", "deleted", "_id", "_hash", "_nth", "_"]
    names = [n for n in dict.fromkeys(names) if n not in ("doc_id", "text")] + ["a.b", "keeper"]
    extra = [F.concat(F.lit(f"{n}:"), F.xxhash64("text")).alias(n) for n in names]
    docs = odd.select("doc_id", "text", *extra)
    before = {tuple(r[2:]) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert {tuple(r[2:]) for r in rows} <= before, name
        assert rows or name == "quality_rules"
        assert stage(spark, docs.filter("false"), "/root/testdata/sf0.001").count() == 0, name
