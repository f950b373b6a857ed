"""The learned operators, by what they get right on rows they have not learned from."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnspool.llm import language, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string"
SYLLABLES = {"aa": "ka lo mi tu ne".split(), "bb": "schrö fün zwö grü ßen".split()}


def text_of(rng: random.Random, *langs: str, n: int = 30) -> str:
    return " ".join(
        "".join(rng.choices(SYLLABLES[rng.choice(langs)], k=1) * 2 + rng.choices(SYLLABLES[lang], k=2))
        for lang in rng.choices(langs, k=n)
    )


def test_mixture_finds_shares():
    rng = np.random.default_rng(0)
    logs = np.log(np.where(np.arange(3) == rng.choice(3, 90, p=[0.7, 0.3, 0])[:, None], 0.9, 0.001))
    share = language.mixtures(logs.astype(np.float32), np.array([0, 60]))
    assert share.shape == (2, 3) and np.allclose(share.sum(axis=1), 1)
    assert (share.argmax(axis=1) == 0).all() and (share[:, 2] == 0).all()
    assert 0.5 < share[0, 0] < 0.9


def test_language_of_odd_texts(spark):
    rng = random.Random(1)
    rows = [(i, text_of(rng, lang), lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    train = spark.createDataFrame(rows + [(90, "12", "aa"), (91, None, "bb")], SCHEMA)
    model = language.fit_trigrams(train.select("lang", "text"))
    assert model[0] == ["aa", "bb"]
    odd = [
        (0, None, None),
        (1, "", None),
        (2, "12 345 ...", "aa"),
        (3, text_of(rng, "aa", n=2000), None),
        (4, text_of(rng, "bb"), None),
        (5, text_of(rng, "bb"), None),
        (6, "KALO MITU", None),
    ]
    df = spark.createDataFrame([(*r, 1) for r in odd], SCHEMA + ", score int")
    got = {r["doc_id"]: r for r in language.identify_languages(df, *model).collect()}
    assert [got[i]["lang_pred"] for i in range(7)] == "und und und aa bb bb aa".split()
    assert got[0]["score"] == 0 and all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.fit_trigrams(train.filter("false").select("lang", "text"))
    assert {r["lang_pred"] for r in language.identify_languages(df, *nothing).collect()} == {"und"}


def test_language_query_on_held_out_rows(spark):
    got = queries.op4_language_mixture(spark, SF_DIR)
    docs = queries.documents(spark, SF_DIR).select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id").collect()
    assert len(held) > 20
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95


def test_risk_stays_above_zero_and_separates():
    rng = np.random.default_rng(3)
    positive = np.arange(600) < 100
    toxic = positive | (np.arange(600) >= 550)  # unlabelled texts hold toxic ones too
    sets = [np.unique(np.append(rng.integers(1, 50, 8), 0 if t else 1)) for t in toxic]
    row = np.repeat(np.arange(600), [len(s) for s in sets])
    weights, bias = toxicity.train_nnpu(row, np.concatenate(sets), 50, positive, 0.1)
    z = bias + np.bincount(row, weights[np.concatenate(sets)], 600)
    assert ((z > 0) == toxic).mean() > 0.97


def test_toxicity_of_odd_tables(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        words = [rng.choice("abcdefgh") * 3 + rng.choice("xyz") for _ in range(20)]
        rows.append((i, " ".join(words + (["vile"] if i % 10 == 0 else []))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 10 == 0)) for i in range(300)] + [(None, 1), (5, None), (9999, 1)],
        "doc_id bigint, toxic int",
    )
    model = toxicity.fit_toxicity(docs, labels)
    odd = [(0, "so VILE, this", 7), (1, None, 7), (2, "", 7), (None, "aaax bbby", 7)]
    df = spark.createDataFrame(odd, "doc_id bigint, text string, predicted int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, model).collect()}
    assert [got[k]["predicted"] for k in (0, 1, 2, None)] == [1, 0, 0, 0]
    assert toxicity.fit_toxicity(docs, labels.filter("toxic = 0")) is None
    assert toxicity.fit_toxicity(docs.filter("false"), labels) is None
    assert {r["score"] for r in toxicity.score_toxicity(df, None).collect()} == {0.0}


@pytest.mark.parametrize("name", ["op10_toxicity_nnpu"])
def test_toxicity_query_on_held_out_rows(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.QUERIES[name](spark, sf_dir).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    clean = [r["predicted"] for r in held if r["toxic"] == 0]
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    assert np.mean(clean) < 0.1
    assert np.mean(toxic) > np.mean([r["score"] for r in rows if r["toxic"] == 0]) + 0.2


@pytest.mark.parametrize("share", [0.05, 0.2])
def test_prior_from_positives_and_unlabelled(share):
    rng = np.random.default_rng(5)
    positive = np.arange(6000) < 1000
    toxic = positive | (rng.random(6000) < share)
    sets = [np.unique(np.append(rng.integers(5, 60, 8), rng.integers(0, 5, 2) if t else 60)) for t in toxic]
    row = np.repeat(np.arange(6000), [len(s) for s in sets])
    got = toxicity.estimated_prior(row, np.concatenate(sets), 61, positive)
    assert abs(got - share) < 0.03
    assert toxicity.estimated_prior(row[:0], row[:0], 1, positive[:1]) == 0.5


def test_confirmed_positives_only_leave_clean_texts_alone(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = queries.documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    taught = queries.bucket_of(F.col("doc_id"), 5) != 0
    model = toxicity.fit_toxicity(docs.filter(taught), labels.filter(taught).filter("toxic = 1"))
    held = toxicity.score_toxicity(docs.filter(~taught), model).join(labels, "doc_id").collect()
    clean = [r["predicted"] for r in held if r["toxic"] == 0]
    toxic = [r["predicted"] for r in held if r["toxic"] == 1]
    assert np.mean(clean) < 0.1
    assert np.mean(toxic) > 0.5
