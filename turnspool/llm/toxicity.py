"""Toxicity by non-negative positive-unlabelled learning.

A text is the set of its words and of the beginnings of its longer words, hashed to 2**18 features.
A linear classifier is trained in numpy from confirmed toxic texts P and unlabelled texts U, under
the risk

    prior * risk(P as toxic) + max(0, risk(U as clean) - prior * risk(P as clean))

where the second part, a mean over clean texts, cannot fall below zero; where it would, its
gradient is turned round. ``prior``, the share of toxic texts, can be given. Otherwise it is their
share among labelled rows; where those are confirmed positives only, it is estimated from P and U: no
set of texts can hold a smaller part of U than prior times its part of P, and the sets tried are the
texts that a classifier, trained on other rows, scores above a threshold. Training uses at most ``max_positive`` and ``max_unlabelled`` texts, those with the smallest hash of their
id, and the ``vocabulary`` features that tell P and U apart best.

A null text is an empty one; every text gets a score. Without a confirmed toxic text every score is
0. Repeated rows are scored alike; labels that are null or belong to no text teach nothing; extra
columns stay, and columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnspool.llm.words import ALNUM, Words, WordReader, slices
from turnspool.staging import stage

FEATURE_BITS = 18
MIN_DEVIATIONS = 4.0
PREFIXES = (7, 8, 9, 10)  # bytes
STEPS, RATE, DECAY = 300, 0.1, 1e-4


class Model(NamedTuple):
    weights: np.ndarray  # by feature
    bias: float


def features_of(
    reader: WordReader, data: np.ndarray, words: Words, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)``, each feature once a row, in row order; only those ``wanted``."""
    row = words.row()
    found = [(row, words.code)]
    found += [(row[i], code) for i, code in reader.prefixes(data, words, PREFIXES)]
    pairs = []
    for row, code in found:
        feature = (code >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        if wanted is not None:
            use = wanted[feature]
            row, feature = row[use], feature[use]
        pairs.append((row << FEATURE_BITS) | feature)
    both = np.unique(np.concatenate(pairs))
    return both >> FEATURE_BITS, both & ((1 << FEATURE_BITS) - 1)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def feature_sets(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    reader = WordReader(ALNUM, lower=True)
    for column in columns:
        counts, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low, high, data, bounds in slices(column):
            row, feature = features_of(reader, data, reader.read(data, bounds))
            counts.append(np.bincount(row, minlength=high - low))
            values.append(feature)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        yield pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(values).astype(np.int32))
        )


def train_nnpu(
    row: np.ndarray, feature: np.ndarray, n_features: int, positive: np.ndarray, prior: float
) -> tuple[np.ndarray, float]:
    """Weights and bias from the set features of every text; ``positive`` flags P by row."""
    n = len(positive)
    weights, bias = np.zeros(n_features), np.log(prior / (1 - prior))
    moments = [np.zeros(n_features + 1), np.zeros(n_features + 1)]
    to_p = positive / max(1, positive.sum())
    to_u = ~positive / max(1, (~positive).sum())
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(row, weights[feature], n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_clean = np.logaddexp(0, z)
        clean = (to_u - prior * to_p) @ as_clean
        by_z = (to_u - prior * to_p) * p * (1 if clean >= 0 else -1)
        if clean >= 0:
            by_z = by_z + prior * to_p * (p - 1)
        slope = np.append(np.bincount(feature, by_z[row], n_features) + DECAY * weights, by_z.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.999 * moments[1] + 0.001 * slope**2
        move = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights = weights - RATE * move[:-1]
        bias = bias - RATE * move[-1]
    return weights, float(bias)


def estimated_prior(
    row: np.ndarray, feature: np.ndarray, n_features: int, positive: np.ndarray
) -> float:
    """The share of P's kind in U, as an upper bound that is close if some texts are surely toxic.

    Half of the rows train a classifier, the others tell which parts of P and of U it scores above
    each of P's scores. The least ratio of the two, each with its standard error to the safe side,
    is the bound; thresholds that few texts of P reach count little by themselves.
    """
    half = np.zeros(len(positive), bool)
    for kind in (positive, ~positive):
        half[np.flatnonzero(kind)[::2]] = True
    taught = half[row]
    place = np.cumsum(half) - 1
    weights, bias = train_nnpu(
        place[row[taught]], feature[taught], n_features, positive[half], 0.5
    )
    z = (bias + np.bincount(row, weights[feature], len(positive)))[~half]
    of_p, of_u = np.sort(z[positive[~half]]), np.sort(z[~positive[~half]])
    if not len(of_p) or not len(of_u):
        return 0.5
    cuts = np.unique(of_p)
    p = 1 - np.searchsorted(of_p, cuts) / len(of_p)
    u = 1 - np.searchsorted(of_u, cuts) / len(of_u)
    p_low = p - np.sqrt(p * (1 - p) / len(of_p)) - 1 / len(of_p)
    u_high = u + np.sqrt(u * (1 - u) / len(of_u)) + 1 / len(of_u)
    bound = u_high[p_low > 0] / p_low[p_low > 0]
    return float(min(bound.min(initial=1.0), 1.0))


def choose_vocabulary(counts: DataFrame, n_p: int, n_u: int, size: int) -> np.ndarray:
    """The features whose share differs most between P and U: by MIN_DEVIATIONS at least, so that
    the many words of a long text add no noise."""
    in_p, in_u = F.col("in_p") / F.lit(max(1, n_p)), F.col("in_u") / F.lit(max(1, n_u))
    mean = (F.col("in_p") + F.col("in_u") + 1) / F.lit(n_p + n_u + 1)
    spread = F.sqrt(mean * (1 / max(1, n_p) + 1 / max(1, n_u)))
    far = F.abs(in_p - in_u) / spread
    chosen = (
        counts.filter((F.col("in_p") + F.col("in_u") >= 5) & (far >= MIN_DEVIATIONS))
        .orderBy(far.desc(), "feature")
        .limit(size)
        .select("feature")
    )
    return np.sort(np.array([r[0] for r in chosen.collect()], np.int64))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_positive: int = 6_000,
    max_unlabelled: int = 18_000,
    vocabulary: int = 2_048,
    prior: float | None = None,
) -> Model | None:
    """Train from ``docs (doc_id, text)``, all taken as unlabelled, and ``labels (doc_id, toxic)``.

    What reaches the driver is bounded by the three sizes.
    """
    order = F.xxhash64("doc_id"), F.col("doc_id")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    share = known.agg(F.avg("toxic")).first()[0]
    if not share:
        return None
    ids = docs.filter(F.col("doc_id").isNotNull()).select("doc_id")
    toxic = known.filter(F.col("toxic") == 1).select("doc_id").distinct()
    picked = (
        toxic.orderBy(*order).limit(max_positive).withColumn("positive", F.lit(True))
    ).unionByName(
        ids.orderBy(*order).limit(max_unlabelled).withColumn("positive", F.lit(False))
    )
    # At most max_positive + max_unlabelled ids.
    sample = stage(
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .select("positive", feature_sets(F.coalesce("text", F.lit(""))).alias("features")),
        "toxicity-sample",
    )
    counted = sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["positive"]: r["n"] for r in counted.collect()}
    if not sizes.get(True):
        return None
    exploded = sample.select("positive", F.explode("features").alias("feature"))
    counts = exploded.groupBy("feature").agg(
        F.count_if("positive").alias("in_p"), F.count_if(~F.col("positive")).alias("in_u")
    )
    chosen = choose_vocabulary(counts, sizes[True], sizes.get(False, 0), vocabulary)
    wanted = sample.sparkSession.createDataFrame([(chosen.tolist(),)], "wanted array<int>")
    lean = sample.join(F.broadcast(wanted)).select(
        "positive", F.array_intersect("features", "wanted").alias("features")
    )
    table = lean.toArrow().combine_chunks()
    lists = table["features"].combine_chunks()
    feature = np.searchsorted(chosen, lists.flatten().to_numpy(zero_copy_only=False))
    row = np.repeat(
        np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)
    )
    positive = table["positive"].to_numpy(zero_copy_only=False).astype(bool)
    if prior is None:
        prior = share if share < 1 else estimated_prior(row, feature, len(chosen), positive)
    weights, bias = train_nnpu(row, feature, len(chosen), positive, min(max(prior, 0.01), 0.99))
    full = np.zeros(1 << FEATURE_BITS)
    full[chosen] = weights
    return Model(full, bias)


def score_toxicity(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("score", "predicted")]
    if model is None:
        score = F.lit(0.0)
    else:
        sent = df.sparkSession.sparkContext.broadcast(tuple(model))  # 2 MiB

        @F.arrow_udf("double")
        def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            weights, bias = sent.value
            reader = WordReader(ALNUM, lower=True)
            for column in columns:
                z = np.full(len(column), bias)
                for low, high, data, bounds in slices(column):
                    words = reader.read(data, bounds)
                    row, feature = features_of(reader, data, words, weights != 0)
                    z[low:high] += np.bincount(row, weights[feature], high - low)
                yield pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        score = scores(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return df.select(*kept, score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )
