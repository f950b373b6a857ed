"""Hard negatives against all inner products; the tree against plain range checks."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import compare, oracle
from tests.conftest import SF_DIR
from turnspool.llm import hard_negatives
from turnspool.llm.hard_negatives import mine_hard_negatives
from turnspool.llm.hyperplane_tree import HyperplaneTree

SCHEMA = "vec_id bigint, embedding array<float>, label int, anchor string, part string, q int"


def vectors(seed: int, n: int = 900, width: int = 6) -> list[tuple]:
    """Clusters, copies under one label and under others, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, width))
    rows = []
    for i in range(n):
        v = centers[rng.integers(9)] + rng.normal(size=width) * rng.choice([0.05, 0.5])
        v = (v / np.linalg.norm(v)).astype(np.float32).tolist()
        rows.append((i, v, int(rng.integers(4))))
    same = rows[5][1]
    rows += [(n + i, same, int(i % 3 == 0)) for i in range(300)]
    rows += [rows[7], rows[7], (3000, [0.0] * width, 1), (3100, [], 1), (3200, same[:2], 2)]
    rows += [(3300, None, 1), (3301, same, None), (3302, [None, *same[1:]], 1)]
    rows += [(3303, [math.nan, *same[1:]], 1), (3304, [math.inf, *same[1:]], 1), (None, same, 0)]
    return [(*r, "x", "y", 1) for r in rows]


def plain(rows: list[tuple], every: int) -> Counter:
    points = {}
    for i, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        points[(hard_negatives.LAST if i is None else i, label, tuple(q))] = q
    out = Counter()
    for (i, label, _), q in points.items():
        if i == hard_negatives.LAST or i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, other)), j, other_label)
            for (j, other_label, _), other in points.items()
            if j != i
        )
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            fit = [
                (n, -ns) for ns, n, l in scored if l != label and -30 * ps <= -100 * ns <= -90 * ps
            ]
            for rank, (n, ns) in enumerate(fit[:10], 1):
                named = [None if x == hard_negatives.LAST else x for x in (p, n)]
                out[(i, named[0], rank, named[1], -ps, ns)] += 1
    return out


@pytest.mark.parametrize("fanout, leaf, sample, part", [(16, 4096, 8192, 1 << 16), (3, 20, 200, 40)])
def test_results_are_those_of_all_pairs(spark, monkeypatch, fanout, leaf, sample, part):
    for name, value in {"FANOUT": fanout, "LEAF": leaf, "SAMPLE": sample, "PART": part}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "QUERIES", 7)
    rows = vectors(4)
    table = spark.createDataFrame(rows, SCHEMA)
    got = mine_hard_negatives(table, F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, got.collect())) == plain(rows, 10)


@pytest.mark.parametrize("times", [1, 256])  # the greater need more than 16 bits
def test_results_of_waves_are_those_of_all_pairs(spark, monkeypatch, times):
    small = {"FANOUT": 4, "LEAF": 50, "SAMPLE": 100, "WAVE": 2, "BLOCK": 60, "PART": 150, "DEPTH": 3}
    small |= {"QUERIES": 9, "TILE": 4, "STRIP": 50, "WAITING": 40}
    for name, value in small.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = [(i, v and [x and x * times for x in v], *r) for i, v, *r in vectors(6)]
    assert len(hard_negatives.waves(len(rows))) == 4
    got = mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, got.collect())) == plain(rows, 10)


def test_what_is_sent_does_not_grow_with_the_leaves(spark, monkeypatch):
    sent = {name: spark.sparkContext.accumulator(0) for name in ("emit_routes", "emit_found")}

    def counted(name: str, size: str):
        make, total = getattr(hard_negatives, name), sent[name]

        def made(*args):
            run = make(*args)

            def watched(batches):
                for batch in run(batches):
                    total.add(getattr(batch, size))
                    yield batch

            return watched

        return made

    monkeypatch.setattr(hard_negatives, "emit_routes", counted("emit_routes", "nbytes"))
    monkeypatch.setattr(hard_negatives, "emit_found", counted("emit_found", "num_rows"))
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 500)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, v.tolist(), i % 4, "", "", 1) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, SCHEMA)
    n = mine_hard_negatives(table, F.col("vec_id") % 10 == 0).count()
    assert n == 400 * 5 * 10
    # Positives and negatives of 400 queries, from a sample of an eighth; 16 components and 6 entries.
    assert sent["emit_found"].value < 8 * 1.5 * (400 * 6 + 400 * 6 * 10)
    assert sent["emit_routes"].value < 2 * 8 * 400 * (16 * 4 + 6 * 40)


def test_empty_tables_and_tables_without_anchors(spark):
    table = spark.createDataFrame(vectors(1, 40), SCHEMA)
    assert mine_hard_negatives(table.filter("false"), F.lit(True)).collect() == []
    assert mine_hard_negatives(table, F.lit(None)).collect() == []
    assert mine_hard_negatives(table.filter("label is null"), F.lit(True)).collect() == []


def test_scores_that_cannot_be_exact_stop_the_job(spark):
    table = spark.createDataFrame([(0, [1e9], 1, "", "", 1)], SCHEMA)
    with pytest.raises(Exception, match="beyond 53 bits"):
        mine_hard_negatives(table, F.lit(True)).collect()


def test_query_matches_sql(spark):
    for sf_dir in (SF_DIR, "/root/testdata/sf0.01"):
        assert compare(spark, oracle(sf_dir), "op11_hard_negatives", sf_dir) is None


def test_a_leaf_that_is_left_out_holds_no_score_of_the_window():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 5)) * 200
    x = np.floor(centers[rng.integers(12, size=3000)] + rng.normal(size=(3000, 5)) * 20)
    square = float((x * x).sum(1).max())
    tree = HyperplaneTree.fit(x[:500], square, fanout=4, levels=3)
    tree.low, tree.high = tree.empty_ranges()
    leaf = np.concatenate([tree.leaves(part, tree.low, tree.high) for part in (x[:1000], x[1000:])])
    queries = x[::60]
    scores = queries @ x.T
    lo = np.quantile(scores, 0.97, axis=1)
    hi = np.quantile(scores, 0.99, axis=1)
    alive = tree.surviving(queries, lo, hi)
    inside = (scores >= lo[:, None]) & (scores <= hi[:, None])
    q, p = np.nonzero(inside)
    assert alive[q, leaf[p]].all()
    assert alive.mean() < 0.6
