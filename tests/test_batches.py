"""Order, batch plans and padding on small inputs."""

import hashlib

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from turnspool.functions.labels import IGNORE
from turnspool.operators import batches
from turnspool.operators.order import global_index, long_levels, md5_levels
from turnspool.operators.order import nth_least
from turnspool.sources.splits import assemble_splits, cap_records
from turnspool.staging import spread


def test_index_of_sparse_ids(spark):
    """Ids over the whole range of a bigint, in several upper and lower buckets."""
    rng = [(i * 2_654_435_761_987) % (1 << 62) * (-1 if i % 3 == 0 else 1) for i in range(500)]
    ids = sorted(set(rng) | set(range(50)) | {1 << 40, (1 << 20) + 1, -1})
    df = spark.createDataFrame([(i, "s") for i in ids], "row_id bigint, split string")
    row_id = F.col("row_id")
    indexed = global_index(df, [row_id], long_levels(row_id), within=["split"])
    assert [r["row_id"] for r in indexed.orderBy("idx").collect()] == ids
    assert [r["idx"] for r in indexed.orderBy("idx").collect()] == list(range(len(ids)))


def test_index_by_digest(spark):
    df = spark.range(3000).withColumn("key", F.md5(F.col("id").cast("string")))
    indexed = global_index(df, [F.col("key"), F.col("id")], md5_levels(F.col("key")))
    keys = [r["key"] for r in indexed.orderBy("idx").collect()]
    assert keys == sorted(keys) and len(keys) == 3000


def test_seeded_order(spark):
    rows = batches.expand_epochs(spark.range(200).withColumnRenamed("id", "row_id"), 2)
    got = batches.seeded_order(rows, 5).orderBy("epoch", "idx").collect()
    for epoch in (0, 1):
        want = sorted(
            range(200), key=lambda i: hashlib.md5(f"5-{epoch}-{i}".encode()).hexdigest()
        )
        assert [r["row_id"] for r in got if r["epoch"] == epoch] == want
    other = batches.seeded_order(rows, 6).filter("idx = 0").count()
    assert other == 2


def plan_of(spark, n, epochs=2, batch=3, accumulation=2, world=2):
    rows = batches.expand_epochs(
        spark.range(n).select(
            F.col("id").alias("row_id"),
            (F.col("id") % 7 + 1).alias("n_tokens"),
            (F.col("id") % 2).alias("n_active"),
        ),
        epochs,
    )
    ordered = batches.assign_batches(batches.seeded_order(rows, 1), batch)
    return batches.assign_steps(ordered, n, batch, accumulation, world)


def test_every_row_is_in_one_batch_per_epoch(spark):
    plan = plan_of(spark, 50)
    per_row = plan.groupBy("epoch", "row_id").count()
    assert per_row.count() == 100 and per_row.filter("count != 1").count() == 0
    sizes = plan.groupBy("epoch", "batch_id").count().filter("count != 3").collect()
    assert [r["count"] for r in sizes] == [2, 2]


def test_steps_run_on_over_epochs(spark):
    steps = plan_of(spark, 50).groupBy("epoch").agg(F.min("step"), F.max("step")).orderBy("epoch")
    assert [tuple(r) for r in steps.collect()] == [(0, 0, 4), (1, 5, 9)]


def test_manifest_and_resume(spark):
    plan = plan_of(spark, 50)
    manifest = batches.step_manifest(plan, 2, 5, 10).orderBy("step").collect()
    assert [r["step"] for r in manifest] == list(range(10))
    assert sum(r["n_rows"] for r in manifest) == 100
    assert all(r["n_padded"] >= r["n_tokens"] >= r["n_active"] for r in manifest)
    assert [r["step"] for r in manifest if r["logs"]] == [1, 3, 5, 7, 9]
    assert [r["step"] for r in manifest if r["evaluates"]] == [4, 9]
    assert [r["step"] for r in manifest if r["saves"]] == [9]
    rest = batches.remaining_rows(plan, "outputs/x/checkpoint-9").select("step").distinct()
    assert [r["step"] for r in rest.collect()] == [9]
    assert batches.remaining_rows(plan, None).count() == 100


@pytest.mark.parametrize(
    "side,ids,mask,labels",
    [
        ("right", [4, 0, 0], [1, 0, 0], [7, IGNORE, IGNORE]),
        ("left", [0, 0, 4], [0, 0, 1], [IGNORE, IGNORE, 7]),
    ],
)
def test_padding(spark, side, ids, mask, labels):
    tokens = spark.createDataFrame(
        [(1, [1, 2, 3], [1, 1, 1], [1, 2, 3]), (2, [4], [1], [7])],
        "row_id bigint, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    plan = tokens.select(
        F.lit(0).alias("epoch"), F.lit(0).alias("batch_id"), "row_id",
        F.size("input_ids").alias("n_tokens"),
    )
    first, second = batches.pad_batches(plan, tokens, 0, side).orderBy("row_id").collect()
    assert first["input_ids"] == [1, 2, 3] and first["width"] == second["width"] == 3
    assert (second["input_ids"], second["attention_mask"], second["labels"]) == (ids, mask, labels)


def test_split_assembly_and_caps(spark):
    train = spark.range(30).withColumnRenamed("id", "row_id")
    both = assemble_splits(train, spark.range(5).withColumnRenamed("id", "row_id"))
    assert assemble_splits(train).select("split").distinct().collect() == [("train",)]
    kept = cap_records(both, 7)
    sizes = kept.groupBy("split").agg(F.count("*"), F.max("row_id"))
    assert {tuple(r) for r in sizes.collect()} == {("train", 7, 6), ("validation", 5, 4)}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan
    assert cap_records(both, 0).count() == 0
    assert cap_records(both, None).count() == 35


def test_the_nth_least_value_is_found_over_all_bits(spark):
    rng = random.Random(8)
    values = [rng.choice([-1, 1]) * rng.getrandbits(rng.choice([3, 20, 41, 63])) for _ in range(500)]
    rows = [("a" if i % 3 else "b", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    for n in (1, 2, 150, 160, 200, 400):
        want = {}
        for group in "ab":
            own = sorted(v for g, v in rows if g == group)
            if len(own) >= n:
                want[group] = own[n - 1]
        assert nth_least(df, "v", n, "g") == want


def test_spread_leaves_wide_inputs_alone(spark):
    assert spread(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == 4
    wide = spark.range(10, numPartitions=9)
    assert spread(wide, "id") is wide


def test_no_epochs_and_no_padding_id_are_refused(spark):
    with pytest.raises(ValueError):
        batches.expand_epochs(spark.range(3), 0)
    plan = spark.range(1).selectExpr("0 epoch", "0 batch_id", "id row_id", "1 n_tokens")
    with pytest.raises(ValueError):
        batches.pad_batches(plan, plan, None)


def test_written_batches_are_whole_and_in_order(spark, settings, tmp_path):
    """Read file by file, rows come batch after batch."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(2)
    sizes = {i: rng.randint(1, 9) for i in range(300)}
    tokens = spark.createDataFrame(
        [(i, list(range(n)), [1] * n, [5] * n) for i, n in sizes.items()],
        "row_id bigint, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    rows = tokens.select("row_id", F.size("input_ids").alias("n_tokens"))
    plan = batches.assign_batches(batches.seeded_order(batches.expand_epochs(rows, 2), 3), 7)
    path = tmp_path / "batches"
    batches.write_batches(plan, tokens, str(path), 99, "left")
    want = [r["row_id"] for r in plan.orderBy("epoch", "idx").collect()]
    got, owner = [], {}
    for file in sorted(path.glob("epoch=*/*.parquet")):
        for row in pq.read_table(file).to_pylist():
            got.append(row["row_id"])
            assert owner.setdefault((file.parent.name, row["batch_id"]), file.name) == file.name
            n = sizes[row["row_id"]]
            assert row["input_ids"] == [99] * (row["width"] - n) + list(range(n))
            assert row["labels"] == [-100] * (row["width"] - n) + [5] * n
    assert got == want
    assert len({name for (_, _), name in owner.items()}) > 1
