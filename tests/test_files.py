"""Strict scans, prompt files and line counts."""

import json
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from turnspool.sources import files, tolerant
from turnspool.staging import shared_dir, stage


def test_strict_scan_keeps_order_and_drops_other_fields(spark, settings, tmp_path):
    settings(spark__sql__files__maxPartitionBytes="4000", spark__sql__files__openCostInBytes="1")
    for name in ("a", "b"):
        lines = [
            json.dumps({"id": i, "messages": [{"role": "user", "content": f"{name}{i}", "z": 1}]})
            for i in range(200)
        ]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    rows = files.read_chat_jsonl(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")])
    assert rows.columns == ["messages", "file", "block", "line"]
    assert rows.select("file", "block").distinct().count() > 4
    names = files.scan_files(spark, str(tmp_path))
    want = [f"{name}{i}" for name in "ab" for i in range(200)]
    for numbered in (files.add_row_ids(rows, names), files.add_row_ids(stage(rows, "scan"))):
        found = numbered.orderBy("row_id").collect()
        assert [r["messages"][0]["content"] for r in found] == want
        assert len({r["row_id"] for r in found}) == 400
        # The id is worked out where a row is read.
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("at_once", [2, 100_000])
def test_row_ids_of_files_with_odd_names(spark, monkeypatch, tmp_path, at_once):
    monkeypatch.setattr(files, "BROADCAST_FILES", at_once)
    for i, name in enumerate(["a b", "c+d", "e%20f", "é", "sub=1/x", "zz"]):
        path = tmp_path / f"{name}.jsonl"
        path.parent.mkdir(exist_ok=True)
        path.write_text(
            "".join(f'{{"messages": [{{"role": "r", "content": "{i}-{k}"}}]}}\n' for k in range(3))
        )
    paths = [str(tmp_path), str(tmp_path / "sub=1")]
    rows = files.read_chat_jsonl(spark, paths)
    found = files.add_row_ids(rows, files.scan_files(spark, paths)).orderBy("row_id").collect()
    texts = [r["messages"][0]["content"] for r in found]
    assert len(texts) == 18 and len({r["row_id"] for r in found}) == 18
    by_file = [texts[k : k + 3] for k in range(0, 18, 3)]
    assert all(part == [f"{part[0][0]}-{k}" for k in range(3)] for part in by_file)


def test_packed_blocks_are_refused(spark, settings, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"messages": []}\n')
    settings(spark__sql__files__maxPartitionNum="1")
    with pytest.raises(ValueError, match="maxPartitionNum"):
        files.add_row_ids(files.read_chat_jsonl(spark, str(tmp_path)))


def test_strict_scan_stops_at_a_broken_line(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"messages": []}\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_chat_jsonl(spark, str(tmp_path / "x.jsonl")).collect()


def test_prompt_files_and_choice(spark, tmp_path):
    messages = [{"role": "system", "content": "s"}, {"role": "user", "content": "from\nfile"}]
    (tmp_path / "p7.json").write_text(json.dumps(messages, indent=2))
    (tmp_path / "p8.json").write_text(json.dumps(messages[:1]))
    read = files.read_prompt_files(spark, str(tmp_path))
    found = {r["file_name"]: [m["content"] for m in r["messages"]] for r in read.collect()}
    assert found == {"p7.json": ["s", "from\nfile"], "p8.json": ["s"]}
    filed = read.withColumn("prompt_id", F.regexp_extract("file_name", r"\d+", 0).cast("bigint"))
    built = spark.createDataFrame(
        [(7, [("user", "text")]), (9, [("user", "text")])],
        f"prompt_id bigint, messages {files.MESSAGES}",
    )
    rows = files.choose_prompts(built, filed).collect()
    chosen = {r["prompt_id"]: r["messages"][-1]["content"] for r in rows}
    assert chosen == {7: "from\nfile", 9: "text"}


def test_broken_prompt_file_stops_the_job(spark, tmp_path):
    (tmp_path / "p.json").write_text('[{"role": "user"')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_prompt_files(spark, str(tmp_path)).collect()


def test_line_counts(spark, tmp_path):
    (tmp_path / "two.jsonl").write_text("{}\n{}")
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "folder").mkdir()
    (tmp_path / "folder" / "part-0").write_text("{}\n")
    (tmp_path / "folder" / "part-1").write_text("\n{}\n")
    expected = ["two.jsonl", "empty.jsonl", "folder", "gone.jsonl"]
    counted = files.count_lines(spark, str(tmp_path), expected).collect()
    assert {tuple(r) for r in counted} == {
        ("two.jsonl", True, 2),
        ("empty.jsonl", True, 0),
        ("folder", True, 3),
        ("gone.jsonl", False, 0),
    }


def test_staged_tables_go_to_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3), "numbers")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark))


def test_task_code_runs_where_the_package_is_not_installed():
    """As on an executor: another process, another folder, no copy of this repository."""
    code = (
        "import pickle, sys, pyarrow as pa\n"
        "scan = pickle.loads(sys.stdin.buffer.read())\n"
        "batch = pa.record_batch([['{\"a\":1}', 'x'], ['f', 'f'], [0, 0]], names=['t', 'f', 'b'])\n"
        "print(sum(out.num_rows for out in scan(iter([batch]))))\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code],
        input=cloudpickle.dumps(tolerant.scan_blocks),
        capture_output=True,
        cwd="/",
        env={},
    )
    # One record, one open line that ends no object, and the two ends of the block.
    assert done.stdout.split() == [b"4"], done.stderr


def test_line_counts_in_folders_with_spaces(spark, tmp_path):
    root = tmp_path / "a b+c"
    root.mkdir()
    (root / "x y.jsonl").write_text("1\n2\n")
    (root / "100%.jsonl").write_text("1\n")
    names = ["x y.jsonl", "100%.jsonl", "none.jsonl"]
    rows = files.count_lines(spark, str(root), names).collect()
    assert {tuple(r)[:1] + (r["found"], r["n_lines"]) for r in rows} == {
        ("x y.jsonl", True, 2), ("100%.jsonl", True, 1), ("none.jsonl", False, 0)
    }
