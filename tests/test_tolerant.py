"""The tolerant reader against a line-by-line reading, with blocks of a few bytes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from turnspool.sources.files import add_row_ids
from turnspool.sources.splits import cap_records
from turnspool.sources.tolerant import NOT_OBJECT, depth_change, judge, read_tolerant
from turnspool.staging import stage

EDGE_FILES = {
    "plain": ('{"a":1}\n{"a":2}\n', 2),
    "pretty": ('{\n  "a": 1\n}\n', 1),
    "two_pretty": ('{\n"a":1\n}\n{\n"a":2\n}\n', 2),
    "pretty_then_line": ('{\n"a":1\n}\n{"a":2}\n', 2),
    "junk_blank_good": ('{bad\n\n{"a":1}\n', 1),
    "junk_then_line": ('{bad\n{"a":1}\n', 1),
    "junk_then_pretty": ('{bad\n{\n"a":1\n}\n', 0),
    "cut_by_blank": ('{\n\n"a":1\n}\n', 0),
    "unfinished": ('{"a":1}\n{\n"b":2\n', 1),
    "scalar_line": ('{\n"t":[\n"x"\n]\n}\n', 0),
    "blank_is_spaces": ('{"a":1}\n   \n{"a":2}\n', 2),
    "no_last_newline": ('{"a":1}\n{"a":2}', 2),
    "empty": ("", 0),
    "trailing_text": ('{"a":1} x\n{"a":2}\n', 1),
    "brackets_in_strings": ('{\n"a": "}]{",\n"b": "\\"{"\n}\n', 1),
    "open_string": ('{\n"a": "x\ny"\n}\n{"a":1}\n', 1),
    "windows_lines": ('{\r\n"a":1\r\n}\r\n{"a":2}\r\n', 2),
    "list_over_lines": ("[\n{\n}\n]\n{\n}\n", 0),
}


def sequential(text):
    """Records as text without line ends, read one line after the other."""
    kept, pending = [], ""
    for line in text.splitlines():
        if not line.strip():
            pending = ""
            continue
        candidates = [line.strip(), pending + line + "\n"]
        whole = next((c for c in candidates if judge(c) in (None, NOT_OBJECT)), None)
        if whole is None:
            pending = candidates[1]
        else:
            pending = ""
            if judge(whole) is None:
                kept.append(json.loads(whole))
    return kept


def write(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.txt").write_bytes(text.encode())
    return str(folder)


def read_back(scan):
    """Records per file, in file order."""
    found = {}
    rows = scan.records().orderBy("file", "block", "line").collect()
    for row in rows:
        name = row["file"].rsplit("/", 1)[1].removesuffix(".txt")
        found.setdefault(name, []).append(json.loads(row["text"]))
    return found


@pytest.mark.parametrize("block_bytes", ["128m", "24"])
def test_edge_files(spark, settings, tmp_path, block_bytes):
    settings(
        spark__sql__files__maxPartitionBytes=block_bytes, spark__sql__files__openCostInBytes="1"
    )
    folder = write(tmp_path / "edge", {name: text for name, (text, _) in EDGE_FILES.items()})
    found = read_back(read_tolerant(spark, folder))
    for name, (text, count) in EDGE_FILES.items():
        want = sequential(text.replace("\r\n", "\n"))
        # "[", "{" … "]" over lines holds an object line by line in none of its parts.
        assert found.get(name, []) == want, name
        if name != "list_over_lines":
            assert len(want) == count, name


def random_file(rng):
    """Compact and pretty objects, with now and then a blank line, junk or a cut."""
    lines = []
    for i in range(rng.randint(1, 20)):
        value = {"n": i, "t": rng.choice(["x", "}{", '"', "[\\", ""]), "l": [1, {"k": []}]}
        style = rng.random()
        if style < 0.3:
            lines.append(json.dumps(value))
        elif style < 0.9:
            lines += json.dumps(value, indent=rng.choice([0, 1, 2])).split("\n")
        else:
            lines.append(rng.choice(["{bad", "]", '"open', "}", "17", '{"a":1} x', "[", "["]))
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "  "]))
        if rng.random() < 0.05:
            lines.pop()
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("block_bytes", ["100"])
def test_random_files(spark, settings, tmp_path, block_bytes):
    rng = random.Random(int(block_bytes))
    files = {f"f{i:02d}": random_file(rng) for i in range(8)}
    folder = write(tmp_path / "mixed", files)
    settings(
        spark__sql__files__maxPartitionBytes=block_bytes, spark__sql__files__openCostInBytes="1"
    )
    found = read_back(read_tolerant(spark, folder))
    for name, text in files.items():
        assert found.get(name, []) == sequential(text), name


def test_one_file_without_any_end_is_cut_in_blocks(spark, settings, tmp_path):
    """Pretty objects only: the whole file is one run, broken near its end."""
    objects = [json.dumps({"n": i, "deep": {"x": {"y": i}}}, indent=1) for i in range(120)]
    text = "\n".join(objects[:110] + ["{broken"] + objects[110:])
    folder = write(tmp_path / "run", {"run": text})
    settings(spark__sql__files__maxPartitionBytes="1500", spark__sql__files__openCostInBytes="1")
    scan = read_tolerant(spark, folder)
    assert [r["n"] for r in read_back(scan)["run"]] == list(range(110))
    lost = scan.rejects().agg(F.sum(F.size(F.split("text", "\n")))).first()[0]
    assert lost == sum(o.count("\n") + 1 for o in objects[110:]) + 1


def test_object_above_the_size_limit_is_left_out_unjoined(spark, settings, tmp_path):
    small = json.dumps({"n": 1}, indent=1)
    big = json.dumps({"n": 2, "l": {str(i): i for i in range(100)}}, indent=1)
    folder = write(tmp_path / "big", {"big": f"{small}\n{big}\n\n{small}"})
    settings(spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="1")
    found = read_back(read_tolerant(spark, folder, max_object_bytes=400))
    assert [r["n"] for r in found["big"]] == [1, 1]


@pytest.mark.parametrize("cap,count", [(2, 2), (0, 0), (-1, 0), (None, 3), (99, 3)])
def test_cap(spark, tmp_path, cap, count):
    folder = write(tmp_path / "cap", {"cap": '{"a":1}\n{\n"a":2\n}\n{"a":3}\n'})
    records = read_tolerant(spark, folder).records()
    rows = add_row_ids(records).withColumn("split", F.lit("train"))
    capped = cap_records(rows, cap).orderBy("row_id").collect()
    assert [json.loads(r["text"])["a"] for r in capped] == [1, 2, 3][:count]


def test_messages_and_rejects(spark, tmp_path):
    text = '{"messages": [{"role": "user", "content": "hi", "x": 1}], "y": 2}\n{"z": 0}\n7\n{no\n'
    scan = read_tolerant(spark, write(tmp_path / "m", {"m": text}))
    messages = [r["messages"] for r in scan.messages().orderBy("line").collect()]
    assert [[tuple(m) for m in ms] if ms else ms for ms in messages] == [[("user", "hi")], None]
    rejects = {(r["text"], r["reason"]) for r in scan.rejects().collect()}
    assert rejects == {("7", "not an object"), ("{no", "not JSON")}


def test_depth_change():
    assert depth_change('{"a": [') == 2
    assert depth_change('"}}": "\\"]"}') == -1


def test_staged_rows_keep_file_order(spark, settings, tmp_path):
    folder = write(
        tmp_path / "order",
        {f"f{i}": "".join(f'{{"n":{i * 1000 + j}}}\n' for j in range(50)) for i in range(3)},
    )
    settings(spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="1")
    rows = add_row_ids(stage(read_tolerant(spark, folder).records(), "records"))
    numbers = [json.loads(r["text"])["n"] for r in rows.orderBy("row_id").collect()]
    assert numbers == [i * 1000 + j for i in range(3) for j in range(50)]
