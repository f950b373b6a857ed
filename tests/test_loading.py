"""Chat files to records and training rows: both splits, caps that end the read, quarantine."""

import json

import pytest
from pyspark.sql import functions as F

from turnspool.operators.vocabulary import Codec
from turnspool.plans import prepare as prep
from turnspool.sources import loading
from turnspool.sources.files import read_until, scan_files
from turnspool.sources.loading import NO_MESSAGES, read_chat_files


def line(text, role="user"):
    return json.dumps({"messages": [{"role": role, "content": text}]})


def write(folder, files):
    folder.mkdir()
    for name, lines in files.items():
        (folder / f"{name}.jsonl").write_text("".join(f"{x}\n" for x in lines))
    return str(folder)


def contents(records):
    rows = records.orderBy("split", "row_id").collect()
    return [(r["split"], r["messages"][0]["content"]) for r in rows]


@pytest.fixture
def folders(tmp_path):
    train = {f"t{i}": [line(f"{i}.{k}") for k in range(4)] for i in range(9)}
    return write(tmp_path / "train", train), write(tmp_path / "val", {"v": [line("v0"), line("v1")]})


@pytest.mark.parametrize("tolerant", [False, True])
def test_both_splits_in_file_order(spark, folders, tolerant):
    loaded = read_chat_files(spark, *folders, tolerant=tolerant)
    train = [("train", f"{i}.{k}") for i in range(9) for k in range(4)]
    assert contents(loaded.records) == [*train, ("validation", "v0"), ("validation", "v1")]
    assert loaded.rejects.count() == 0
    alone = read_chat_files(spark, folders[0], tolerant=tolerant)
    assert contents(alone.records) == train


@pytest.mark.parametrize("tolerant", [False, True])
@pytest.mark.parametrize("cap", [0, 1, 5, 6, 36, 99])
def test_a_cap_gives_the_first_records_of_each_split(spark, folders, tolerant, cap):
    loaded = read_chat_files(spark, *folders, tolerant=tolerant, cap=cap)
    train = [("train", f"{i}.{k}") for i in range(9) for k in range(4)][:cap]
    assert contents(loaded.records) == train + [("validation", "v0"), ("validation", "v1")][:cap]


def test_a_cap_leaves_later_files_closed(spark, folders):
    """The last files are no chat files at all, and a strict scan would stop at them."""
    train, _ = folders
    for i in range(3, 9):
        with open(f"{train}/t{i}.jsonl", "w") as file:
            file.write("{broken\n")
    assert len(contents(read_chat_files(spark, train, cap=12).records)) == 12
    opened = []

    def read(names):
        opened.extend(names)
        return spark.read.text(names)

    rows = read_until(spark, train, 5, read)
    assert [name.rsplit("/", 1)[1] for name in opened] == ["t0.jsonl", "t1.jsonl", "t2.jsonl"]
    assert rows.count() == 12
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_chat_files(spark, train, cap=13).records.collect()
    assert len(scan_files(spark, train)) == 9


@pytest.mark.parametrize("tolerant", [False, True])
def test_what_is_no_record_is_set_aside(spark, tmp_path, tolerant):
    odd = [line("a"), "{}", '{"messages": []}', '{"messages": [{"role": "user"}]}', line("b")]
    broken = ["{no", "", "7"] if tolerant else []
    train = write(tmp_path / "odd", {"x": odd + broken})
    loaded = read_chat_files(spark, train, tolerant=tolerant)
    assert contents(loaded.records) == [("train", "a"), ("train", "b")]
    assert loaded.rejects.columns == list(loading.REJECTS)
    rejects = [tuple(r) for r in loaded.rejects.orderBy("line").select("line", "reason").collect()]
    want = [(k, NO_MESSAGES) for k in (1, 2, 3)]
    assert rejects == want + ([(5, "not JSON"), (7, "not an object")] if tolerant else [])


def test_training_rows_come_from_files_as_from_records(spark, folders):
    rows, rejects = prep.prepare_files(spark, *folders, max_pieces=50, max_length=12)
    records = read_chat_files(spark, *folders).records
    codec = Codec(prep.fit_on_train_records(records, 50))
    want = prep.prepare(records, codec, 12)
    assert rows.count() == 38 and rows.exceptAll(want).count() == 0 and rejects.count() == 0
    given, _ = prep.prepare_files(spark, folders[0], codec=codec, max_length=12, marker="user")
    marked = prep.prepare_by_marker(records.filter("split = 'train'"), codec, "user", 12)
    assert given.exceptAll(marked).count() == 0 and given.count() == 36
    empty = prep.prepare_files(spark, *folders, codec=codec, cap=0)[0]
    assert empty.count() == 0
    assert rows.filter(F.size("input_ids") > 12).count() == 0
