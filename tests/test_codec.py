"""Vocabulary, encoding, decoding and whole preparations on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from turnspool.functions.labels import IGNORE
from turnspool.functions.pieces import UNK, PieceRule, split_pieces
from turnspool.functions.template import CHATML, CHATML_TIGHT, ROLE_MARKS, ChatTemplate
from turnspool.operators import encode as encoding
from turnspool.operators.encode import decode, encode, encode_by_join
from turnspool.operators.vocabulary import (
    Codec,
    fit_vocabulary,
    load_vocabulary,
    most_frequent,
    save_vocabulary,
)
from turnspool.plans import prepare as prep
from turnspool.sources.conversations import (
    blocks_beyond,
    chat_records,
    drop_turns_beyond,
    turn_rows,
)
from turnspool.sources.files import MESSAGES
from tests.conftest import SF_DIR


def texts_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")


@pytest.fixture(scope="module")
def turns(spark):
    return spark.read.parquet(f"{SF_DIR}/conversations.parquet")


@pytest.fixture(scope="module")
def vocab(spark, turns):
    return prep.fit_on_train_turns(turns, 500)


@pytest.fixture(scope="module")
def codec(vocab):
    return Codec(vocab)


def test_vocabulary_order(spark):
    df = texts_of(spark, ["b b a a c", "a<|im_end|> é"])
    rows = fit_vocabulary(df, F.col("text"), 4).orderBy("id").collect()
    assert [r["piece"] for r in rows] == [
        "<|unk|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", " ", "a", "b", "c",
    ]
    assert [r["id"] for r in rows] == list(range(8))
    assert [r["n"] for r in rows][4:] == [5, 3, 2, 1]
    assert [r["is_special"] for r in rows] == [True] * 4 + [False] * 4


@pytest.mark.parametrize("size", [1, 3, 40, 41, 300, 4000])
def test_the_most_frequent_pieces_with_ties_cut_by_text(spark, monkeypatch, size):
    monkeypatch.setattr("turnspool.operators.order.FEW", 2)
    rng = random.Random(9)
    pieces = {"".join(rng.choices("abcé漢", k=rng.randint(1, 5))): rng.randint(1, 3) for _ in range(400)}
    counts = spark.createDataFrame(list(pieces.items()), "piece string, n bigint")
    want = sorted(pieces.items(), key=lambda p: (-p[1], p[0].encode()))[:size]
    chosen = most_frequent(counts, size)
    assert sorted(map(tuple, chosen.collect())) == sorted(want)
    assert "TakeOrdered" not in chosen._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [0, -1, 1 << 31])
def test_vocabulary_size_is_checked(spark, monkeypatch, size):
    with pytest.raises(ValueError):
        fit_vocabulary(texts_of(spark, ["a"]), F.col("text"), size)
    monkeypatch.setattr("turnspool.operators.vocabulary.MAX_BYTES", 30)
    with pytest.raises(ValueError, match="bytes"):
        Codec(fit_vocabulary(texts_of(spark, ["a"]), F.col("text"), 1))


def test_long_runs_are_one_piece(spark):
    text = "x" * 5000 + "1" * 300
    vocab = fit_vocabulary(texts_of(spark, [text]), F.col("text"), 5)
    learned = vocab.filter("id > 3").orderBy("id").select("piece").collect()
    assert [r["piece"] for r in learned] == ["1" * 300, "x" * 5000]
    codec = Codec(vocab)
    ids = texts_of(spark, [text, "x"]).select(encode(F.col("text"), codec)).collect()
    assert [r[0] for r in ids] == [[5, 4], [0]]


def test_marks_are_data_of_the_vocabulary(spark, tmp_path):
    """Longest first, regular expressions taken literally, also inside runs and with whitespace."""
    rule = PieceRule((UNK, "[X]", "[X]+", "end", "a b", "7"))
    text = "[X]+[X] bend a b17end.ab"
    want = ["[X]+", "[X]", " ", "b", "end", " ", "a b", "1", "7", "end", ".", "ab"]
    df = texts_of(spark, [text])
    assert df.select(split_pieces(F.col("text"), rule)).first()[0] == want
    path = str(tmp_path / "v")
    save_vocabulary(fit_vocabulary(df, F.col("text"), 50, rule), path)
    codec = Codec(load_vocabulary(spark, path), eos="end")
    assert codec.rule == rule and codec.eos_id == 3
    ids = encode(F.col("text"), codec)
    assert df.select(F.slice(ids, 1, 2)).first()[0] == [2, 1]
    assert df.select(decode(ids, codec)).first()[0] == " b 1.ab"
    assert df.select(decode(ids, codec, False)).first()[0] == text


def test_a_template_needs_a_vocabulary_with_its_marks(spark, turns, codec):
    records = chat_records(turns, 50)
    with pytest.raises(ValueError, match="marks"):
        prep.prepare(records, codec, 50, ROLE_MARKS)
    with pytest.raises(ValueError, match="marks"):
        prep.prepare_by_marker(records, codec, "<|assistant|>", 50, ROLE_MARKS)
    assert ROLE_MARKS.splits_at_messages
    assert not ChatTemplate(after="\n", marks=(UNK, "a\nb")).splits_at_messages


def test_turns_and_records_give_the_same_vocabulary(spark, turns, vocab):
    records = chat_records(turns, 100_000)
    assert prep.fit_on_train_records(records, 500).exceptAll(vocab).count() == 0


def test_save_and_load(spark, vocab, tmp_path):
    path = str(tmp_path / "vocab")
    save_vocabulary(vocab, path)
    loaded = load_vocabulary(spark, path)
    assert loaded.count() == vocab.count()
    assert loaded.exceptAll(vocab).count() == 0


@pytest.mark.parametrize(
    "rows",
    [
        [("<|unk|>", 0, True), ("a", 2, False)],
        [("<|unk|>", 0, True), ("<|unk|>", 1, False)],
        [("a", 0, False)],
        [("a", 0, True), ("<|unk|>", 1, True)],
    ],
)
def test_broken_vocabularies_are_refused(spark, rows):
    table = spark.createDataFrame(rows, "piece string, id int, is_special boolean")
    with pytest.raises(ValueError):
        Codec(table, eos=None)


def test_special_ids(codec, vocab):
    assert codec.resolve("eos", "left").pad_id == codec.eos_id == 2
    assert codec.resolve("<|endoftext|>").pad_id == 3
    assert codec.resolve(None).pad_id is None
    assert codec.resolve().padding_side == "right"
    assert Codec(vocab, eos=None).eos_id is None
    with pytest.raises(ValueError):
        codec.resolve("<|nothing|>")
    with pytest.raises(ValueError):
        codec.resolve("eos", "middle")


def test_decode_gives_the_text_back(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab1 .\n漢😀", k=rng.randint(0, 30))) for _ in range(200)]
    df = texts_of(spark, texts)
    codec = Codec(fit_vocabulary(df, F.col("text"), 1000))
    ids = df.withColumn("ids", encode(F.col("text"), codec))
    assert ids.filter(decode(F.col("ids"), codec) != F.col("text")).count() == 0


def test_decode_skips_specials_and_unknown_ids(spark):
    codec = Codec(fit_vocabulary(texts_of(spark, ["a a b"]), F.col("text"), 10))
    df = spark.createDataFrame(
        [([1, 4, 2, 5],), ([0, 1],), ([],), (None,), ([99, -3, 4],)], "ids array<int>"
    )
    hidden = [r[0] for r in df.select(decode(F.col("ids"), codec)).collect()]
    # " " and "a" both occur twice; the blank comes first.
    assert hidden == [" a", "", "", "", " "]
    shown = [r[0] for r in df.select(decode(F.col("ids"), codec, False)).collect()]
    assert shown[1] == "<|unk|><|im_start|>"


def test_encode_marks_unknown_pieces_and_cuts(spark):
    codec = Codec(fit_vocabulary(texts_of(spark, ["a a b"]), F.col("text"), 1))
    df = texts_of(spark, ["a a", "zzz", "", None])
    ids = [r[0] for r in df.select(encode(F.col("text"), codec, 2)).collect()]
    known = ids[0]
    assert len(known) == 2 and set(known) == {0, 4}
    assert ids[1:] == [[0], [], []]


def test_batches_of_many_rows(spark, settings, codec):
    """More rows than an Arrow batch, empty ones among them."""
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    df = spark.range(100, numPartitions=1).select(
        "id", F.repeat(F.lit("<|im_end|>"), (F.col("id") % 5).cast("int")).alias("text")
    )
    rows = df.select("id", encode(F.col("text"), codec).alias("ids")).collect()
    assert all(r["ids"] == [2] * (r["id"] % 5) for r in rows)


def test_both_ways_to_split_agree(spark, turns):
    """Piece by message against piece by text, for a template that allows both."""
    records = chat_records(turns, 300)

    class Whole(ChatTemplate):
        splits_at_messages = False

    fast = prep.split_records(records, 300, CHATML)
    slow = prep.split_records(records, 300, Whole())
    assert fast.exceptAll(slow).count() == 0
    assert slow.exceptAll(fast).count() == 0


def test_headers_that_join_the_last_message(spark):
    """The header is no piece of its own where neither side of its border is whitespace."""
    template = ChatTemplate(before=" ", between=" ", after="x", header="abc")
    assert template.splits_at_messages and not template.splits_at_header
    messages = [("user", "a"), ("assistant", "b")]
    records = spark.createDataFrame(
        [(0, "train", messages)], f"row_id long, split string, messages {MESSAGES}"
    )
    # " ", "user", " ", "axabc"
    assert prep.split_records(records, None, template).head()["prompt_length"] == 4


def test_prepared_rows(spark, turns, codec):
    for template in (CHATML, CHATML_TIGHT):
        rows = prep.prepare(chat_records(turns, 200), codec, 200, template)
        size = F.size("input_ids")
        assert rows.count() == turns.select("conv_id").distinct().count()
        assert rows.filter(
            (size > 200) | (size != F.size("labels")) | (size != F.size("attention_mask"))
        ).count() == 0
        kept = F.zip_with("input_ids", "labels", lambda i, x: (x == IGNORE) | (x == i))
        assert rows.filter(~F.forall(kept, lambda ok: ok)).count() == 0


def test_counts_agree_with_prepared_rows(spark, turns, codec):
    for template in (CHATML, CHATML_TIGHT):
        records = chat_records(turns, 400)
        counts = prep.piece_counts(records, 400, "<|im_end|>", template).drop("n_prompt")
        prepared = prep.prepare(records, codec, 400, template)
        want = prep.label_counts(prepared)
        assert counts.exceptAll(want).count() == 0


def test_unusable_records(spark, codec):
    rows = [(1, "train", [("user", "a")]), (2, "train", []), (3, "train", None)]
    df = spark.createDataFrame(rows, f"row_id bigint, split string, messages {MESSAGES}")
    with pytest.raises(Exception, match="row_id [23]"):
        prep.prepare(df, codec).collect()
    skipped = prep.prepare(df, codec, on_unusable="skip").collect()
    assert [r["row_id"] for r in skipped] == [1]
    assert {r["row_id"] for r in prep.unusable_records(df).collect()} == {2, 3}


def test_written_splits(spark, turns, codec, tmp_path):
    path = str(tmp_path / "prepared")
    prepared = prep.prepare(chat_records(turns, 50), codec, 50)
    prep.write_prepared(prepared, path)
    read = spark.read.parquet(path)
    assert read.select(prepared.columns).exceptAll(prepared).count() == 0
    plan = read.filter("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


@pytest.fixture
def long_turns(spark):
    """Conversation 1 has 5,000 turns with gaps in their numbers, 2 to 21 have three."""
    long = spark.range(5000).select(
        F.lit(1).cast("bigint").alias("conv_id"),
        (F.col("id") * 3).alias("turn"),
        F.lit("user").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    short = spark.range(60).select(
        (F.col("id") % 20 + 2).alias("conv_id"),
        F.floor(F.col("id") / 20).alias("turn"),
        F.lit("assistant").alias("role"),
        F.lit("ok").alias("text"),
    )
    return long.unionByName(short)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 1])
def test_long_conversations_are_cut_before_they_are_gathered(
    spark, long_turns, codec, monkeypatch, broadcast_rows
):
    monkeypatch.setattr("turnspool.sources.conversations.BROADCAST_ROWS", broadcast_rows)
    rows = turn_rows(long_turns)
    assert blocks_beyond(rows, 65).select("row_id").distinct().collect() == [(1,)]
    sizes = dict(map(tuple, drop_turns_beyond(rows, 65).groupBy("row_id").count().collect()))
    assert 65 <= sizes.pop(1) <= 65 + 1024
    assert set(sizes.values()) == {3} and len(sizes) == 20
    got = prep.prepare(chat_records(long_turns, 64), codec, 64)
    want = prep.prepare(chat_records(long_turns, 100_000), codec, 64)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_long_conversation_is_one_row_of_whole_text(spark, long_turns):
    records = chat_records(long_turns)
    assert records.filter("row_id = 1").select(F.size("messages")).collect() == [(5000,)]
    turn = "<|im_start|>user\n{}<|im_end|>\n"
    texts, prompts = (
        {r["row_id"]: r["text"] for r in render(records).collect()}
        for render in (prep.render_texts, prep.render_prompts)
    )
    assert texts[1] == "".join(turn.format(i) for i in range(5000))
    assert prompts[1] == "".join(turn.format(i) for i in range(4999)) + CHATML.header
    assert len(texts) == len(prompts) == 21


@pytest.mark.parametrize("column", ["role", "text"])
def test_a_null_behind_the_cut_makes_a_conversation_unusable(spark, long_turns, codec, column):
    """Turn 4,500 lies far behind the 64 pieces that are kept."""
    spoiled = long_turns.withColumn(
        column,
        F.when((F.col("conv_id") != 1) | (F.col("turn") != 4500 * 3), F.col(column)),
    )
    with pytest.raises(Exception, match="without usable messages, row_id 1"):
        prep.prepare(chat_records(spoiled, 64), codec, 64).collect()
    rows = prep.prepare(chat_records(spoiled, 64), codec, 64, on_unusable="skip")
    assert rows.count() == 20
    left_out = prep.unusable_records(chat_records(spoiled, 64)).select("row_id", F.size("messages"))
    ((row_id, size),) = left_out.collect()
    assert row_id == 1 and size <= 65 + 1024 + 1


@pytest.mark.parametrize("max_length", [None, 7])
def test_lookup_by_join_gives_the_same_ids(spark, vocab, codec, max_length, monkeypatch):
    monkeypatch.setattr(encoding, "BATCH_BITS", 2)
    monkeypatch.setattr(encoding, "BATCH_PIECES", 50)
    rng = random.Random(4)
    known = [r["piece"] for r in vocab.collect()]
    texts = ["", None, "ζζζ ζζζ", "<|im_start|>user\n", "a" * 5000, "the " * 4000]
    texts += ["".join(rng.choices(known, k=rng.randrange(90))) for _ in range(60)]
    df = texts_of(spark, texts).select(
        "row_id", "text", F.lit(1).alias("piece"), F.lit(2).alias("batch"), F.lit(3).alias("a.b")
    )
    joined = encode_by_join(df, F.col("text"), vocab, max_length)
    assert joined.columns == [*df.columns, "input_ids"]
    want = df.withColumn("input_ids", encode(F.col("text"), codec, max_length))
    assert sorted(joined.collect()) == sorted(want.collect())


def test_lookup_by_join_of_no_rows_and_of_unknown_pieces(spark, vocab):
    empty = texts_of(spark, ["a"]).limit(0)
    assert encode_by_join(empty, F.col("text"), vocab).collect() == []
    rows = encode_by_join(texts_of(spark, ["ζ", "", "ζζ"]), F.col("text"), vocab).collect()
    assert {r["row_id"]: r["input_ids"] for r in rows} == {0: [0], 1: [], 2: [0]}


def test_lookup_by_join_asks_for_a_piece_once_per_batch(spark, vocab):
    rows = encode_by_join(
        texts_of(spark, ["the the the"] * 600), F.col("text"), vocab, name="text"
    )
    assert rows.columns == ["row_id", "text"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 1 and "Aggregate [by" in plan
    assert len({tuple(r["text"]) for r in rows.collect()}) == 1
