"""Label masks, rendering and piece splitting on small literal inputs."""

import random

import pytest
from pyspark.sql import functions as F

from turnspool.functions.labels import (
    IGNORE,
    active_labels,
    attention_mask,
    labels_by_length,
    labels_by_marker,
)
from turnspool.functions.pieces import split_pieces
from turnspool.functions.template import (
    CHATML,
    CHATML_TIGHT,
    ChatTemplate,
    chat_prompt,
    is_usable,
    render_chat,
    render_prompt,
)
from turnspool.sources.files import MESSAGES

EOS = 2
X = IGNORE


def ints(values):
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "ids,marker,labels",
    [
        ([1, 9, 9, 5, 9, 9, 7, 2], [9, 9], [X] * 6 + [7, X]),
        ([1, 2], [9, 9, 9], [X, X]),
        ([9, 9], [9, 9], [X, X]),
        ([3, 4], [], [X, X]),
        ([9, 9, 2], [9, 9], [X, X, X]),
        ([], [9], []),
        ([9, 9, 9, 4, 2, 2], [9, 9], [X, X, X, 4, 2, X]),
        ([9, 4], [9], [X, 4]),
    ],
)
def test_labels_by_marker(spark, ids, marker, labels):
    assert value(spark, labels_by_marker(ints(ids), ints(marker), EOS)) == labels


@pytest.mark.parametrize(
    "ids,prompt,labels",
    [
        ([5, 6, 7, 8], 2, [X, X, 7, 8]),
        ([5, 6, 7, 2], 2, [X, X, 7, X]),
        ([5, 6], 9, [X, X]),
        ([5, 6], 0, [5, 6]),
        ([], 3, []),
        ([5, 2, 2], 0, [5, 2, X]),
        ([2], 0, [X]),
        ([5, 2], 2, [X, X]),
    ],
)
def test_labels_by_length(spark, ids, prompt, labels):
    assert value(spark, labels_by_length(ints(ids), F.lit(prompt), EOS)) == labels


def test_without_an_eos_id_the_last_label_stays(spark):
    assert value(spark, labels_by_length(ints([5, 2]), F.lit(1), None)) == [X, 2]
    assert value(spark, labels_by_marker(ints([5, 2]), ints([5]), None)) == [X, 2]


def test_random_markers_against_a_scan(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        ids = [rng.randint(1, 3) for _ in range(rng.randint(0, 12))]
        marker = [rng.randint(1, 3) for _ in range(rng.randint(1, 3))]
        ends = [
            i + len(marker) for i in range(len(ids)) if ids[i : i + len(marker)] == marker
        ]
        opened = ends[-1] if ends else len(ids)
        labels = [X] * opened + ids[opened:]
        if labels and labels[-1] == EOS:
            labels[-1] = X
        rows.append((ids, marker, labels))
    df = spark.createDataFrame(rows, "ids array<int>, marker array<int>, labels array<int>")
    wrong = df.filter(labels_by_marker(F.col("ids"), F.col("marker"), EOS) != F.col("labels"))
    assert wrong.count() == 0


def test_mask_and_active_labels(spark):
    assert value(spark, attention_mask(ints([4, 5]))) == [1, 1]
    assert value(spark, attention_mask(ints([]))) == []
    assert value(spark, active_labels(ints([X, 4, X, 0]))) == 2


def messages(spark, pairs):
    return spark.createDataFrame([(pairs,)], f"messages {MESSAGES}")


def test_rendering(spark):
    df = messages(spark, [("user", "a b"), ("assistant", "c")])
    m = F.col("messages")
    full, prompt, open_ended = df.select(
        render_chat(m), render_prompt(m), render_chat(m, CHATML, add_generation_prompt=True)
    ).first()
    first = "<|im_start|>user\na b<|im_end|>\n"
    assert full == first + "<|im_start|>assistant\nc<|im_end|>\n"
    assert prompt == first + "<|im_start|>assistant\n"
    assert open_ended == full + "<|im_start|>assistant\n"


def test_prompt_of_one_message_is_the_header(spark):
    df = messages(spark, [("user", "a")])
    assert df.select(render_prompt(F.col("messages"))).first()[0] == CHATML.header


def test_prompt_from_text(spark):
    built = value(spark, chat_prompt("be brief", F.lit("why?")))
    assert [tuple(m) for m in built] == [("system", "be brief"), ("user", "why?")]


def test_usable_messages(spark):
    rows = [
        ([("user", "a")], True),
        ([], False),
        (None, False),
        ([("user", None)], False),
        ([(None, "a")], False),
        ([("user", ""), ("user", "b")], True),
    ]
    df = spark.createDataFrame(rows, f"messages {MESSAGES}, ok boolean")
    assert df.filter(is_usable(F.col("messages")) != F.col("ok")).count() == 0


def test_templates_know_whether_pieces_stay_inside_messages():
    assert CHATML.splits_at_messages
    assert not CHATML_TIGHT.splits_at_messages
    assert ChatTemplate(before="\n#", after="").splits_at_messages


def test_pieces_are_lossless(spark):
    rng = random.Random(3)
    alphabet = list("aZé9٣ \t\r\n.,|<>漢字 \x0b\xa0😀\"\\") + ["<|im_end|>", "<|im_", "b" * 70]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn(
        "pieces", split_pieces(F.col("text"))
    )
    assert df.filter(F.array_join("pieces", "") != F.col("text")).count() == 0


def test_special_pieces_and_long_runs(spark):
    text = "<|im_start|>x<|im_end|><|unk|>" + "a" * 130
    pieces = value(spark, split_pieces(F.lit(text)))
    assert pieces[:3] == ["<|im_start|>", "x", "<|im_end|>"]
    assert pieces[3:8] == ["<", "|", "unk", "|", ">"]
    assert pieces[8:] == ["a" * 130]
