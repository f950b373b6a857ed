"""Chat records to training rows ``(row_id, split, input_ids, attention_mask, labels)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnspool.functions.labels import (
    attention_mask,
    capped_prompt_length,
    labels_by_length,
    labels_by_marker,
)
from turnspool.functions.pieces import TURN_END, split_pieces
from turnspool.functions.template import (
    CHATML,
    ChatTemplate,
    all_but_last,
    is_usable,
    render_chat,
    render_message,
    render_prompt,
    split_messages,
)
from turnspool.operators.encode import encode, lookup_ids, truncate
from turnspool.operators.reports import first_row, label_counts
from turnspool.operators.vocabulary import Codec, fit_vocabulary
from turnspool.sources.conversations import TRAIN, turn_rows
from turnspool.sources.loading import Paths, read_chat_files
from turnspool.sources.splits import cap_records
from turnspool.staging import stage

DEFAULT_MAX_LENGTH = 4096
DEFAULT_PIECES = 32_000


def render_texts(records: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """``(row_id, text)``: the whole conversation."""
    return records.select("row_id", render_chat(F.col("messages"), template).alias("text"))


def render_prompts(records: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """``(row_id, text)``: all but the last message, and the header that opens the reply."""
    return records.select("row_id", render_prompt(F.col("messages"), template).alias("text"))


def usable_records(records: DataFrame, on_unusable: str = "raise") -> DataFrame:
    """Records whose messages can be rendered; others stop the job or, on ``"skip"``, are left out.

    ``unusable_records`` returns what ``"skip"`` leaves out.
    """
    usable = is_usable(F.col("messages"))
    if on_unusable == "skip":
        return records.filter(usable)
    if on_unusable != "raise":
        raise ValueError(f"on_unusable must be raise or skip, got {on_unusable!r}")
    complaint = F.raise_error(
        F.concat(F.lit("record without usable messages, row_id "), F.col("row_id").cast("string"))
    )
    return records.withColumn("messages", F.when(usable, F.col("messages")).otherwise(complaint))


def unusable_records(records: DataFrame) -> DataFrame:
    return records.filter(~is_usable(F.col("messages")))


def fit_on_train_turns(turns: DataFrame, max_pieces: int, template: ChatTemplate = CHATML) -> DataFrame:
    """A vocabulary from the rendered train split.

    Counted turn by turn where the template keeps pieces inside messages: no conversation is
    ever put together for it.
    """
    if not template.splits_at_messages:
        raise ValueError("pieces of this template can reach over a message border")
    train = turn_rows(turns).filter(F.col("split") == TRAIN)
    return fit_vocabulary(
        train, render_message(F.col("role"), F.col("content"), template), max_pieces, template.rule
    )


def fit_on_train_records(
    records: DataFrame, max_pieces: int, template: ChatTemplate = CHATML
) -> DataFrame:
    """The same from whole records."""
    train = records.filter(F.col("split") == TRAIN)
    return fit_vocabulary(
        train, render_chat(F.col("messages"), template), max_pieces, template.rule
    )


def checked(codec: Codec, template: ChatTemplate) -> Codec:
    if codec.rule != template.rule:
        raise ValueError("the vocabulary has other marks than the template")
    return codec


def split_records(
    records: DataFrame, max_length: int | None, template: ChatTemplate = CHATML
) -> DataFrame:
    """``(row_id, split, pieces, prompt_length)``: pieces of the full text, cut to ``max_length``.

    The prompt is only counted, never encoded. Where pieces stay inside messages and header, each
    message is split once and the prompt is the sum of all but the last.
    """
    messages = F.col("messages")
    if template.splits_at_messages and template.splits_at_header:
        split = records.select("row_id", "split", split_messages(messages, template).alias("_parts"))
        parts = F.col("_parts")
        pieces = F.flatten(parts)
        prompt_length = F.aggregate(
            all_but_last(parts), F.lit(0), lambda total, part: total + F.size(part)
        ) + F.size(split_pieces(F.lit(template.header), template.rule))
    else:
        split = records
        pieces = split_pieces(render_chat(messages, template), template.rule)
        prompt_length = F.size(split_pieces(render_prompt(messages, template), template.rule))
    if max_length is not None:
        prompt_length = F.least(prompt_length, F.lit(max_length))
    return split.select(
        "row_id",
        "split",
        truncate(pieces, max_length).alias("pieces"),
        prompt_length.alias("prompt_length"),
    )


def tokenized(input_ids: Column, labels: Column) -> list[Column]:
    return [
        input_ids.alias("input_ids"),
        attention_mask(input_ids).alias("attention_mask"),
        labels.alias("labels"),
    ]


def prepare(
    records: DataFrame,
    codec: Codec,
    max_length: int | None = DEFAULT_MAX_LENGTH,
    template: ChatTemplate = CHATML,
    on_unusable: str = "raise",
) -> DataFrame:
    """Labels by length: what the prompt takes up is ignored. No shuffle."""
    encoded = split_records(usable_records(records, on_unusable), max_length, template).select(
        "row_id",
        "split",
        lookup_ids(F.col("pieces"), checked(codec, template)).alias("input_ids"),
        "prompt_length",
    )
    ids = F.col("input_ids")
    labels = labels_by_length(ids, F.col("prompt_length"), codec.eos_id)
    return encoded.select("row_id", "split", *tokenized(ids, labels))


def prepare_by_marker(
    records: DataFrame,
    codec: Codec,
    marker: str,
    max_length: int | None = DEFAULT_MAX_LENGTH,
    template: ChatTemplate = CHATML,
    on_unusable: str = "raise",
) -> DataFrame:
    """Labels by marker: only what follows the last occurrence of ``marker`` counts."""
    texts = usable_records(records, on_unusable).select(
        "row_id", "split", render_chat(F.col("messages"), template).alias("text")
    )
    return encode_with_marker(texts, checked(codec, template), marker, max_length)


def encode_with_marker(
    texts: DataFrame, codec: Codec, marker: str, max_length: int | None = DEFAULT_MAX_LENGTH
) -> DataFrame:
    """The cut comes before the search, so a marker behind it does not count."""
    encoded = texts.select(
        "row_id", "split", encode(F.col("text"), codec, max_length).alias("input_ids")
    )
    ids = F.col("input_ids")
    labels = labels_by_marker(ids, marker_ids(encoded, marker, codec), codec.eos_id)
    return encoded.select("row_id", "split", *tokenized(ids, labels))


def marker_ids(df: DataFrame, marker: str, codec: Codec) -> Column:
    """The marker's ids as a constant, encoded once on a one-row frame."""
    one = df.sparkSession.range(1).select(encode(F.lit(marker), codec).alias("ids"))
    ids = one.first()["ids"]
    return F.array(*[F.lit(i) for i in ids]).cast("array<int>")


def piece_counts(
    records: DataFrame,
    max_length: int | None = DEFAULT_MAX_LENGTH,
    eos: str | None = None,
    template: ChatTemplate = CHATML,
) -> DataFrame:
    """``(row_id, split, n_tokens, n_prompt, n_active)`` as ``prepare`` gives them, without ids.

    A batch plan needs no more than this, and it needs no vocabulary.
    """
    rows = split_records(records, max_length, template)
    size, prompt = F.size("pieces"), capped_prompt_length(F.col("prompt_length"), F.col("pieces"))
    closes = F.lit(0)
    if eos is not None:
        last_is_eos = F.get(F.col("pieces"), size - 1) == eos
        closes = F.when((prompt < size) & last_is_eos, F.lit(1)).otherwise(closes)
    return rows.select(
        "row_id",
        "split",
        size.cast("bigint").alias("n_tokens"),
        prompt.cast("bigint").alias("n_prompt"),
        (size - prompt - closes).cast("bigint").alias("n_active"),
    )


def prepare_files(
    spark: SparkSession,
    train: Paths,
    validation: Paths | None = None,
    codec: Codec | None = None,
    max_pieces: int = DEFAULT_PIECES,
    max_length: int | None = DEFAULT_MAX_LENGTH,
    marker: str | None = None,
    template: ChatTemplate = CHATML,
    eos: str | None = TURN_END,
    tolerant: bool = False,
    cap: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """From chat files to training rows of both splits, and what was set aside on the way.

    Without a ``codec`` a vocabulary of ``max_pieces`` is fitted on the train records, which are
    read once more for it. Labels are by length, or by ``marker`` where one is given.
    """
    files = read_chat_files(spark, train, validation, tolerant, cap)
    if codec is None:
        vocabulary = fit_on_train_records(files.records, max_pieces, template)
        codec = Codec(vocabulary, eos)
    if marker is None:
        rows = prepare(files.records, codec, max_length, template)
    else:
        rows = prepare_by_marker(files.records, codec, marker, max_length, template)
    return rows, files.rejects


def smoke_report(
    records: DataFrame, codec: Codec, max_length: int, sample_size: int | None = None
) -> DataFrame:
    """Length and active labels of the first train row of a capped load.

    The whole sample is prepared, so that a bad record anywhere in it shows; its counts are staged.
    """
    sample = cap_records(records, sample_size)
    return first_row(stage(label_counts(prepare(sample, codec, max_length)), "smoke-counts"))


def write_prepared(prepared: DataFrame, path: str) -> None:
    """One folder per split, so that a reader of one split opens no other file."""
    prepared.write.partitionBy("split").parquet(path)
