"""Registered queries: every operator on the given tables, as (spark, sf_dir) -> DataFrame.

Arrays are returned as space-separated strings, and counts as bigint, so that results of
different engines compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnspool.functions import labels as masks
from turnspool.functions.pieces import TURN_END, split_pieces
from turnspool.functions.template import (
    CHATML,
    CHATML_TIGHT,
    ROLE_MARKS,
    chat_prompt,
    render_chat,
)
from turnspool.operators import batches, reports
from turnspool.operators.encode import decode, encode, encode_by_join, lookup_ids, truncate
from turnspool.operators.order import global_index, long_levels
from turnspool.operators.vocabulary import Codec, load_vocabulary, save_vocabulary
from turnspool.plans import prepare as prep
from turnspool.sources import files, splits, tolerant
from turnspool.sources.conversations import (
    TRAIN,
    VALIDATION,
    chat_records,
    conversation_sizes,
    gather_messages,
    turn_rows,
)
from turnspool.sources.loading import read_chat_files
from turnspool.staging import fresh_path, spread, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_LENGTH = 1024
SHORT_LENGTH = 64
VOCABULARY = 2000
SYSTEM_PROMPT = "You are a helpful assistant."
MARKER = CHATML.header
ROLE_MARKER = "<|assistant|>"
TOKENS = ("input_ids", "attention_mask", "labels")
SAMPLE = 20

SEED = 17
EPOCHS = 2
BATCH = 4
ACCUMULATION = 2
WORLD = 2
LOGGING_STEPS, EVAL_STEPS, SAVE_STEPS = 2, 5, 10
CHECKPOINT = "outputs/run/checkpoint-3"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def records_of(spark: SparkSession, sf_dir: str, max_length: int = MAX_LENGTH) -> DataFrame:
    return chat_records(turns_of(spark, sf_dir), max_length)


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def vocabulary_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spread(turns_of(spark, sf_dir), "conv_id", "turn")
    return prep.fit_on_train_turns(turns, VOCABULARY)


def codec_of(spark: SparkSession, sf_dir: str) -> Codec:
    return Codec(vocabulary_of(spark, sf_dir))


def role_codec(spark: SparkSession, sf_dir: str) -> Codec:
    turns = spread(turns_of(spark, sf_dir), "conv_id", "turn")
    path = fresh_path(spark, "vocabulary")
    save_vocabulary(prep.fit_on_train_turns(turns, VOCABULARY, ROLE_MARKS), path)
    return Codec(load_vocabulary(spark, path), ROLE_MARKS.marks[1])


def prepared_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.prepare(records_of(spark, sf_dir), codec_of(spark, sf_dir), MAX_LENGTH)


def counts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.piece_counts(records_of(spark, sf_dir), MAX_LENGTH, TURN_END)


def spelled(column: str | Column) -> Column:
    """An int array as one string."""
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(column.cast("array<string>"), " ")


def spell_arrays(df: DataFrame, *arrays: str) -> DataFrame:
    return df.withColumns({name: spelled(name) for name in arrays})


def big(column: Column) -> Column:
    return column.cast("bigint")


# Scans and sinks


def write_lines(records: DataFrame, lines: Column, spark: SparkSession) -> dict[str, str]:
    """A folder of text files per split, with the lines of each record in ``row_id`` order."""
    root = fresh_path(spark, "chat-lines")
    ordered = records.repartitionByRange("row_id").sortWithinPartitions("split", "row_id")
    ordered.select("split", lines.alias("value")).write.partitionBy("split").text(root)
    return {split: f"{root}/split={split}" for split in (TRAIN, VALIDATION)}


def as_json(**options: str) -> Column:
    return F.to_json(F.struct("row_id", "messages"), options)


def mixed_lines() -> Column:
    """Records as compact lines, as pretty-printed objects, and behind broken text."""
    compact, pretty = as_json(), as_json(pretty="true")
    return (
        F.when(F.col("row_id") % 4 == 0, compact)
        .when(F.col("row_id") % 4 == 1, pretty)
        .when(F.col("row_id") % 4 == 2, F.concat(F.lit("{broken\n\n"), compact, F.lit("\n  ")))
        .otherwise(F.concat(pretty, F.lit("\n")))
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Position in its split, size and text of every record of a scan."""
    row_id = F.col("row_id")
    indexed = global_index(
        rows.select("row_id", "split"), [row_id], long_levels(row_id), within=["split"]
    )
    messages = F.col("messages")
    return rows.join(indexed, ["row_id", "split"]).select(
        "split",
        big(F.col("idx")).alias("idx"),
        big(F.size(messages)).alias("n_messages"),
        render_chat(messages).alias("text"),
    )


@query
def jsonl_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = write_lines(chat_records(turns_of(spark, sf_dir)), as_json(), spark)
    scans = [
        files.add_row_ids(
            files.read_chat_jsonl(spark, folders[split]), files.scan_files(spark, folders[split])
        )
        for split in (TRAIN, VALIDATION)
    ]
    return numbered(splits.assemble_splits(*scans))


@query
def jsonl_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in all the forms of ``mixed_lines``."""
    records = chat_records(turns_of(spark, sf_dir)).withColumn("split", F.lit(TRAIN))
    scan = tolerant.read_tolerant(spark, write_lines(records, mixed_lines(), spark)[TRAIN])
    return numbered(
        files.add_row_ids(scan.messages(), scan.files).withColumn("split", F.lit(TRAIN))
    )


@query
def jsonl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tolerant reader leaves out: a stray closing line under every record."""
    records = chat_records(turns_of(spark, sf_dir))
    lines = F.concat(
        as_json(),
        F.lit("\n]"), F.col("row_id").cast("string"), F.lit("\n\n"), F.col("row_id").cast("string"),
    )
    folder = fresh_path(spark, "chat-broken")
    records.select(lines.alias("value")).write.text(folder)
    return tolerant.read_tolerant(spark, folder).rejects().select("text", "reason")


@query
def split_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.cap_records(conversation_sizes(turns_of(spark, sf_dir)), SAMPLE)


@query
def split_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = conversation_sizes(turns_of(spark, sf_dir))
    train, validation = (
        sizes.filter(F.col("split") == split).drop("split") for split in (TRAIN, VALIDATION)
    )
    return splits.assemble_splits(train, validation)


def prompts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("prompt_id"),
        chat_prompt(SYSTEM_PROMPT, F.col("text")).alias("messages"),
    )


def write_prompt_files(filed: DataFrame, spark: SparkSession) -> str:
    """One file per ``(prompt_id, messages)`` row, each in the folder of its prompt."""
    root = fresh_path(spark, "prompt-files")
    value = F.to_json("messages", {"pretty": "true"}).alias("value")
    filed.select("prompt_id", value).write.partitionBy("prompt_id").text(root)
    return root


@query
def prompt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_prompt_files(prompts_of(spark, sf_dir), spark)
    messages = F.col("messages")
    return files.read_prompt_files(spark, root).select(
        big(F.col("prompt_id")).alias("prompt_id"),
        big(F.size(messages)).alias("n_messages"),
        messages[0]["role"].alias("first_role"),
        messages[1]["content"].alias("user_text"),
    )


@query
def file_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of JSONL per split, and one that was never written."""
    sizes = conversation_sizes(turns_of(spark, sf_dir))
    root = fresh_path(spark, "line-counts")
    value = F.to_json(F.struct("row_id", "n_turns")).alias("value")
    for split in (TRAIN, VALIDATION):
        sizes.filter(F.col("split") == split).select(value).write.text(f"{root}/{split}")
    return files.count_lines(spark, root, [TRAIN, VALIDATION, "missing"])


@query
def tokenized_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "prepared")
    prep.write_prepared(prepared_of(spark, sf_dir), path)
    written = spark.read.parquet(path)
    return written.select("row_id", "split", *[F.md5(spelled(c)).alias(f"{c}_md5") for c in TOKENS])


@query
def vocab_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "vocabulary")
    save_vocabulary(vocabulary_of(spark, sf_dir), path)
    return load_vocabulary(spark, path)


# Rows and prompts


@query
def sample_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = reports.first_row(turn_rows(turns_of(spark, sf_dir)))
    gathered = gather_messages(turns, "row_id")
    return gathered.select("row_id", render_chat(F.col("messages")).alias("text"))


@query
def id_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spell_arrays(reports.id_prefix(prepared_of(spark, sf_dir)), "input_ids", "mask")


@query
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = F.col("messages")
    return prompts_of(spark, sf_dir).select(
        "prompt_id",
        messages[0]["role"].alias("first_role"),
        messages[0]["content"].alias("system_text"),
        messages[1]["role"].alias("second_role"),
        messages[1]["content"].alias("user_text"),
    )


@query
def prompt_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of several lines also have a file, with another user text."""
    from_file = F.concat(F.lit("From a file: "), F.col("text"))
    filed = table(spark, sf_dir, "benchmark").filter(F.contains("text", F.lit("\n")))
    root = write_prompt_files(
        filed.select(
            F.col("item_id").alias("prompt_id"),
            chat_prompt(SYSTEM_PROMPT, from_file).alias("messages"),
        ),
        spark,
    )
    chosen = files.choose_prompts(prompts_of(spark, sf_dir), files.read_prompt_files(spark, root))
    return chosen.select("prompt_id", F.col("messages")[1]["content"].alias("user_text"))


# Rendering


@query
def render_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.render_texts(chat_records(turns_of(spark, sf_dir)))


@query
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.render_prompts(chat_records(turns_of(spark, sf_dir)))


@query
def render_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts_of(spark, sf_dir).select(
        "prompt_id", render_chat(F.col("messages")).alias("text")
    )


# Vocabulary, encoding, decoding


@query
def vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary_of(spark, sf_dir)


@query
def encode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with the vocabulary of the chats: most of their words are unknown to it."""
    ids = encode(F.col("text"), codec_of(spark, sf_dir))
    return documents_of(spark, sf_dir).select("doc_id", spelled(ids).alias("input_ids"))


@query
def encode_ids_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ids from a vocabulary that stays a table."""
    docs = documents_of(spark, sf_dir)
    encoded = encode_by_join(docs, F.col("text"), vocabulary_of(spark, sf_dir))
    return encoded.select("doc_id", spelled("input_ids").alias("input_ids"))


@query
def truncate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = documents_of(spark, sf_dir).select(
        "doc_id", split_pieces(F.col("text")).alias("pieces")
    )
    return pieces.select(
        "doc_id",
        big(F.size("pieces")).alias("n_pieces"),
        *[
            big(F.size(truncate(F.col("pieces"), length))).alias(f"kept_{length}")
            for length in (MAX_LENGTH, SHORT_LENGTH)
        ],
    )


@query
def decode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = codec_of(spark, sf_dir)
    prompts = prompts_of(spark, sf_dir).select(
        "prompt_id", encode(render_chat(F.col("messages")), codec).alias("input_ids")
    )
    return prompts.select("prompt_id", decode(F.col("input_ids"), codec).alias("text"))


@query
def infer_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk inference input: the rendered prompt, without a reply header, as ids and mask."""
    codec = codec_of(spark, sf_dir)
    encoded = prompts_of(spark, sf_dir).select(
        "prompt_id", encode(render_chat(F.col("messages")), codec).alias("input_ids")
    )
    return encoded.select(
        "prompt_id",
        spelled("input_ids").alias("input_ids"),
        spelled(masks.attention_mask(F.col("input_ids"))).alias("attention_mask"),
    )


# Labels


def encoded_of(
    spark: SparkSession, sf_dir: str, codec: Codec, max_length: int, template=CHATML
) -> DataFrame:
    """``(row_id, split, input_ids, prompt_length)``"""
    rows = prep.split_records(records_of(spark, sf_dir, max_length), max_length, template)
    return rows.select(
        "row_id", "split", lookup_ids(F.col("pieces"), codec).alias("input_ids"), "prompt_length"
    )


@query
def chat_prepare_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template whose marks name the role, with a vocabulary that has them as its special pieces."""
    rows = prep.prepare_by_marker(
        records_of(spark, sf_dir), role_codec(spark, sf_dir), ROLE_MARKER, MAX_LENGTH, ROLE_MARKS
    )
    return spell_arrays(rows, *TOKENS)


@query
def decode_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts back from ids, without the marks; the vocabulary is one that was saved and loaded."""
    codec = role_codec(spark, sf_dir)
    texts = prep.render_texts(records_of(spark, sf_dir), ROLE_MARKS)
    ids = encode(F.col("text"), codec, MAX_LENGTH)
    return texts.select("row_id", decode(ids, codec).alias("text"))


@query
def prompt_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prep.split_records(records_of(spark, sf_dir), MAX_LENGTH)
    length = masks.capped_prompt_length(F.col("prompt_length"), F.col("pieces"))
    return rows.select("row_id", big(length).alias("prompt_len"))


@query
def labels_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encoded_of(spark, sf_dir, codec_of(spark, sf_dir), MAX_LENGTH)
    labels = masks.labels_by_length(F.col("input_ids"), F.col("prompt_length"), None)
    return encoded.select("row_id", spelled(labels).alias("labels"))


@query
def labels_eos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template without the final newline ends rows in the eos piece."""
    codec = codec_of(spark, sf_dir)
    encoded = encoded_of(spark, sf_dir, codec, MAX_LENGTH, CHATML_TIGHT)
    labels = masks.labels_by_length(F.col("input_ids"), F.col("prompt_length"), codec.eos_id)
    return encoded.select("row_id", spelled(labels).alias("labels"))


@query
def labels_by_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = codec_of(spark, sf_dir)
    encoded = encoded_of(spark, sf_dir, codec, MAX_LENGTH)
    marker = prep.marker_ids(encoded, MARKER, codec)
    labels = masks.labels_by_marker(F.col("input_ids"), marker, codec.eos_id)
    return encoded.select("row_id", spelled(labels).alias("labels"))


# Reports


@query
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.split_counts(conversation_sizes(turns_of(spark, sf_dir)))


@query
def active_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_counts(prepared_of(spark, sf_dir))


@query
def split_label_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.split_label_stats(prepared_of(spark, sf_dir))


@query
def steps_per_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = conversation_sizes(turns_of(spark, sf_dir))
    return reports.steps_per_epoch(sizes, BATCH, ACCUMULATION, WORLD)


# Batch plans


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_sizes(turns_of(spark, sf_dir)).filter(F.col("split") == TRAIN)


def batch_plan(rows: DataFrame) -> DataFrame:
    """Train rows to ``(…, epoch, idx, batch_id, step)`` in seeded order."""
    train = rows.filter(F.col("split") == TRAIN)
    n_train = train.count()
    ordered = batches.seeded_order(batches.expand_epochs(train, EPOCHS), SEED)
    return batches.assign_steps(
        batches.assign_batches(ordered, BATCH), n_train, BATCH, ACCUMULATION, WORLD
    )


@query
def epoch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = counts_of(spark, sf_dir).filter(F.col("split") == TRAIN)
    expanded = batches.expand_epochs(train.select("row_id", "n_tokens"), EPOCHS)
    return expanded.select("row_id", "n_tokens", big(F.col("epoch")).alias("epoch"))


@query
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = batch_plan(train_rows(spark, sf_dir))
    return plan.select(
        big(F.col("epoch")).alias("epoch"), big(F.col("idx")).alias("idx"), "row_id", "batch_id"
    )


@query
def eval_batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_sizes(turns_of(spark, sf_dir)).filter(F.col("split") == VALIDATION)
    ordered = batches.stored_order(batches.expand_epochs(rows, 1))
    return batches.assign_batches(ordered, BATCH).select(
        "row_id", big(F.col("idx")).alias("idx"), "batch_id"
    )


@query
def step_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = batch_plan(train_rows(spark, sf_dir))
    return plan.select("row_id", big(F.col("epoch")).alias("epoch"), "step")


@query
def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return padded(spark, sf_dir, "right")


@query
def pad_batches_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return padded(spark, sf_dir, "left")


def planned(spark: SparkSession, sf_dir: str, codec: Codec) -> tuple[DataFrame, DataFrame]:
    """``(plan, tokens)``. The prepared rows are written once; the plan reads their sizes only."""
    prepared = prep.prepare(records_of(spark, sf_dir), codec, MAX_LENGTH)
    tokens = stage(
        prepared.filter(F.col("split") == TRAIN).withColumn(
            "n_tokens", big(F.size("input_ids"))
        ),
        "prepared",
    )
    return batch_plan(tokens.select("row_id", "split", "n_tokens")), tokens


def padded(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    codec = codec_of(spark, sf_dir)
    special = codec.resolve("eos", side)
    rows = batches.pad_batches(
        *planned(spark, sf_dir, codec), special.pad_id, special.padding_side
    )
    return spell_arrays(rows, *TOKENS).withColumns(
        {"epoch": big(F.col("epoch")), "width": big(F.col("width"))}
    )


@query
def batch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches as a reader of the written files meets them: how many files a batch is in, its rows
    and arrays in the order of the file."""
    codec = codec_of(spark, sf_dir)
    path = fresh_path(spark, "batches")
    batches.write_batches(*planned(spark, sf_dir, codec), path, codec.resolve().pad_id)
    read = spark.read.parquet(path).select(
        "epoch",
        "batch_id",
        F.struct(
            F.monotonically_increasing_id().alias("place"),
            "row_id",
            *[F.md5(spelled(c)).alias(c) for c in TOKENS],
        ).alias("row"),
        F.col("_metadata.file_path").alias("file"),
        "width",
    )
    rows = read.groupBy("epoch", "batch_id").agg(
        F.count_distinct("file").alias("n_files"),
        big(F.max("width")).alias("width"),
        F.array_sort(F.collect_list("row")).alias("rows"),
    )
    return rows.select(
        big(F.col("epoch")).alias("epoch"),
        "batch_id",
        "n_files",
        "width",
        *[spelled(F.col("rows")[c]).alias(c) for c in ("row_id", *TOKENS)],
    )


@query
def step_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = batch_plan(stage(counts_of(spark, sf_dir), "piece-counts"))
    manifest = batches.step_manifest(plan, LOGGING_STEPS, EVAL_STEPS, SAVE_STEPS)
    return manifest.withColumn("epoch", big(F.col("epoch")))


@query
def resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = batch_plan(train_rows(spark, sf_dir))
    rest = batches.remaining_rows(plan, CHECKPOINT)
    return rest.select("row_id", big(F.col("epoch")).alias("epoch"), "step")


# Whole preparations


@query
def chat_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spell_arrays(prepared_of(spark, sf_dir), *TOKENS)


@query
def chat_prepare_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prep.prepare_by_marker(
        records_of(spark, sf_dir), codec_of(spark, sf_dir), MARKER, MAX_LENGTH
    )
    return spell_arrays(rows, "input_ids", "attention_mask", "labels")


def broken_lines() -> Column:
    """Two objects without usable messages beside some records, in text that is partly broken."""
    row_id = F.col("row_id").cast("string")
    no_messages = F.concat(F.lit('{"row_id":'), row_id, F.lit("}\n"))
    no_content = F.concat(
        F.lit('{"row_id":'), row_id, F.lit(',"messages":[{"role":"user"}]}\n')
    )
    front = F.when(F.col("row_id") % 7 == 3, no_messages).when(F.col("row_id") % 7 == 5, no_content)
    return F.concat(F.coalesce(front, F.lit("")), mixed_lines())


def positioned(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of files by their position in the split, arrays spelled."""
    row_id = F.col("row_id")
    indexed = global_index(
        rows.select("row_id", "split"), [row_id], long_levels(row_id), within=["split"]
    ).withColumn("idx", big(F.col("idx")))
    return spell_arrays(rows.join(indexed, ["row_id", "split"]).drop("row_id"), *columns)


def prepared_files(spark: SparkSession, sf_dir: str, lines: Column, **options) -> DataFrame:
    folders = write_lines(chat_records(turns_of(spark, sf_dir)), lines, spark)
    rows, _ = prep.prepare_files(
        spark, folders[TRAIN], folders[VALIDATION], max_pieces=VOCABULARY, max_length=MAX_LENGTH,
        **options,
    )
    return positioned(rows, *TOKENS)


@query
def chat_prepare_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From strict JSONL files of both splits to training rows, the vocabulary fitted on the way."""
    return prepared_files(spark, sf_dir, as_json())


@query
def chat_prepare_files_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from messy files, labels by marker."""
    return prepared_files(spark, sf_dir, broken_lines(), tolerant=True, marker=MARKER)


@query
def chat_prepare_files_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of each split; files behind them stay closed."""
    return prepared_files(
        spark, sf_dir, as_json(), cap=SAMPLE, codec=codec_of(spark, sf_dir)
    )


@query
def chat_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tolerant load of both splits sets aside."""
    folders = write_lines(chat_records(turns_of(spark, sf_dir)), broken_lines(), spark)
    loaded = read_chat_files(spark, folders[TRAIN], folders[VALIDATION], tolerant=True)
    return loaded.rejects.select("split", "text", "reason")


@query
def prepare_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.smoke_report(
        records_of(spark, sf_dir), codec_of(spark, sf_dir), MAX_LENGTH, SAMPLE
    )
