"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of documents, with
``n_chars`` counted anew where the text has changed; the last returns a row for each packed piece.
``run`` writes each stage's result as Parquet in the shared folder and reads it for the next, so a
lost executor costs no earlier stage.

Nulls, empty and very long texts, ties and repeated rows are treated as each operator says; an empty
table stays empty. Columns added to the documents keep their values up to the last stage, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnspool.llm import decontamination, line_dedup, minhash, packing, quality
from turnspool.llm.queries import SEQUENCE, vocabulary_path
from turnspool.staging import stage


def _lean(docs: DataFrame) -> DataFrame:
    """Id and text for an operator, and the other columns beside them, out of reach of its names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias(""), *others).alias("row"))


def _rows(found: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` again, as they were but for a new text and its length."""
    new = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if text is not None:
        new |= {"text": text, "n_chars": F.length(text).cast("bigint")}
    row = F.col("row")
    return found.select(*[new.get(c, row.getField(c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that failed."""
    cleaned = quality.line_first_cleaning(_lean(docs)).filter("kept")
    return _rows(cleaned, docs, F.col("clean_text"))


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go; a document that had nothing else goes with them."""
    cleaned = line_dedup.dedup_lines(_lean(docs))
    left = cleaned.filter((F.col("n_deleted_lines") == 0) | quality.has_word(F.col("clean_text")))
    return _rows(left, docs, F.col("clean_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, one row of each document."""
    keepers = (
        minhash.near_duplicates(docs.select("doc_id", "text"))
        .filter("keeper")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    )
    lean = _lean(docs)
    same = F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_hash")
    kept = lean.join(keepers, lean["doc_id"].eqNullSafe(F.col("_id")) & same)
    nth = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.lit(0)))
    # A text without words is a group of its own, however often its row is repeated.
    repeated = quality.has_word(F.coalesce("text", F.lit(""))) & (F.col("_nth") > 1)
    return _rows(kept.withColumn("_nth", nth).filter(~repeated), docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_benchmark(_lean(docs), benchmark)
    return _rows(found.filter(decontamination.n_hit() == 0), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 tokens with their places in sequences."""
    lean = docs.select("doc_id", "text")
    return packing.pack_documents(lean, vocabulary_path(), SEQUENCE)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_runs", line_runs),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("packed", packed),
]

# Components of near-duplicates and packing have no SQL form; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return docs
