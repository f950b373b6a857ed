"""The registered queries: each operator on its whole table, in the columns of its contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnspool.llm import (
    decontamination,
    hard_negatives,
    language,
    line_dedup,
    minhash,
    packing,
    periodic,
    quality,
    secrets,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)
from turnspool.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 40
SEQUENCE = 1024
CONTEXT = 4096


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_path() -> str:
    return tokenizer_path("byte_bpe_50k.tiktoken")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    lean = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return sharding.shuffle_to_shards(lean, SHARDS).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )


def op2_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    n_hit = decontamination.n_hit()
    return decontamination.find_benchmark(docs, benchmark).select(
        "doc_id",
        "hits.n_words",
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_b_bit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", bucket_of(F.col("doc_id"), 4) == 2)
    model = language.fit_trigrams(docs.filter(~F.col("held_out")))
    named = language.identify_languages(docs.select("doc_id", "held_out", "text"), *model)
    return named.drop("text")


def op5_line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = quality.line_first_cleaning(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.drop("text", "clean_text")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["number"] < secrets.BASE)

    def count(number: int):
        return F.size(F.filter("spans", lambda s: s["number"] == number)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(secrets.RULES[: secrets.BASE])],
        F.sha2(secrets.written(base, secrets.RULES), 256).alias("base_sha256"),
        secrets.written(F.col("spans"), secrets.RULES).alias("spans"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack_documents(docs, vocabulary_path(), SEQUENCE)


def op8_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    runs = F.transform("deleted", lambda r: F.concat_ws(":", r["start"], r["end"]))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_deleted_lines",
        F.array_join(runs, ",").alias("deleted"),
        F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("clean_sha256"),
    )


def op10_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    taught = bucket_of(F.col("doc_id"), 5) != 0
    model = toxicity.fit_toxicity(docs.filter(taught), labels.filter(taught))
    return toxicity.score_toxicity(
        docs.select("doc_id", (~taught).alias("held_out"), "text"), model
    ).drop("text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine_hard_negatives(
        vectors.select("vec_id", moved.alias("label"), "embedding"), vec_id % 100 == 0
    )


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT).alias("over_limit")
    )


def repeated_words(doc_id: Column, text: Column) -> Column:
    """The text of a document, where every tenth by crc32 repeats some words up to its end."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
        period = F.slice(words, a + 1, F.least(p, n - a))
        times = F.ceil((n - a) / p).cast("int")
        behind = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), behind), " ")

    found = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # The array of one list binds the words, which are else searched for at every use.
    return F.when(h % 10 == 0, F.transform(F.array(found), repeat)[0]).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    text = repeated_words(F.col("doc_id"), F.col("text")).alias("text")
    found = periodic.find_periodic_runs(docs.select("doc_id", text))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    longest = F.array_min(
        F.transform(
            "runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"], r["period"])
        )
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"),
        (-longest["n"]).alias("length"),
        longest["period"].alias("period"),
        F.floor(-longest["n"] * 1000 / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_wu_manber": op2_wu_manber,
    "op3_b_bit_minhash": op3_b_bit_minhash,
    "op4_language_mixture": op4_language_mixture,
    "op5_line_first_cleaning": op5_line_first_cleaning,
    "op6_secret_scan": op6_secret_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_seed_and_extend": op8_seed_and_extend,
    "op9_line_runs": op9_line_runs,
    "op10_toxicity_nnpu": op10_toxicity_nnpu,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_counts": op12_token_counts,
    "op13_periodic_runs": op13_periodic_runs,
}
