"""Line-first cleaning: judge every line, drop those that fail, then judge what is left.

A line with a word fails when it does not end like a sentence or is strewn with symbols
(punctuation), when it is a row of links (navigation), or when it holds a stock phrase
(boilerplate). Lines without a word stay as
spacing. A document is rejected when its words are too few, when repeated word triples cover too
many of them, or when its lines lost too much of their text.

A null text has no words, keeps a null clean text and is rejected, as an empty one is. Rows are
judged one by one, so ties, repeated rows, nulls in other columns and an empty table need no care. A
text of any length is taken whole, as an array of its lines. Extra
columns stay, unless they are named like a result column, which then replaces them. Every
expression is a built-in function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnspool.llm.plans import computed_once

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_LEFT_PERCENT = 50
RUN = 3

# What a line is judged by. The patterns mean the same in Java and RE2.
# Sentence terminals of the scripts that have them, with colons and semicolons; then scripts that end
# sentences without a sign (Thai, Lao, Tibetan, Burmese; Khmer).
TERMINALS = ".!?:;…։؛؞؟۔܀܁܂߹।॥၊။።፤፥፦፧፨᙮᠃᠉᥄᥅‼‽⁇⁈⁉⸮。︒﹒﹔﹕﹖﹗！．：；？｡"
UNSIGNED = (("\u0e00", "\u109f"), ("\u1780", "\u17ff"))
CLOSING = "\"'”’»)]」』）】》〉］｝＂＇"
BLANK = " \t\r"
SENTENCE_END = (
    f"[{TERMINALS}{''.join(f'{a}-{b}' for a, b in UNSIGNED)}]"
    rf"[{CLOSING.replace(']', chr(92) + ']')}]*[{BLANK}]*\z"
)
NOISE = r"(?:[#*$%&!]{2,}[^#*$%&!]+){3}"
NAVIGATION = (
    r"\|[^|]*\||»[^»]*»|•[^•]*•"
    r"|(?i:^[ \t]*(home|menu|search|log ?in|sign ?(in|up)|next( page)?|previous( page)?"
    r"|read more|skip to (main )?content|back to top)\b[^.!?]{0,20}\z)"
)
BOILERPLATE = (
    r"(?i:all rights reserved|privacy policy|cookie policy|uses cookies|terms of (use|service)"
    r"|lorem ipsum|javascript|powered by|subscribe to our|click here)"
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[ \t-\r]+"), "")


def has_word(text: Column) -> Column:
    return text.rlike(r"[^ \t-\r]")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def ends_sentence(line: Column) -> Column:
    """``SENTENCE_END``, by the last character that is no closing sign."""
    bare = F.rtrim(F.rtrim(line, F.lit(BLANK)), F.lit(CLOSING))
    last = F.substring(bare, -1, 1)
    ends = (last != "") & F.contains(F.lit(TERMINALS), last)
    for low, high in UNSIGNED:
        ends = ends | last.between(low, high)
    return ends


def line_passes(line: Column) -> Column:
    sound = ends_sentence(line)
    for bad in (NOISE, NAVIGATION, BOILERPLATE):
        sound = sound & ~line.rlike(bad)
    return ~has_word(line) | sound


def repeated_cover(words: str) -> tuple[Column, Column]:
    """``(runs, cover)`` for an array column of words, to be added one after the other.

    runs: every three consecutive words as (hash, place), sorted; cover, over a column of that
    name: how many words lie in runs that are found more than once.
    """
    w = F.col(words)
    starts = F.slice(w, 1, F.greatest(F.size(w) - (RUN - 1), F.lit(0)))
    runs = F.sort_array(
        F.transform(
            starts,
            lambda x, i: F.struct(
                F.xxhash64(x, *[F.get(w, i + k) for k in range(1, RUN)]).alias("h"), i.alias("i")
            ),
        )
    )
    sorted_runs = F.col("_runs")

    def same(run: Column, k: Column) -> Column:
        return F.coalesce(F.get(sorted_runs, k)["h"] == run["h"], F.lit(False))

    again = F.filter(sorted_runs, lambda run, k: same(run, k - 1) | same(run, k + 1))
    places = F.sort_array(F.transform(again, lambda run: run["i"]))
    cover = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, p: F.struct(
            (acc["n"] + p + RUN - F.greatest(p, acc["upto"])).alias("n"), (p + RUN).alias("upto")
        ),
        lambda acc: acc["n"].cast("bigint"),
    )
    return runs, cover


RESULTS = (
    "clean_text",
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_dropped_lines",
    "base_failed",
    "kept",
)


def line_first_cleaning(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the columns named in RESULTS."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in RESULTS])
    runs, cover = repeated_cover("_words")
    judged = (
        df.select(row.alias("_row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
        .withColumn("_words", words_of(F.col("_text")))
        .withColumn("_lines", F.split("_text", "\n"))
        .withColumn("_runs", runs)
        .withColumn("_passed", F.filter("_lines", line_passes))
        .withColumn("_worded", F.filter("_lines", has_word))
        .select(
            "_row",
            F.array_join("_passed", "\n").alias("_clean"),
            F.size("_words").cast("bigint").alias("n_words"),
            F.length(without(F.col("_text"), SPACE)).cast("bigint").alias("word_chars"),
            (F.length("_text") - F.length(without(F.col("_text"), SYMBOLS)))
            .cast("bigint")
            .alias("n_symbols"),
            (F.size("_worded") - F.size(F.array_distinct("_worded")))
            .cast("bigint")
            .alias("n_dup_lines"),
            cover.alias("n_repeat_words"),
            F.size("_worded").cast("bigint").alias("n_lines"),
            (F.size("_lines") - F.size("_passed")).cast("bigint").alias("n_dropped_lines"),
        )
    )
    left = F.length(without(F.col("_clean"), SPACE))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    text = F.col("_row")[text_col]
    result = judged.withColumn("base_failed", failed).select(
        "_row.*",
        F.when(text.isNotNull(), F.col("_clean")).alias("clean_text"),
        *RESULTS[1:-1],
        (~failed & (100 * left >= MIN_LEFT_PERCENT * F.col("word_chars"))).alias("kept"),
    )
    return computed_once(result)
