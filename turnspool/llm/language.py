"""Language identification as inference of a multilingual mixture.

Character trigrams of words are counted per language over all labelled rows. The likelihood of a
word under a language is the product of its trigram probabilities. A text is a mixture: each word
comes from one language, and expectation-maximisation finds the proportions. Which languages take
part is chosen by penalised likelihood: every language must gain more than ``0.5 log(words)``. The
prediction is the language with the largest proportion, which is also its score.

A null text and one without a letter are ``und`` with score 0; so is every text when no row is
labelled. Rows with a null language teach nothing and are predicted like others. Repeated rows and
extra columns change nothing; columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnspool.llm.words import LETTERS, WordReader, slices

BINS = 1 << 16
SMOOTHING = 0.1
ITERATIONS = 6
UNKNOWN = "und"
# Languages counted in a task before sums are handed on, and allowed in a model (256 KiB each).
TASK_LANGUAGES = 64
MAX_LANGUAGES = 1000

COUNTS = "lang string, bin int, n bigint"


def _folded() -> np.ndarray:
    table = np.full(256, 0x20, np.uint32)
    table[LETTERS] = np.arange(256, dtype=np.uint32)[LETTERS]
    table[65:91] = table[97:123]
    return table


def trigram_bins(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(place, bin)`` of the trigram around every letter byte; a word is padded by a space."""
    folded = _folded()
    codes = folded[data]
    before, after = np.empty_like(codes), np.empty_like(codes)
    before[1:], after[:-1] = codes[:-1], codes[1:]
    filled = bounds[1:] > bounds[:-1]
    before[bounds[:-1][filled]] = 0x20
    after[bounds[1:][filled] - 1] = 0x20
    place = np.flatnonzero(LETTERS[data])
    gram = before[place] | (codes[place] << np.uint32(8)) | (after[place] << np.uint32(16))
    return place, (gram * np.uint32(0x9E3779B1)) >> np.uint32(16)


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per language and bin over the rows of a task, from ``(lang, text)``."""
    sums: dict[str, np.ndarray] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            bins = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(bins)), bins.astype(np.int32), counts[bins]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["lang", "bin", "n"]
            )

    for batch in batches:
        langs = batch.column(0)
        for low, high, data, bounds in slices(batch.column(1)):
            place, bins = trigram_bins(data, bounds)
            coded = langs.slice(low, high - low).dictionary_encode()
            row = np.searchsorted(bounds, place, "right") - 1
            lang = coded.indices.to_numpy(zero_copy_only=False)[row]
            for k, name in enumerate(coded.dictionary.to_pylist()):
                own = np.bincount(bins[lang == k], minlength=BINS)
                sums[name] = sums[name] + own if name in sums else own
            if len(sums) > TASK_LANGUAGES:
                yield from told()
                sums.clear()
    yield from told()


def fit_trigrams(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """``(languages, log probabilities by bin and language)`` from all of ``(lang, text)``."""
    counts = (
        labelled.select("lang", "text")
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInArrow(count_trigrams, COUNTS)
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
    )
    languages = sorted(r[0] for r in counts.select("lang").distinct().take(MAX_LANGUAGES + 1))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = counts.toArrow()  # at most BINS rows for each language
    totals = np.full((BINS, max(1, len(languages))), SMOOTHING)
    if languages:
        lang = np.searchsorted(languages, table["lang"].to_numpy(zero_copy_only=False))
        totals[table["bin"].to_numpy(), lang] += table["n"].to_numpy()
    return languages, np.log(totals / totals.sum(axis=0)).astype(np.float32)


def _em(like: np.ndarray, row: np.ndarray, first: np.ndarray, active: np.ndarray):
    """Proportions and log likelihood of every text, over its active languages."""
    words = np.diff(np.append(first, len(row)))
    share = active / active.sum(axis=1, keepdims=True)
    for _ in range(ITERATIONS):
        part = like * share[row]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(part, first, axis=0) / words[:, None]
    fit = np.log(np.maximum((like * share[row]).sum(axis=1), 1e-30))
    return share, np.add.reduceat(fit, first)


def mixtures(logs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions of every text from the log likelihoods of its words; no text is empty."""
    n, languages = len(first), logs.shape[1]
    words = np.diff(np.append(first, len(logs)))
    row = np.repeat(np.arange(n), words)
    top = logs.max(axis=1)
    penalty = 0.5 * np.log(words) + 1.0
    alone = np.add.reduceat(logs - top[:, None], first, axis=0)
    best = alone.argmax(axis=1)
    result = np.zeros((n, languages))
    result[np.arange(n), best] = 1.0
    if languages == 1:
        return result
    like = np.exp(logs - top[:, None])
    active = np.ones((n, languages))
    share, fit = _em(like, row, first, active)
    gain = fit - penalty * languages
    single = alone.max(axis=1) - penalty
    todo = np.arange(n)
    # Texts that are no single language lose one language after the other while that pays.
    for left in range(languages - 1, 0, -1):
        mixed = gain > single[todo]
        result[todo[mixed]] = share[mixed]
        if left == 1:
            break
        weakest = np.where(active > 0, share, np.inf).argmin(axis=1)
        active[np.arange(len(todo)), weakest] = 0
        keep = np.isin(row, todo)
        position = np.searchsorted(todo, row[keep])
        heads = np.flatnonzero(np.diff(position, prepend=-1))
        share, fewer = _em(like[keep], position, heads, active)
        fewer = fewer - penalty[todo] * left
        better = fewer > np.maximum(gain, -np.inf)
        undecided = better | (~mixed)
        result[todo[better & (fewer > single[todo])]] = share[better & (fewer > single[todo])]
        todo, active = todo[undecided], active[undecided]
        share, gain = share[undecided], fewer[undecided]
        if not len(todo):
            break
    return result


def _predictor(model: Callable[[], np.ndarray]):
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        logs = model()
        reader = WordReader(LETTERS, lower=True)
        # Scratch of a slice: some numbers for each word and language.
        limit = max(1 << 16, (8 << 20) // max(4, logs.shape[1]))
        for column in columns:
            lang = np.full(len(column), -1, np.int32)
            score = np.zeros(len(column))
            for low, _, data, bounds in slices(column, limit):
                words = reader.read(data, bounds)
                filled = np.flatnonzero(np.diff(words.first))
                if not len(filled):
                    continue
                place, bins = trigram_bins(data, bounds)
                of_word = np.searchsorted(place, words.start)
                likely = np.add.reduceat(logs[bins], of_word, axis=0)
                share = mixtures(likely, words.first[filled])
                lang[low + filled] = share.argmax(axis=1)
                score[low + filled] = share.max(axis=1)
            yield pa.StructArray.from_arrays(
                [pa.array(lang), pa.array(np.clip(score, 0.0, 1.0))], names=["lang", "score"]
            )

    return F.arrow_udf(predict, "lang int, score double")


def identify_languages(
    df: DataFrame, languages: list[str], logs: np.ndarray, text_col: str = "text"
) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``."""
    sent = df.sparkSession.sparkContext.broadcast(logs)  # at most BINS * MAX_LANGUAGES numbers
    text = F.col(f"`{text_col}`")
    rows = df.select(
        F.struct(
            *[F.col(f"`{c}`") for c in df.columns if c not in ("lang_pred", "score")]
        ).alias("row"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("readable"),
        _predictor(lambda: sent.value)(text).alias("found"),
    )
    known = F.col("readable") & (F.col("found.lang") >= 0) & F.lit(bool(languages))
    names: Column = F.array(*[F.lit(name) for name in languages or [UNKNOWN]])
    return rows.select(
        "row.*",
        F.when(known, F.get(names, F.col("found.lang"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("found.score")).otherwise(0.0).alias("score"),
    )
