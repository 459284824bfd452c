"""Operator 1: language identification.

Multinomial naive Bayes over hashed character n-grams (1 to 3 characters of
the lower-cased text, white space runs as one blank). Training counts n-grams
for each language where the texts lie and adds the counts up: a matrix of
``buckets`` rows and one column for each language, whatever the corpus. Its
log-probabilities are broadcast (``MAX_MODEL_BYTES`` at most: with very many
languages the number of buckets shrinks). Scoring handles a batch of texts as
one sparse matrix, row pointers and bucket indexes, in numpy.

The score is the predicted language's posterior with the log-likelihoods
divided by the square root of the number of n-grams (n-grams overlap and
repeat, so their full sum is overconfident).

Defined cases: null text and text without a letter are ``und`` with score 0;
rows without a language do not train; a table without training rows predicts
``und`` everywhere; ties between languages go to the first by name; repeated
rows are separate rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsense.llm.common import small_batches, text_batches, texts_of

ORDERS = (1, 2, 3)
BUCKETS = 2**16
MAX_MODEL_BYTES = 64 * 2**20
MAX_LANGUAGES = 1024
SMOOTHING = 0.5
#: Texts scored lower than this are rejected by :func:`identified`.
MIN_SCORE = 0.5
FOLDS, HELD_OUT = 5, 0

#: Characters scored at a time: an n-gram takes some 50 bytes for each language.
SLICE = 100_000

_BLANK = re.compile(r"\s+")


def has_letter(text: str) -> bool:
    """Whether some character is a letter (number signs are none)."""
    return any(map(str.isalpha, text))


def hashed_ngrams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, pointers): the buckets of all n-grams of text ``i`` are
    ``indexes[pointers[i]:pointers[i + 1]]``. Every text is framed by blanks."""
    framed = [" " + _BLANK.sub(" ", t.lower()).strip() + " " for t in texts]
    chars = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) for t in framed], dtype=np.int64)
    ends = np.cumsum(sizes)
    bits = np.uint32(32 - int(buckets).bit_length() + 1)
    left = np.repeat(ends, sizes) - np.arange(len(chars))  # characters from here to the text's end
    columns = []
    mixed = np.zeros(len(chars), dtype=np.uint32)
    for n in range(1, max(ORDERS) + 1):
        step = np.zeros(len(chars), dtype=np.uint32)
        step[: len(chars) - n + 1] = chars[n - 1 :]
        mixed = (mixed ^ step) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        if n in ORDERS:
            slot = ((mixed * np.uint32(0x85EBCA6B)) >> bits).astype(np.int32)
            columns.append(np.where(left >= n, slot, -1))
    grid = np.stack(columns, axis=1)
    keep = grid >= 0
    counts = np.add.reduceat(keep.sum(axis=1), np.concatenate([[0], ends[:-1]])) if len(sizes) else np.zeros(0, dtype=np.int64)
    return grid[keep], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def held_out() -> Column:
    """Rows that are not learnt from; rows without a doc_id are."""
    return F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities[buckets, languages]) from the rows of
    ``docs`` (text, lang) that have both."""
    small_batches(docs)
    labelled = docs.filter("text is not null and lang is not null").select("text", "lang")
    spark = docs.sparkSession
    langs = [r["lang"] for r in labelled.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is lang a language?")
    if not langs:
        return [], np.zeros((0, 0), dtype=np.float32)
    buckets = BUCKETS
    while buckets * len(langs) * 4 > MAX_MODEL_BYTES:
        buckets //= 2
    place = {lang: i for i, lang in enumerate(langs)}

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(langs), buckets), dtype=np.int64)
        for pdf in batches:
            for part in text_batches(pdf, chars=SLICE):
                slots, ptr = hashed_ngrams(part["text"].tolist(), buckets)
                row = np.repeat(part["lang"].map(place).to_numpy(np.int64), np.diff(ptr))
                total += np.bincount(row * buckets + slots, minlength=total.size).reshape(total.shape)
        lang, slot = np.nonzero(total)
        if len(lang):
            yield pd.DataFrame({"lang": lang.astype(np.int32), "slot": slot.astype(np.int32), "n": total[lang, slot]})

    counts = np.zeros((buckets, len(langs)), dtype=np.float64)
    # as many rows as the matrix has cells, whatever the corpus
    for r in labelled.mapInPandas(counted, "lang int, slot int, n long").groupBy("slot", "lang").agg(F.sum("n").alias("n")).toPandas().itertuples():
        counts[r.slot, r.lang] = r.n
    smoothed = counts + SMOOTHING
    return langs, np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32)


def score_batch(texts: list[str], logp: np.ndarray) -> np.ndarray:
    """Posterior[text, language] of a batch (uniform prior)."""
    slots, ptr = hashed_ngrams(texts, logp.shape[0])
    sums = np.add.reduceat(logp[slots].astype(np.float64), ptr[:-1], axis=0)
    scaled = sums / np.sqrt(np.diff(ptr))[:, None]
    e = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """Every row of ``docs`` with lang_pred and score, from its text alone."""
    spark: SparkSession = docs.sparkSession
    model = spark.sparkContext.broadcast(logp)

    @F.pandas_udf("struct<lang_pred string, score double>")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            pred = np.full(len(series), "und", dtype=object)
            score = np.zeros(len(series))
            pdf = pd.DataFrame({"text": texts_of(series), "at": np.arange(len(series))})
            for part in text_batches(pdf, chars=SLICE):
                part = part[[has_letter(t) for t in part["text"]]]
                if len(part) and langs:
                    p = score_batch(part["text"].tolist(), model.value)
                    best = p.argmax(axis=1)
                    pred[part["at"]] = [langs[b] for b in best]
                    score[part["at"]] = p[np.arange(len(best)), best]
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return docs.withColumn("_l", identify("text")).select("*", "_l.lang_pred", "_l.score").drop("_l")


def identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known: those with a letter and a
    score of at least ``min_score``. Learns from the rows that have a lang."""
    langs, logp = train(docs.filter(~held_out()))
    keep = predict(docs.select(F.struct("*").alias("_row"), "text"), langs, logp)  # whatever its columns are called
    return keep.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select("_row.*")


def identify_documents(docs: DataFrame) -> DataFrame:
    """The digest of language identification over a documents table."""
    langs, logp = train(docs.filter(~held_out()))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), langs, logp).drop("text")
