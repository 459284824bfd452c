"""Operator 10: toxicity by a bidirectional gated recurrent network.

``gru`` has the network: words and their characters in, attention pooling over
a window of ``WIDTH`` words. A text's score is that of its worst window, over
all overlapping windows of the whole text, so one insult in a long text counts.

Training takes a bounded sample of labelled rows (``POSITIVES`` of label 1, the
shortest first, since a short text says best where the insult is; ``NEGATIVES``
of label 0), chosen by a hash of the id, from each an excerpt of at most
``EXCERPT`` words. The sample reaches the driver, is trained on there in numpy,
and the parameters are broadcast (16 MB, whatever the corpus). The score is
shifted so that ``THRESHOLD`` lies between the sample's two classes, closer to
the toxic one: a long text has many windows that may be wrong.

Defined cases: null text counts as empty; an empty text is one empty window;
with labels of one kind or none, the score is the share of label 1 (0 without
labels); a null label does not train; of several labels of a doc_id the highest
counts; repeated rows are separate rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.llm import gru
from tillsense.llm.common import md5_key, small_batches, text_batches, texts_of

WIDTH, STRIDE = 32, 24
POSITIVES, NEGATIVES = 1000, 8000
#: Ids drawn for each positive of the sample, to find short texts among them.
DRAWN = 3
EXCERPT, EXCERPT_CHARS = 192, 4000
THRESHOLD = 0.3
#: Where the threshold lies between the highest text of label 0 (0) and the lowest of label 1 (1).
MARGIN = 0.6
FOLDS, HELD_OUT = 4, 2
SLICE = 1_000_000


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def _excerpts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts, sizes = [], []
        for i, t in zip(pdf["doc_id"], pdf["text"], strict=True):
            words = (t or "").split()
            at = crc32(str(i).encode()) % max(1, len(words) - EXCERPT + 1)
            texts.append(" ".join(words[at : at + EXCERPT])[:EXCERPT_CHARS])
            sizes.append(len(words))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "n": sizes, "text": texts})


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Excerpts and their labels, of bounded number and length."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    key = md5_key(F.col("doc_id"), "toxic")
    ids = [known.filter(c).orderBy(key, "doc_id").limit(n) for c, n in (("toxic = 1", DRAWN * POSITIVES), ("toxic = 0", NEGATIVES))]
    drawn = F.broadcast(ids[0].unionByName(ids[1]))  # DRAWN * POSITIVES + NEGATIVES rows at most
    rows = docs.select("doc_id", "text").join(drawn, "doc_id").mapInPandas(_excerpts, "doc_id long, toxic int, n long, text string").toPandas()
    rows = rows.sort_values(["toxic", "n", "doc_id", "text"]).drop_duplicates("doc_id")
    rows = pd.concat([rows[rows.toxic == 1].head(POSITIVES), rows[rows.toxic == 0]])
    return rows["text"].tolist(), rows["toxic"].to_numpy(np.int64)


def _worst(texts: list[str], params: dict[str, np.ndarray]) -> np.ndarray:
    """Highest window logit of each text."""
    v = gru.read_words(texts)
    grid, owner = gru.window_grid(v, WIDTH, STRIDE)
    x = gru.word_inputs(params, v)
    out = np.full(len(texts), -np.inf)
    for lo in range(0, len(grid), 2048):
        np.maximum.at(out, owner[lo : lo + 2048], gru.forward(params, x, grid[lo : lo + 2048]))
    return out


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, np.ndarray] | None, float]:
    """(parameters, logit that the threshold stands for); without two kinds of
    labels (None, share of label 1)."""
    texts, y = training_sample(docs, labels)
    if len(set(y.tolist())) < 2:
        return None, float(y.mean()) if len(y) else 0.0
    params, best = gru.fit(texts, y, WIDTH)
    low, high = np.quantile(best[y == 0], 0.999), np.quantile(best[y == 1], 0.01)
    return params, float(low + MARGIN * (high - low))


def score(docs: DataFrame, params: dict[str, np.ndarray] | None, level: float) -> DataFrame:
    """Every row of ``docs`` with score and predicted."""
    if params is None:
        return docs.withColumn("score", F.lit(level)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    model = docs.sparkSession.sparkContext.broadcast(params)
    shift = math.log(THRESHOLD / (1 - THRESHOLD)) - level

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            parts = [np.zeros(0)]
            for part in text_batches(pd.DataFrame({"text": texts_of(series)}, dtype=object), chars=SLICE):
                logit = _worst(part["text"].tolist(), model.value).astype(np.float64) + shift
                parts.append(np.round(1 / (1 + np.exp(-np.clip(logit, -40, 40))), 6))
            yield pd.Series(np.concatenate(parts))

    return docs.withColumn("score", scored("text")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of toxicity scores over a documents table."""
    small_batches(docs)
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    params, level = train(docs, labels.filter(fold(F.col("doc_id")) != HELD_OUT))
    return score(docs.select("doc_id", "text", held_out.alias("held_out")), params, level).drop("text")
