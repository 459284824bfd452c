"""Operator 4: packing into optimal length buckets.

The length histogram of the whole table picks the bucket boundaries: dynamic
programming over it minimises the padding that results when every document of
a bucket is padded to the bucket's longest one. Inside each bucket documents
are dealt, in the order of a uniform key, to batches of
``token_budget div padded length`` documents (one at least).

Lengths are exact up to ``exact``; above it the histogram has ``fine`` cells
for each doubling, so its size is bounded whatever the lengths (about 3,000
cells for texts of up to 2^31 words). A cell carries its count, its sum of
lengths and its longest length, so padding is exact and the boundaries are
optimal among cell ends. Only the histogram reaches the driver.

Defined cases: null or empty text has length 0 (no padding target below 1
counts for the budget); a document longer than the budget is a batch by
itself; repeated rows are separate rows; an empty table gives an empty result;
further columns of the input are kept by :func:`pack`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.llm.common import hash_cells, md5_key, n_words, prefix_sums, stored

SALT = "pack"
BUCKETS = 16
TOKEN_BUDGET = 16384
EXACT = 1024
FINE = 128


def length_cell(length: Column, exact: int = EXACT, fine: int = FINE) -> Column:
    """Histogram cell of a length: itself up to ``exact``, then ``fine`` cells
    for each doubling; monotone in the length."""
    over = F.floor(F.log2(F.greatest(length, F.lit(exact)) / F.lit(float(exact))) * F.lit(fine)) + F.lit(exact)
    return F.when(length < exact, length).otherwise(over).cast("long")


def optimal_boundaries(counts: np.ndarray, sums: np.ndarray, tops: np.ndarray, buckets: int) -> np.ndarray:
    """Last cells (indexes) of at most ``buckets`` runs of cells with the least
    total padding ``sum(count * top of the run - length)``.

    cost[k][j] = min over i of cost[k-1][i] + pad(i, j); the best i never
    moves left as j grows, so each k is filled by divide and conquer.
    """
    n = len(counts)
    c = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    s = np.concatenate([[0], np.cumsum(sums)]).astype(np.float64)
    k_max = min(buckets, n)
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    back = np.zeros((k_max + 1, n + 1), dtype=np.int64)
    ends = []
    for k in range(1, k_max + 1):
        new = np.full(n + 1, np.inf)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            v = cost[i] + (c[j] - c[i]) * tops[j - 1] - (s[j] - s[i])
            best = int(np.argmin(v))
            new[j], back[k, j] = v[best], i[best]
            todo += [(lo, j - 1, a, int(i[best])), (j + 1, hi, int(i[best]), b)]
        cost = new
        ends.append(cost[n])
    k = int(np.argmin(ends)) + 1
    out, j = [], n
    while k:
        out.append(j - 1)
        j, k = int(back[k, j]), k - 1
    return np.array(out[::-1], dtype=np.int64)


def bucket_tops(histogram: list[tuple[int, int, int, int]], buckets: int) -> list[tuple[int, int]]:
    """(last cell, padded length) of each bucket; histogram rows are
    (cell, documents, sum of lengths, longest length)."""
    if not histogram:
        return []
    h = np.array(sorted(histogram), dtype=np.int64)
    ends = optimal_boundaries(h[:, 1], h[:, 2], h[:, 3], buckets)
    return [(int(h[e, 0]), int(h[e, 3])) for e in ends]


def pack(sized: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, tie: tuple[str, ...] = ()) -> DataFrame:
    """``sized`` has doc_id and size (length), and is read twice: pass a stored
    table. Adds bucket (from 0, by length), padded_size, padding, batch (from 0
    inside the bucket) and batch_slot."""
    d = sized.withColumn("_cell", length_cell(F.col("size")))
    hist = d.groupBy("_cell").agg(F.count("*").alias("n"), F.sum("size").alias("s"), F.max("size").alias("m")).collect()
    tops = bucket_tops([(r["_cell"], r["n"], r["s"], r["m"]) for r in hist], buckets)
    bucket = F.lit(None).cast("int")
    padded = F.lit(None).cast("long")
    for b, (cell, top) in reversed(list(enumerate(tops))):
        bucket = F.when(F.col("_cell") <= cell, b).otherwise(bucket)
        padded = F.when(F.col("_cell") <= cell, top).otherwise(padded)
    d = d.withColumn("bucket", bucket.cast("int")).withColumn("padded_size", padded.cast("long")).withColumn("_key", md5_key(F.col("doc_id"), SALT))
    d = prefix_sums(d, ["bucket"], "_key", ["doc_id", "size", *tie], None, "_rank", hash_cells(sum(r["n"] for r in hist)))
    per = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.lit(1), F.col("padded_size"))))
    return (
        d.withColumn("padding", F.col("padded_size") - F.col("size"))
        .withColumn("batch", F.floor(F.col("_rank") / per).cast("long"))
        .withColumn("batch_slot", (F.col("_rank") % per).cast("long"))
        .drop("_cell", "_key", "_rank")
    )


def pack_documents(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """The digest of the packing of a documents table (lengths in words)."""
    sized = stored(docs.select("doc_id", n_words(F.col("text")).alias("size")), "pack-sizes")
    return pack(sized, buckets, token_budget).select("doc_id", "size", "bucket", "padded_size", "padding", "batch", "batch_slot")
