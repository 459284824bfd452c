"""Operator 8: near-duplicate embeddings by collision counting.

Equal vectors are one class with a multiplicity. Unit vectors at a cosine of
0.9 are close on every one-dimensional projection: their difference there has a
standard deviation of ``sqrt(0.2 / d)``. So all vectors of a group are sorted on
each of ``PROJECTIONS`` random projections, a window of 1.5 such deviations
around each query collides with its neighbours there, and pairs with enough
collisions are verified by their exact cosine. The least count is the one that
a pair at the threshold reaches with probability ``RECALL``.

Groups come from the signs of ``k`` further projections, in ``L`` tables: a
pair at the threshold shares a group of one table with probability
``(1 - acos(0.9) / pi)^k``. ``k`` grows with the logarithm of the number of
vectors, so groups keep their size, and ``L`` is set for ``RECALL``; work grows
far less than the square of the input. A group that is larger all the same is
cut into blocks, and pairs of blocks are compared by different tasks.

A pair counts in the first table that brings it together, so each link counts
once, and no pairs are emitted: a task returns for each vector the number of
its links and a spanning forest of them.

Defined cases: a vector that is null, zero, or has null or non-finite
components links with nothing (n_links 0, a component of its own); vectors of
different length are never linked; rows with equal vec_id and equal vectors
are copies; a null vec_id is returned unlinked with a null component; an empty
table gives an empty result; other columns (label) are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsense.llm.common import stored
from tillsense.llm.components import components, union

COSINE = 0.9
PROJECTIONS = 32
WINDOW = 1.5  # standard deviations of a pair at the threshold
RECALL = 0.995
GROUP, BLOCK = 256, 1024
SEED = 8


def least_count(recall: float = RECALL) -> int:
    """Collisions that a pair at the threshold reaches with this probability."""
    p = math.erf(WINDOW / math.sqrt(2))
    tail = 0.0
    for c in range(PROJECTIONS, 0, -1):
        tail += math.comb(PROJECTIONS, c) * p**c * (1 - p) ** (PROJECTIONS - c)
        if tail >= recall:
            return c
    return 0


def tables_for(n: int, recall: float = RECALL) -> tuple[int, int]:
    """(signs in a table's key, tables) for ``n`` vectors."""
    k = max(0, math.ceil(math.log2(max(1, n) / GROUP)))
    if not k:
        return 0, 1
    share = (1 - math.acos(COSINE) / math.pi) ** k
    return k, math.ceil(math.log(1 - recall) / math.log(1 - share))


def directions(d: int, count: int, salt: int) -> np.ndarray:
    """Random unit vectors, the same in every task."""
    r = np.random.Generator(np.random.PCG64([SEED, d, salt])).standard_normal((d, count))
    return r / np.linalg.norm(r, axis=0)


def units(vectors: list) -> np.ndarray:
    v = np.array([np.asarray(x, dtype=np.float64) for x in vectors])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def collisions(p: np.ndarray, q: np.ndarray, window: float) -> np.ndarray:
    """count[i, x]: projections on which x lies in the window around query i;
    p and q are the queries' and the others' projections."""
    count = np.zeros((len(p), len(q)), dtype=np.uint8)
    rank = np.arange(len(q))
    for j in range(p.shape[1]):
        order = np.argsort(q[:, j], kind="stable")
        line = q[order, j]
        lo = np.searchsorted(line, p[:, j] - window, side="left")[:, None]
        hi = np.searchsorted(line, p[:, j] + window, side="right")[:, None]
        place = np.empty_like(order)
        place[order] = rank
        count += (place >= lo) & (place < hi)
    return count


def _signed(k: int, tables: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for d, part in pdf.groupby(pdf["vec"].str.len()):
                u = units(part["vec"].tolist())
                if k:
                    bits = (u @ directions(int(d), k * tables, 1) >= 0).reshape(len(u), tables, k)
                    sigs = (bits * (1 << np.arange(k))).sum(axis=2).astype(np.int32)
                else:
                    sigs = np.zeros((len(u), tables), dtype=np.int32)
                yield pd.DataFrame({"id": part["id"], "copies": part["copies"], "dim": int(d), "vec": part["vec"], "sigs": list(sigs)})

    return sign


def _linked(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of one pair of blocks of one group of one table."""
    t, i, j = int(pdf["t"].iloc[0]), int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    u = units(pdf["vec"].tolist())
    d = u.shape[1]
    ids, copies, sigs = pdf["id"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), np.stack(pdf["sigs"].tolist())
    p = u @ directions(d, PROJECTIONS, 2)
    window, least = WINDOW * math.sqrt(2 * (1 - COSINE) / d), least_count()
    block = pdf["block"].to_numpy()
    left, right = np.nonzero(block == i)[0], np.nonzero(block == j)[0]
    found_a, found_b = [], []
    for lo in range(0, len(left), BLOCK):
        a = left[lo : lo + BLOCK]
        for so in range(0, len(right), BLOCK):
            b = right[so : so + BLOCK]
            x, y = np.nonzero(collisions(p[a], p[b], window) >= least)
            x, y = a[x], b[y]
            if i == j:
                x, y = x[ids[x] < ids[y]], y[ids[x] < ids[y]]
            for part in range(0, len(x), 100_000):
                xs, ys = x[part : part + 100_000], y[part : part + 100_000]
                ok = np.einsum("ij,ij->i", u[xs], u[ys]) >= COSINE
                ok &= ~(sigs[xs, :t] == sigs[ys, :t]).any(axis=1)  # an earlier table has it
                found_a.append(xs[ok])
                found_b.append(ys[ok])
    a = np.concatenate(found_a) if found_a else np.zeros(0, dtype=np.int64)
    b = np.concatenate(found_b) if found_b else np.zeros(0, dtype=np.int64)
    links = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
    some = np.nonzero(links)[0]
    node, root = union(ids[a], ids[b])
    roots = dict(zip(node.tolist(), root.tolist(), strict=True))
    return pd.DataFrame({"id": ids[some], "links": links[some].astype(np.int64), "root": [roots[v] for v in ids[some].tolist()]}).astype({"root": "int64"})


def near_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``
    (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = F.coalesce(F.col("vec_id").isNotNull() & ~bad & (norm > 0), F.lit(False))
    rows = stored(rows.withColumn("usable", usable), "vectors")
    classes = stored(rows.filter("usable").groupBy("vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vector-classes")
    k, tables = tables_for(classes.count())
    kind = dict(classes.dtypes)["vec"]
    # int sigs of all tables travel along, to tell the first table of a pair
    signed = classes.mapInPandas(_signed(k, tables), f"id long, copies long, dim int, vec {kind}, sigs array<int>")
    keyed = signed.select("*", F.posexplode("sigs").alias("t", "sig"))
    sizes = keyed.groupBy("dim", "t", "sig").agg(F.count("*").alias("_size"))
    blocks = F.ceil(F.col("_size") / BLOCK).cast("int")
    member = keyed.join(sizes.filter("_size > 1"), ["dim", "t", "sig"]).withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    paired = member.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumn("i", F.least("block", "_o")).withColumn("j", F.greatest("block", "_o"))
    cells = paired.select("dim", "t", "sig", "i", "j", "block", "id", "copies", "vec", "sigs")
    found = stored(cells.groupBy("dim", "t", "sig", "i", "j").applyInPandas(_linked, "id long, links long, root long"), "vector-links")
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = classes.join(counts, "id", "left").join(joined, "id", "left").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    linked = rows.filter("usable").join(per_class, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
